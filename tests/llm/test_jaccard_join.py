"""op10 against all pairs."""

import os
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import edge_rows, frame, words
from tripmart.llm import jaccard_join as J
from tripmart.llm.common import staged


def sets(rows, n=5):
    out = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        out.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute(rows, percent=80):
    s = sets(rows)
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            k = len(s[i] & s[j])
            if k and 100 * k >= percent * len(s[i] | s[j]):
                up[top(i)] = top(j)
    first = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            first[top(i)] = min(first.get(top(i), d), d)
    return sorted((d, len(s[i]), first.get(top(i)) if s[i] else d) for i, (d, _) in enumerate(rows) if d is not None)


def near_copies(rng, base, n, first_id):
    """Chains of copies, each a little different from the one before."""
    out, text = [], list(base)
    for i in range(n):
        out.append((first_id + i, " ".join(text)))
        if rng.random() < 0.7:
            text = list(text)
            text[rng.randrange(len(text))] = rng.choice(["x", "y", "z"]) + str(rng.randrange(50))
    return out


@pytest.mark.parametrize("tile,words_of_map", [(4096, None), (4, None), (64, 0)])
def test_chains_boilerplate_and_edges(spark, tile, words_of_map, monkeypatch):
    if words_of_map is not None:                          # joins by key in place of bit maps
        monkeypatch.setattr(J, "_fits", lambda keys: False)
        monkeypatch.setattr(J, "PARTNERS", 3)
    rng = random.Random(tile)
    rows = edge_rows()
    common = words(rng, 30)
    for k in range(12):
        rows += near_copies(rng, words(rng, rng.choice([12, 40, 150])), rng.choice([2, 5, 9]), 1000 * (k + 1))
    for i in range(60):                                   # a passage that many documents share
        rows.append((50_000 + i, " ".join(words(rng, rng.choice([5, 20, 60])) + common)))
    rows += [(60_000 + i, "THE same " + " ".join(common)) for i in range(40)]       # exact copies
    df = J.similar_components(frame(spark, rows), tile=tile)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None)
    assert got == brute(rows)


def test_one_of_each_and_empty(spark):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (2, "other"), (4, None), (5, None)]
    kept = J.one_of_each(frame(spark, rows).withColumnRenamed("text", "n_shingles"), text_col="n_shingles")
    assert kept.columns == ["doc_id", "n_shingles"] and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]
    assert J.similar_components(frame(spark, [])).count() == 0


def test_one_of_each_with_repeated_and_null_ids(spark):
    a, b = "one text of more than five words", "quite another text that is long enough"
    kept = J.one_of_each(frame(spark, [(3, a), (5, a), (5, b)])).collect()
    assert sorted(map(tuple, kept)) == [(3, a), (5, b)]
    rows = [(None, a), (None, a), (7, a), (None, b), (None, b), (7, None), (7, None), (None, "")]
    kept = J.one_of_each(frame(spark, rows)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(7, a), (None, b), (7, None), (7, None), (None, "")]))


def scratch_files(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_one_of_each_with_rows_that_repeat(spark, tmp_path, monkeypatch):
    """Of rows that repeat id and text the first stays, whatever its other
    columns; many rows that go are found by a bit map, not a broadcast.
    Neither a copy of the documents nor the lists of the join are left behind."""
    monkeypatch.setattr(J, "BROADCAST_KEYS", 1)
    rng = random.Random(4)
    # words of random letters: files of them cannot be much smaller
    texts = [" ".join("".join(rng.choices(string.ascii_lowercase, k=12)) for _ in range(200)) for _ in range(120)]
    rows = [(i, t, {"n": 3 * i + k}) for i, t in enumerate(texts) for k in range(1 + i % 3)]
    rows += [(1000 + i, t + " end", {"n": 1000 + i}) for i, t in enumerate(texts[:50])]
    rows += [(None, texts[0], {"n": 1}), (7, None, {"n": 2}), (7, None, {"n": 2})]
    frame(spark, rows, "doc_id bigint, text string, extra map<string, int>").coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    before = scratch_files(spark)
    kept = J.one_of_each(docs)
    left = sum(os.path.getsize(f) for f in scratch_files(spark) - before)
    assert left < 0.3 * sum(os.path.getsize(f"{tmp_path}/docs/{f}") for f in os.listdir(f"{tmp_path}/docs"))
    assert kept.schema == docs.schema
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [
        *((i, t, {"n": 3 * i}) for i, t in enumerate(texts)), (7, None, {"n": 2}), (7, None, {"n": 2})]))


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffled():
        return {f for top in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
                for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    before = shuffled()
    out = staged(spark.range(1000).groupBy((F.col("id") % 50).alias("k")).agg(F.count("*").alias("n")), "test-shuffle")
    assert not shuffled() - before
    assert out.select("n").distinct().collect()[0].n == 20
    spark.range(10).groupBy("id").count().write.format("noop").mode("overwrite").save()
    assert shuffled() - before                          # a caller's own writes keep theirs


def test_one_of_each_keeps_one_row_of_every_component(spark):
    rng = random.Random(9)
    rows = []
    for k in range(25):
        rows += near_copies(rng, words(rng, 40), rng.choice([1, 2, 4]), 0)
    rows = [(rng.choice([None, *range(12)]), t) for _, t in rows]
    numbered = [(i, t) for i, (_, t) in enumerate(rows)]
    group = {i: c for i, _, c in brute(numbered)}
    kept = J.one_of_each(frame(spark, rows)).collect()
    by_text = {t: group[i] for i, t in numbered}
    assert sorted(by_text[r.text] for r in kept) == sorted(set(group.values()))
    for r in kept:
        ids = [rows[i][0] for i in group if group[i] == by_text[r.text] and rows[i][0] is not None]
        assert r.doc_id == min(ids, default=None)


def test_hashes_do_not_hang_on_place_or_span(monkeypatch):
    rng = np.random.RandomState(0)
    runs = [bytes(rng.randint(33, 127, n).astype(np.uint8)) for n in (1, 5, 700, J._SPAN // 2, J._SPAN // 2 + 1, J._SPAN, J._SPAN + 1, 9)]

    def hashes(order, gap):
        buf, start, end = b"", [], []
        for k in order:
            buf += b" " * gap
            start.append(len(buf))
            buf += runs[k]
            end.append(len(buf))
        return dict(zip(order, J.byte_run_hashes(np.frombuffer(buf, np.uint8), np.array(start), np.array(end)).tolist()))

    first = hashes(list(range(len(runs))), 1)
    assert len(set(first.values())) == len(runs)
    assert hashes(list(range(len(runs)))[::-1], 3) == first and hashes([2, 4, 0, 7, 6, 1, 5, 3], 1000) == first


def test_a_very_long_text_leaves_nothing_behind():
    import tracemalloc
    text = (b"word%d " * 2_000_000) % tuple(range(2_000_000))
    J.shingle_sets([text[:1 << 16]])
    tracemalloc.start()
    assert len(J.shingle_sets([text])[0]) > 1_900_000
    assert tracemalloc.get_traced_memory()[0] < 4 << 20          # power tables have a fixed length
    tracemalloc.stop()


def test_bounds_never_underestimate():
    rng = np.random.RandomState(1)
    for n, m in ((30, 25), (300, 320), (3000, 2600)):
        both = rng.randint(0, 2**63, n, dtype=np.int64).astype(np.uint64)
        a, b = np.unique(both), np.unique(np.concatenate([both[:m // 2], rng.randint(0, 2**63, m // 2).astype(np.uint64)]))
        f, g = J.count_vector(a), J.count_vector(b)
        k = min(len(f), len(g))
        assert np.minimum(J.fold(f, k), J.fold(g, k)).sum() >= len(np.intersect1d(a, b))
        assert (J.unpack_vector(J.pack_vector(f)) == f).all()


def test_shingles_equal_plain_sets():
    texts = [t for _, t in edge_rows()] + ["a b c d e", "a  b\tc d\x0be", "A b c d e f"]
    mine = J.shingle_sets([None if t is None else t.encode() for t in texts])
    assert [len(x) for x in mine] == [len(s) for s in sets([(0, t) for t in texts])]
    assert (mine[-3] == mine[-2]).all() and mine[-3][0] in mine[-1]


def test_tree_gives_every_pair_that_may_link():
    rng = np.random.RandomState(7)
    base = rng.poisson(1.5, (40, J.GROUPS))
    vectors = np.concatenate([np.maximum(0, base[rng.randint(40, size=20)] + rng.randint(-1, 2, (20, J.GROUPS))) for _ in range(60)])
    sizes, comps = vectors.sum(axis=1), rng.randint(0, 500, len(vectors))
    tree, half = J.CountTree(vectors, sizes, comps), J.CountTree(vectors[:200], sizes[:200], comps[:200])
    assert len(tree.levels) == 2 and len(half.levels) == 1 and sorted(tree.order) == list(range(len(vectors)))

    def plain(n):
        return {(min(i, j), max(i, j)) for i in range(n) for j in range(len(vectors)) if i != j and (n == 200 or i < j)
                and comps[i] != comps[j] and 100 * min(sizes[i], sizes[j]) >= 80 * max(sizes[i], sizes[j])
                and np.minimum(vectors[i], vectors[j]).sum() >= J.least_overlap(sizes[i] + sizes[j])}

    mine = [(i, j) for x, y in tree.pairs(tree) for i, j in zip(x, y)]
    assert len(mine) == len(set(mine)) and {(min(p), max(p)) for p in mine} == plain(len(vectors))
    across = {(min(p), max(p)) for x, y in half.pairs(tree) for p in zip(x, y) if p[0] != p[1]}
    assert across == plain(200)


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.node: r.root for r in J.components(edges).collect()}
    assert {got[i] for i in range(61)} == {0} and got[100] == got[101] == 100


def test_large_blocks_pass_whole(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(J, "TILE", 6)
    block = [1] * 3 + [2] * 20 + [3] * 2 + [4] * 9
    n = list(range(10, 10 + len(block)))
    t = pa.table({"block": block, "n_shingles": n, "node": n, "comp": n, "pos": [0] * len(block)})
    for step in (1, 4, 7, 100):
        out = pa.Table.from_batches(list(J._compatible_rows(iter(t.to_batches(max_chunksize=step)), 80)), t.schema)
        got = out.to_pylist()
        assert len([r for r in got if r["block"] == 2]) == 20 and len([r for r in got if r["block"] == 4]) == 9
        assert [r["node"] for r in got if r["block"] in (1, 3)] == [10, 11, 12, 33, 34]


def test_sets_just_too_different_to_link_seldom_pass():
    rng = np.random.RandomState(3)
    for n in (146, 600):
        common = rng.randint(0, 2**63, n * 27 // 32).astype(np.uint64)
        sets = [np.unique(np.concatenate([common, rng.randint(0, 2**63, n - len(common)).astype(np.uint64)])) for _ in range(100)]
        rows = [(k, len(s), k, 0, J.pack_vector(J.count_vector(s))) for k, s in enumerate(sets)]      # 73 of 100 alike
        assert len(list(J._Points(80).pairs(rows, True))) < 100 * 99 / 2 / 4


def test_packed_counts_come_back():
    for most in (1, 3, 4, 255, 256, 70_000):
        v = np.zeros(J.GROUPS, "<u4")
        v[[0, 5, 63]] = most, 2, max(most - 1, 1)
        assert (J.unpack_vector(J.pack_vector(v)) == v).all()


def test_blocks_are_counted_where_they_are_whole(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(J, "TILE", 6)
    t = pa.table({"block": [1] * 3 + [2] * 20 + [3] + [4] * 6, "node": list(range(30))})
    for step in (1, 4, 7, 100):
        got = pa.Table.from_batches(list(J._sized_rows(iter(t.to_batches(max_chunksize=step))))).to_pydict()
        assert got["node"] == list(range(30)) and got["k"][3:23] in ([None] * 20, [20] * 20)
        assert got["k"][:3] + got["k"][23:] == [3] * 3 + [1] + [6] * 6


def test_lists_of_linking_sets_share_enough():
    rng = np.random.RandomState(5)
    for n in [*range(1, 60), 200, 501]:
        for _ in range(6):
            both = rng.choice(10 * n + 50, n, replace=False)
            other = np.concatenate([both[rng.randint(0, n // 5 + 1):], -1 - rng.choice(10 * n, rng.randint(0, n // 5 + 1), replace=False)])
            k = len(np.intersect1d(both, other))
            if 100 * k < 80 * (len(both) + len(other) - k):
                continue
            lists = [np.sort(x)[:J.listed_length(len(x))] for x in (both, other)]
            assert len(np.intersect1d(*lists)) >= max(J.least_shared(len(both)), J.least_shared(len(other)))


def test_nodes_with_few_shared_shingles_go_to_no_block(spark):
    rng = random.Random(11)
    passage = words(rng, 20)                   # 16 of about 96 shingles; near copies share most
    rows = [(i, " ".join([f"a{i}x{k}" for k in range(40)] + passage + [f"b{i}x{k}" for k in range(40)])) for i in range(5)]
    rows += [(10 + i, " ".join([f"c{k}" for k in range(90)] + [f"d{i}"])) for i in range(2)]
    prints = J.fingerprints(frame(spark, rows), "doc_id", "text", 5, 80)
    near = {r.node for r in prints.filter("id >= 10").collect()}
    assert {r.node for r in J.shared_blocks(prints).collect()} == near


def test_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(J, "KEYS", 4)
    lists = [[1, 2, 3], [2, -7, 2**62], [], [5, 2, 2**62, 9], [-7], [2]]
    frame_ = spark.createDataFrame([(x,) for x in lists], "prefix array<long>").repartition(3)
    often, mask = J.repeated_keys(frame_, sum(map(len, lists)))
    flat = [x & mask for x in sum(lists, [])]
    assert sorted(r.key for r in often.collect()) == sorted({x for x in flat if flat.count(x) > 1})


def test_blocks_of_the_same_nodes_go_on_once(spark):
    rows = [(b, 100, n, 0) for b in range(30) for n in (7, 8)] + [(b, 100, n, 0) for b in range(30, 34) for n in (7, 8, 9)]
    label = spark.createDataFrame([], "node long, root long")
    cross = J.crossing(spark.createDataFrame(rows, "block long, n_shingles long, node long, pos int"), label, 80).collect()
    assert sorted((r.node, r.k) for r in cross) == [(7, 2), (7, 3), (8, 2), (8, 3), (9, 3)]
