"""op9 against a plain search."""

import gc
import random
import re
import weakref

import numpy as np

from tests.llm.helpers import edge_rows, frame
from tripmart.llm import decontaminate as D
from tripmart.plans.inspect import plan_string

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=10):
    out = {}
    for d, t in docs:
        w = tokens(t)
        hit, which = set(), set()
        for item, s in items:
            v = tokens(s)
            n = min(window, len(v))
            for j in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[j:j + n]:
                        hit.update(range(p, p + n))
                        which.add("null" if item is None else str(item))
        out[d] = (len(w), len(hit), tuple(sorted(which)))
    return out


def run(spark, docs, items, **options):
    b = spark.createDataFrame(items, "item_id bigint, text string")
    rows = D.find_matches(frame(spark, docs), b, **options).collect()
    return {r.doc_id: (r.n_words, r.n_hit, tuple(sorted({m.item_id for m in r.matches}))) for r in rows}, rows


def test_random_texts(spark):
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 25)))) for i in range(25)]
    items += [(25, "v1 V2,v3"), (26, None), (None, "v4 v4 v4 v5"), (25, "v1 v2 v3")]
    docs = []
    for i in range(120):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            src = (items[rng.randrange(25)][1] or "").split()
            w[5:5] = src[rng.randint(0, 3):]
        docs.append((i, " ".join(w)))
    got, rows = run(spark, docs, items, window=6)
    assert got == brute(docs, items, 6)
    # the benchmark in several blocks gives the same
    assert run(spark, docs, items, window=6, block_words=40)[0] == got
    # matches are verbatim, and cannot be extended
    text = {i: tokens(t) for i, t in docs}
    by = {}
    for i, t in items:
        by.setdefault("null" if i is None else str(i), []).append(tokens(t))
    for r in rows:
        w = text[r.doc_id]
        for m in r.matches:
            span = w[m.doc_start:m.doc_start + m.length]
            assert any(v[m.item_start:m.item_start + m.length] == span for v in by[m.item_id])


def test_rows_that_share_an_id(spark):
    v = [f"v{i}" for i in range(30)]
    long = " ".join(v[:11])
    items = [(None, long), (None, " ".join(v[:3])), (7, "v0 v1 v2"), (7, long), (7, long), (8, "v5 v6"),
             (8, " ".join(["other", *v[6:16]])), (9, " ".join(v[12:24])), (9, "v20 v21 v22")]
    docs = [(1, "x y " + long + " z"), (2, " ".join(v)), (3, "v0 v1 v2"), (4, "v0 v1 v2 v0 v1 v2 " + long)]
    got, rows = run(spark, docs, items)
    assert got == brute(docs, items)
    assert got[1][1] == 11
    one = [tuple(m) for r in rows if r.doc_id == 1 for m in r.matches]
    assert one == [("7", 0, 2, 11), ("null", 0, 2, 11), ("8", 0, 7, 2)]
    # every match is verbatim in a row of its id
    text = dict(docs)
    for r in rows:
        for m in r.matches:
            span = tokens(text[r.doc_id])[m.doc_start:m.doc_start + m.length]
            assert len(span) == m.length and any(
                tokens(t)[m.item_start:m.item_start + m.length] == span
                for i, t in items if ("null" if i is None else str(i)) == m.item_id)
    # and the same however the benchmark is cut
    assert sorted(run(spark, docs, items, block_words=12)[1]) == sorted(rows)


def test_blocks_are_dropped_after_their_pass(spark, monkeypatch):
    made, alive = [], []
    make = D.make_block

    def counted(*a):
        b = make(*a)
        made.append(weakref.ref(b))
        gc.collect()
        alive.append(sum(r() is not None for r in made))
        return b

    monkeypatch.setattr(D, "make_block", counted)
    items = [(i, " ".join(f"i{i}w{j}" for j in range(12))) for i in range(6)] + [(6, "i0w3 i0w4")]
    docs = [(1, items[0][1] + " x " + items[4][1]), (1, items[0][1]), (2, None), (None, items[5][1]), (3, "i0w3 i0w4")]
    df = frame(spark, docs).withColumnRenamed("doc_id", "row_")
    out = D.find_matches(df, spark.createDataFrame(items, "item_id bigint, text string"), block_words=12)
    assert len(made) == 7 and max(alive) <= 2
    assert plan_string(out).count("MapInArrow") <= 2      # not one a block
    whole = D.find_matches(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert out.columns == whole.columns == ["row_", "text", "n_words", "n_hit", "matches"]
    assert sorted(map(str, out.collect())) == sorted(map(str, whole.collect()))


def test_edges(spark):
    docs = [r for r in edge_rows() if r[0] is not None]
    items = [(1, "one two three"), (2, "same row"), (3, ""), (4, "日本語")]
    assert run(spark, docs, items)[0] == brute(docs, items)
    assert {x[1] for x in run(spark, docs, [])[0].values()} == {0}
    assert run(spark, [], items)[0] == {}
    clean = D.clean_documents(frame(spark, edge_rows()).withColumnRenamed("text", "n_words"),
                              spark.createDataFrame(items, "item_id bigint, text string"), "n_words")
    assert clean.columns == ["doc_id", "n_words"]
    assert sorted(r.doc_id for r in clean.collect() if r.doc_id) == [1, 2, 3, 4, 6, 7]


def test_suffix_array_is_sorted():
    rng = np.random.RandomState(0)
    w = np.concatenate([rng.randint(0, 3, 300), np.zeros(20, int)]).astype(np.int32)
    starts = np.arange(300)
    order = D.suffix_array(w, starts, 12)
    keys = [tuple(w[i:i + 12]) for i in order]
    assert keys == sorted(keys)
