"""op1, op2, op7 and op8: brute force, accuracy, edges."""

import datetime  # noqa: F401
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import edge_rows, frame
from tripmart.llm import chat, quality, queries, sharding, wordpiece


# --- sharding

def test_table_by_turns():
    names = [f"s{i}" for i in range(7)]
    t = sharding.lookup_table(names)
    counts = np.bincount(t)
    assert len(t) == sharding.next_prime(700) and counts.max() - counts.min() <= 1
    fewer = sharding.lookup_table(names[:-1], len(t))
    stay = (t == fewer)[t < 6].mean()
    assert stay > 0.75                                # losing a shard moves few other slots
    assert set(sharding.lookup_table(["only"])) == {0}
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad)


def test_assign_edges(spark, tmp_path):
    df = frame(spark, edge_rows()).withColumn("slot", F.lit("x"))
    rows = sharding.assign(df, "doc_id", ["a", "b", "c"]).collect()
    assert len(rows) == len(edge_rows()) and {r.shard for r in rows} <= {"a", "b", "c"}
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.shard)
    assert all(len(s) == 1 for s in by.values())
    assert sharding.assign(frame(spark, []), "doc_id", ["a"]).count() == 0
    sharding.write_shards(df, str(tmp_path / "out"), "doc_id", ["a", "b"], files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(edge_rows())


# --- quality

def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op2_quality(spark, sf)
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    both = found.join(truth, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in both]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in both)


def test_quality_edges(spark):
    docs = frame(spark, edge_rows()).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 1), (None, 1), (9, None), (99, 1)], "doc_id long, quality int")
    w = quality.train(docs, labels)
    assert w.shape == ((1 << quality.BITS) + 1,)
    out = quality.score(docs, w).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r.score <= 1 for r in out)
    blank = {round(r.score, 12) for r in out if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1
    none = quality.train(docs, labels.filter("false"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}


SHORT = ["one", "One two", "a a", "b a", "a b a", "x, x", "!", "", None, " ", "a", "10 TEN ten Ten", "\u00c9t\u00e9 \u00c9t\u00e9"]


def test_features_stop_at_text_borders():
    texts = [t and t.encode() for t in SHORT]
    alone = [quality.features([t])[0] for t in texts]
    for slice_ in (range(len(texts)), range(len(texts))[::-1], [i for i in range(len(texts)) for _ in range(2)],
                   [j for i in range(len(texts)) for k in range(len(texts)) for j in (i, k)]):
        for i, (at, value) in zip(slice_, quality.features([texts[i] for i in slice_])):
            assert at.tolist() == alone[i][0].tolist() and value.tolist() == alone[i][1].tolist(), SHORT[i]


def test_quality_does_not_depend_on_neighbours(spark):
    rows = list(enumerate(SHORT * 6))
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    w = quality.train(docs.coalesce(1), labels)
    assert np.array_equal(w, quality.train(docs.repartition(7, "doc_id"), labels))
    by = [{r.doc_id: r.score for r in quality.score(d, w).collect()}
          for d in (docs.coalesce(1), docs.coalesce(1).orderBy(F.desc("doc_id")), docs.repartition(7, "doc_id"))]
    assert by[0] == by[1] == by[2] and len(by[0]) == len(rows)
    assert all(by[0][i] == by[0][i % len(SHORT)] for i, _ in rows)


def test_ftrl_learns_a_rule():
    rng = np.random.RandomState(0)
    rows = []
    for _ in range(600):
        at = np.unique(rng.randint(0, 50, 6))
        rows.append((at, np.full(len(at), 0.5, np.float32), int(3 in at)))
    w = quality.ftrl(rows, bits=6, updates=6000)
    got = [int(w[-1] + w[a] @ v > 0) == y for a, v, y in rows]
    assert np.mean(got) > 0.97


# --- word pieces

def greedy(word, initial, continuing):
    i = n = 0
    while i < len(word):
        vocab = initial if i == 0 else continuing
        for j in range(len(word), i, -1):
            if word[i:j] in vocab:
                break
        else:
            return 1, True
        n, i = n + 1, j
    return n, False


def test_counts_equal_greedy_matching():
    rng = np.random.RandomState(3)
    letters = "abc"
    piece = lambda: "".join(rng.choice(list(letters), rng.randint(1, 5)))
    for _ in range(30):
        initial, continuing = {piece() for _ in range(8)}, {piece() for _ in range(8)}
        machine = wordpiece.build(sorted(initial), sorted(continuing))
        words = ["".join(rng.choice(list(letters + "d"), rng.randint(1, 14), p=[.33, .32, .32, .03])) for _ in range(200)]
        n, odd = wordpiece.count_words(words, machine)
        assert [(int(a), bool(b)) for a, b in zip(n, odd)] == [greedy(w, initial, continuing) for w in words]


def test_token_count_edges(spark):
    initial, continuing = ["o", "one", "t", "s"], ["n", "e", "w", "o", "a", "m"]
    docs = frame(spark, edge_rows() + [(20, "t" + "o" * 500)]).withColumn("n_words", F.lit("x"))
    out = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown)
           for r in wordpiece.count_tokens(docs, initial, continuing).collect()}
    assert out[1] == out[2] == out[3] == (0, 0, 0) and out[4] == (1, 1, 0) and out[5] == (3, 5, 1)
    assert out[20] == (1, 501, 0) and out[6][0] == 30_000
    assert wordpiece.count_tokens(frame(spark, []), initial, continuing).count() == 0


def test_token_counts_of_documents(spark, sf_small):
    import public_tokenizers as P
    a, b = wordpiece.sentencepiece_vocabulary(P.path("piece_bpe_32k.model"))
    sa, sb = set(a), set(b)
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in queries.op8_token_counts(spark, sf_small).collect()}
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect():
        each = [greedy(w, sa, sb) for w in r.text.split()]
        assert got[r.doc_id] == (len(each), sum(n for n, _ in each), sum(o for _, o in each))


# --- chat

CALL = "conv_id long, turn int, call_id string, name string, arguments string, needs string"
RESULT = "conv_id long, turn int, call_id string, content string"
SCHEMA = {"t": {"a": ("string", True), "n": ("integer", False), "x": ("number", False), "f": ("boolean", False)}}


def formatted(spark, calls, results):
    df = chat.format_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT), SCHEMA)
    return sorted(df.collect(), key=lambda r: (str(r.conv_id), r.order_turn, r.order_step, str(r.call_id)))


def test_links_order_arguments_and_json(spark):
    calls = [(1, 0, "a", "t", '{"n": 2, "a": "x\\"é\\n"}', "c"), (1, 1, "b", "t", '{"a": 5}', None),
             (1, 2, "c", "t", '{"a":"y","x":1.5,"f":true}', "d"), (1, 3, "d", "u", "{}", "b"),
             (1, 4, "d", "t", '{"a":"z"}', None), (2, 0, "a", "t", '{"q":1,"n":"1"}', "zz"),
             (3, 0, "p", "t", "[1]", "q"), (3, 1, "q", "t", None, "p"), (None, 5, "n", "t", '{"a":"k"}', None),
             (4, 0, None, "t", '{"a":"k"}', None)]
    results = [(1, 5, "a", "ra"), (1, 6, "a", "again"), (1, 7, "zz", "lost"), (2, 1, "a", None), (None, 6, "n", "r")]
    rows = formatted(spark, calls, results)
    one = [(r.call_id, r.status, r.order_turn, r.order_step, r.errors) for r in rows if r.conv_id == 1]
    assert one == [("b", "missing", 1, 0, "type:a"), ("d", "missing", 3, 0, "unknown tool"), ("c", "missing", 3, 1, ""),
                   ("a", "linked", 3, 2, ""), ("d", "repeated", 4, 0, ""), ("a", "repeated", 6, 0, ""),
                   ("zz", "orphan", 7, 0, "")]
    js = {(r.conv_id, r.call_id, r.status): r.json for r in rows}
    assert js[(1, "a", "linked")] == '{"arguments":{"a":"x\\"é\\n","n":2},"id":"a","name":"t","result":"ra"}'
    two = [r for r in rows if r.conv_id == 2][0]
    assert two.errors == "missing:a,type:n,unexpected:q" and two.status == "linked"
    cyc = [r for r in rows if r.conv_id == 3]
    # p needs q and q needs p: cut at q, the later one
    assert [(r.call_id, r.order_turn, r.order_step, r.errors) for r in cyc] == [
        ("q", 1, 0, "not an object,cycle"), ("p", 1, 1, "not an object")]
    assert {r.status for r in rows if r.conv_id is None} == {"missing", "orphan"}
    assert formatted(spark, [], []) == []


def test_null_names_turns_and_contents(spark):
    calls = [(1, 0, "a", None, '{"a":"x"}', None), (1, 1, "b", None, "[1]", None), (1, 2, "c", "t", '{"a":"x"}', None),
             (2, None, "d", "t", '{"a":5}', "e"), (2, 4, "e", "t", '{"a":"x"}', None), (3, None, "f", "t", '{"a":"x"}', None)]
    results = [(1, 5, "a", "ra"), (1, 6, "b", "rb"), (1, 7, "c", None), (1, 8, "c", None), (1, 9, "o", None),
               (2, 5, "d", "rd"), (2, None, "e", "re"), (2, None, "p", "lost")]
    rows = chat.format_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT), SCHEMA).collect()
    got = sorted((r.conv_id, r.call_id, r.status, r.turn or -1, r.order_turn or -1, r.order_step, r.errors) for r in rows)
    assert got == [(1, "a", "linked", -1, -1, 0, "unknown tool"), (1, "b", "linked", 1, 1, 0, "not an object"),
                   (1, "c", "linked", 2, 2, 0, ""), (1, "c", "repeated", 8, 8, 0, ""), (1, "o", "orphan", 9, 9, 0, ""),
                   (2, "d", "linked", 5, 5, 0, "type:a"), (2, "e", "linked", 4, 4, 0, ""), (2, "p", "orphan", -1, -1, 0, ""),
                   (3, "f", "missing", -1, -1, 0, "")]


def test_long_chain_of_later_references(spark):
    calls = [(1, i, f"c{i}", "t", '{"a":"x"}', f"c{i + 1}" if i < 11 else None) for i in range(12)]
    rows = formatted(spark, calls, [])
    assert [r.call_id for r in rows] == [f"c{i}" for i in range(11, -1, -1)]
    assert all(r.errors == "" for r in rows)


def test_a_call_follows_an_earlier_one_that_moved(spark):
    calls = [(1, 0, "a", "t", '{"a":"x"}', "c"), (1, 1, "b", "t", '{"a":"x"}', "a"), (1, 2, "c", "t", '{"a":"x"}', None)]
    assert [r.call_id for r in formatted(spark, calls, [])] == ["c", "a", "b"]


def plain_order(calls):
    """order_turn, order_step and cycle of every call, by walking each chain."""
    turn = {(c, i): t for c, t, i, _, _, _ in calls}
    needs = {(c, i): (c, n) for c, _, i, _, _, n in calls if (c, n) in turn}

    def cycle(at):
        """The calls of a cycle through ``at``, or none."""
        seen, x = [at], needs.get(at)
        while x is not None and x != at and x not in seen:
            seen.append(x)
            x = needs.get(x)
        return seen if x == at else []

    cut = {at for at in turn if cycle(at) and turn[at] == max(turn[x] for x in cycle(at))}
    out = {}
    for at in turn:
        best, x, s = (turn[at], 0, at[1]), at, 0
        while x in needs and x not in cut:
            x, s = needs[x], s + 1
            best = max(best, (turn[x], s, x[1]))
        out[at] = (best[0], best[1], at in cut)
    return out


def test_order_of_random_needs_with_cycles(spark):
    rng = random.Random(8)
    calls = []
    for conv in range(60):
        n = rng.choice([1, 2, 3, 5, 9, 17])
        for i in range(n):
            calls.append((conv, rng.randrange(6), f"c{i}", "t", '{"a":"x"}', rng.choice([None, *(f"c{j}" for j in range(n + 1))])))
    got = {(r.conv_id, r.call_id): (r.order_turn, r.order_step, r.errors == "cycle") for r in formatted(spark, calls, [])}
    assert got == plain_order(calls)
    assert any(v[2] for v in got.values())


def test_chain_of_five_thousand_takes_log_rounds(spark, monkeypatch):
    rounds = []
    real = chat.staged
    monkeypatch.setattr(chat, "staged", lambda df, name: (rounds.append(name), real(df, name))[1])
    calls = [(1, i, f"c{i}", "t", '{"a":"x"}', f"c{i + 1}" if i < 4999 else None) for i in range(5000)]
    got = {r.call_id: (r.order_turn, r.order_step) for r in formatted(spark, calls, [])}
    assert got == {f"c{i}": (4999, 4999 - i) for i in range(5000)}
    assert rounds.count("chat-keys") <= 14 + 1          # the first table is no round


def test_schema_fields_with_dots_quotes_and_blanks(spark):
    schema = {"t": {"a.b": ("string", True), "c d": ("integer", True), "e'f": ("boolean", True)}}
    calls = [(1, 0, "x", "t", '{"a.b":"v","c d":1,"e\'f":true}', None), (1, 1, "y", "t", '{"a":{"b":"v"},"c d":"1"}', None)]
    rows = chat.format_calls(spark.createDataFrame(calls, CALL), spark.createDataFrame([], RESULT), schema).collect()
    assert {r.call_id: r.errors for r in rows} == {"x": "", "y": "missing:a.b,type:c d,missing:e'f,unexpected:a"}
