"""op5: distances against a plain implementation, held-out accuracy, edges."""

from collections import Counter

from pyspark.sql import functions as F

from tests.llm.helpers import edge_rows, frame
from tripmart.llm import language_id as L
from tripmart.llm import queries


def plain_ngrams(text):
    out, word = [], ""
    for c in text + " ":
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            out.append(word)
            word = ""
    grams = Counter()
    line = " " + " ".join(out) + " " if out else ""
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            g = line[i:i + n]
            if (n == 1 and g == " ") or (n == 3 and g[1] == " "):
                continue
            grams[g] += 1
    return grams


def test_ngrams_and_ranks_equal_a_plain_count():
    for text in ("The cat, the hat.", "Üben übt!", "a", "日本語 x", "IJ ij 12 a1b"):
        mine = Counter(L.ngrams(text).tolist())
        want = plain_ngrams(text)
        code = {g: sum((1 if c == " " else ord(c)) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g)) for g in want}
        assert mine == Counter({code[g]: n for g, n in want.items()})
        ranked = sorted(mine, key=lambda g: (-mine[g], g))[:5]
        assert L.ranked(L.ngrams(text), 5).tolist() == ranked


def test_distance_is_out_of_place():
    r = L.Ranker({"x": L.ranked(L.ngrams("aab"), 4).tolist(), "y": L.ranked(L.ngrams("zzz"), 4).tolist()}, 4)
    assert r.predict("aab")[0] == "x" and r.predict("zz zz")[0] == "y"
    assert r.predict("aab")[1] > 0.5


def test_accuracy_on_held_out_documents(spark, sf_small):
    found = queries.op5_language_id(spark, sf_small)
    truth = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang")
    both = found.join(truth, "doc_id")
    held = both.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held >= 0.97
    assert both.filter("score < 0 OR score > 1").count() == 0
    crc = both.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1) != F.col("held_out"))
    assert crc.count() == 0


def test_edges(spark):
    docs = frame(spark, edge_rows()).withColumn("lang_pred", F.lit("old"))
    none = L.identify(docs, {})
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)} and none.count() == len(edge_rows())
    out = {r.doc_id: r for r in L.identify(docs, {"en": L.ranked(L.ngrams("one two same row")).tolist()}).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert out[4].lang_pred == out[8].lang_pred == "en"
    learn = frame(spark, [("x", None), (None, "en"), ("x", "en")], "text string, lang string")
    assert list(L.learn_profiles(learn)) == ["en"]
    assert L.learn_profiles(learn.filter("false")) == {}
