"""The pipeline against plain versions of its stages."""

from tests.llm.test_decontaminate import brute as brute_matches
from tests.llm.test_exact_dedup import brute as brute_copies
from tests.llm.test_jaccard_join import brute as brute_near
from tests.llm.test_packing_and_store import check_pieces, encode

import corpus_pipeline as C
from tripmart.llm.common import staged


def test_stages_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    extra = spark.createDataFrame([(900_001, "123 -- 456", "en", "x", 10), (900_002, None, "en", "x", 0)], docs.schema)
    docs = docs.unionByName(extra)
    columns = docs.columns
    now = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "packing"]
    for name, stage in C.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_small), "test-stage")
        assert docs.columns == columns
        if name == "language_id":
            keep = {i for i, t in now if any(c.isalpha() for c in t or "")}
        elif name == "exact_dedup":
            keep = {r[0] for r in brute_copies(now) if r[3]}
        elif name == "jaccard_join":
            keep = {r[0] for r in brute_near(now) if r[0] == r[2]}
        else:
            keep = {i for i, m in brute_matches(now, items).items() if not m[1]}
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == sorted(keep), name
        now = [(i, t) for i, t in now if i in keep]
    pieces = C.STAGES[-1][1](spark, docs, sf_small).collect()
    check_pieces(pieces, dict(zip([i for i, _ in now], encode("byte_bpe_50k.json", [t for _, t in now], 0))))


def test_run_against_brute_force(spark, sf_small):
    now = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    now = [(i, t) for i, t in now if any(c.isalpha() for c in t or "")]
    keep = {r[0] for r in brute_copies(now) if r[3]}
    now = [(i, t) for i, t in now if i in keep]
    keep = {r[0] for r in brute_near(now) if r[0] == r[2]}
    now = [(i, t) for i, t in now if i in keep]
    hits = brute_matches(now, items)
    now = [(i, t) for i, t in now if not hits[i][1]]
    ids = encode("byte_bpe_50k.json", [t for _, t in now], 0)
    check_pieces(C.run(spark, sf_small).collect(), dict(zip([i for i, _ in now], ids)))


def test_run_without_documents(spark, sf_small, tmp_path):
    spark.read.parquet(f"{sf_small}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_small}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_an_empty_corpus(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = staged(stage(spark, docs, sf_small), "test-empty")
        assert docs.count() == 0
