"""The corpus pipeline: language ID, exact dedup, n-gram Jaccard join,
benchmark decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir)
and returns a DataFrame. Each stage's rows are written as Parquet and reread
as the next one's ``docs``. All but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import decontaminate, exact_dedup, jaccard_join, language_id, queries
from tripmart.llm.common import bounded_batches, numbered, staged, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages stay; a text without any
    letter (or no text) is of no language and goes. Profiles are learned from
    this stage's own input."""
    bounded_batches(spark)
    profiles = queries.learn_languages(docs.select("doc_id", "text", "lang"))
    plain, names = numbered(docs)
    found = language_id.identify(plain, profiles, names["text"])
    kept = found.filter(F.col("lang_pred") != language_id.UNKNOWN)
    return kept.select(*plain.columns).toDF(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return queries.packed_digest(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("decontamination", benchmark),
    ("packing", packing),
]

#: SQL can express neither the language model nor the tokenizer; the tests take
#: the stages one by one and run() as a whole against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
