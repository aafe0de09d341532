"""Language identification by rank-order n-gram profiles.

A profile lists a text's most frequent character n-grams (1 to 3 letters,
words padded with a boundary mark), most frequent first, ties by code. The
distance of a document to a language is the sum of how far each of its
n-grams is out of place in the language's profile; an n-gram missing there
costs the profile length. The nearest language wins, ties by name.

Profiles are counted over every learning row (partial counts per task, then
one aggregate), whole texts; only the top ``PROFILE`` n-grams of each
language reach the driver.

Defined cases: a text that is null or has no letter gives ``und`` with score
0; without any profile (nothing to learn from) every text gives ``und``;
null languages and ids are never learned from; repeated rows are scored
alike; very long texts are handled whole, one at a time.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LEAN_BYTES, extended, pieces, release_kept, rename_clashes

PROFILE = 400
UNKNOWN = "und"
_SPACE = 1                    # boundary mark; letters keep their code points
_BASE = 21                    # bits per letter
_FLUSH = 500_000              # distinct n-grams a task holds per language
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or the boundary mark."""
    if not _LETTERS:
        out = np.full(0x110000, _SPACE, np.int64)
        for cp in range(0x41, 0x32400):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                out[cp] = ord(low) if len(low) == 1 else cp
        _LETTERS.append(out)
    return _LETTERS[0]


def ngrams(text: str) -> np.ndarray:
    """All 1- to 3-letter n-grams of the text's words, as integers."""
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    c = np.empty(len(raw) + 2, np.int64)
    c[0] = c[-1] = _SPACE
    c[1:-1] = _letters()[raw]
    blank = c == _SPACE
    keep = np.ones(len(c), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    c, blank = c[keep], blank[keep]
    if blank.all():
        return np.empty(0, np.int64)
    two = (c[:-1] << _BASE) | c[1:]
    three = ((two[:-1] << _BASE) | c[2:])[~blank[1:-1]]
    return np.concatenate([c[~blank], two, three])


def ranked(codes: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    key = (int(counts.max()) - counts).astype(np.int64) * len(values) + np.arange(len(values))
    if len(key) > size:
        key = np.partition(key, size - 1)[:size]
    return values[np.sort(key) % len(values)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows(lang: str) -> pa.RecordBatch:
        codes, counts = held.pop(lang)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])

    release_kept()
    for batch in pieces(batches, "text", LEAN_BYTES):
        langs = np.array(batch.column(batch.schema.get_field_index("lang")).to_pylist(), object)
        texts = np.array(batch.column(batch.schema.get_field_index("text")).to_pylist(), object)
        for lang in dict.fromkeys(langs):
            codes, counts = np.unique(np.concatenate([ngrams(t) for t in texts[langs == lang]]), return_counts=True)
            if lang in held:
                codes = np.concatenate([codes, held[lang][0]])
                counts = np.concatenate([counts, held[lang][1]])
                codes, back = np.unique(codes, return_inverse=True)
                counts = np.bincount(back, counts).astype(np.int64)
            held[lang] = codes, counts.astype(np.int64)
            if len(codes) > _FLUSH:
                yield rows(lang)
    for lang in list(held):
        yield rows(lang)


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   size: int = PROFILE) -> dict[str, list[int]]:
    """Profile of each language over all rows of ``docs`` (language: n-grams
    by rank). The result is ``size`` numbers a language."""
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(_counts, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)
    out: dict[str, list[tuple[int, int]]] = {}
    for r in top.select("lang", "gram", "rank").collect():
        out.setdefault(r.lang, []).append((r.rank, r.gram))
    return {lang: [g for _, g in sorted(out[lang])] for lang in sorted(out)}


class Ranker:
    """Out-of-place distances of a document to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.size = size
        self.langs = sorted(profiles)
        self.grams = np.unique(np.concatenate([np.array(profiles[x], np.int64) for x in self.langs] or
                                              [np.empty(0, np.int64)]))
        self.ranks = np.full((len(self.langs), len(self.grams)), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = ngrams(text) if text and self.langs else np.empty(0, np.int64)
        if not len(codes):
            return UNKNOWN, 0.0
        top = ranked(codes, self.size)
        at = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        there = self.ranks[:, at]
        out = np.abs(there - np.arange(len(top)))
        out[:, self.grams[at] != top] = self.size
        out[there < 0] = self.size
        distance = out.sum(axis=1) / (self.size * len(top))
        weight = np.exp(-20.0 * (distance - distance.min()))
        return self.langs[int(distance.argmin())], float(1.0 / weight.sum())


def identify(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text",
             size: int = PROFILE) -> DataFrame:
    """``docs`` with lang_pred and score (both replaced if already there)."""
    docs = rename_clashes(docs, ["lang_pred", "score"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        ranker = Ranker(profiles, size)
        for batch in pieces(batches, text_col, LEAN_BYTES):
            found = [ranker.predict(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(predict, extended(docs, "lang_pred string, score double"))
