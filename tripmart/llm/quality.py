"""Quality classifier: logistic regression over hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

A text is a sequence of words: runs of letters and digits, and runs of other
printable characters. Its features are hashed n-grams of the words and of
their forms (lower case, capitalised, upper case, number, the mark itself; a
word equal to one of the two words before it is a repeat); none reaches over
the text's border, so a text scores alike after any other. A feature's value
is log(1 + count), scaled to unit length over the text, so a score is one
sparse dot product.

Training uses at most ``SAMPLE`` labelled rows (those with the smallest hash
of their id, a parameter), split over learners of about ``LEARNER_ROWS`` rows
that each make several passes of FTRL; their weights are averaged. The rarer
label counts as much as the other in total. Only the weights (``2 ** BITS``
numbers a learner) reach the driver. Every text is read whole
and every document is scored.

Defined cases: null, empty and blank texts have no features and get the
score of the intercept; null labels and ids are not learned from; an id with
several labels counts with the smallest; without labels every score is 0.5;
repeated rows score alike; input columns named like a result are replaced.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, pieces, rename_clashes, staged, text_bytes
from .jaccard_join import byte_run_hashes, mix

BITS = 18
TEXT_BYTES = 1 << 20    # text whose words are held at once
SAMPLE = 12_000
LEARNER_ROWS = 3_000    # rows of one FTRL learner
UPDATES = 9_000         # updates a learner makes at least (two passes at least)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 0.0

# byte -> kind: 0 blank or control, 1 lower-case letter or non-ASCII, 2 upper case, 3 digit, 4 other
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 4
_KIND[0x30:0x3A] = 3
_KIND[0x41:0x5B] = 2
_KIND[0x61:0x7B] = 1
_KIND[0x80:] = 1
# second bytes of the upper-case Latin-1 letters (after 0xC3)
_UPPER_TAIL = np.zeros(256, bool)
_UPPER_TAIL[0x80:0x9F] = True
_UPPER_TAIL[0x97] = False
_FORMS = np.array([0x1F83D9AB, 0x2545F491, 0x369DEA0F, 0x48C5D5C1, 0x5851F42D, 0x6A09E667], np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def features(texts: list[bytes | None], bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and values of each text."""
    none = np.empty(0, np.int64), np.empty(0, np.float32)
    buf = b"\n".join(t or b"" for t in texts)
    if not buf:
        return [none for _ in texts]
    raw = np.frombuffer(buf, np.uint8)
    kind = _KIND[raw]
    lead = np.flatnonzero((raw[:-1] == 0xC3) & _UPPER_TAIL[raw[1:]])
    kind[lead] = kind[lead + 1] = 2
    group = np.where(kind == 0, 0, np.where(kind == 4, 2, 1)).astype(np.int8)
    change = np.flatnonzero(np.diff(group)) + 1
    start = np.concatenate([[0], change])
    end = np.concatenate([change, [len(raw)]])
    solid = group[start] != 0
    start, end = start[solid], end[solid]
    if not len(start):
        return [none for _ in texts]
    word = byte_run_hashes(raw, start, end)
    # which words have one word, and which two, of their own text before them
    cut = np.searchsorted(start, np.cumsum([len(t or b"") + 1 for t in texts]))
    first = np.zeros(len(word) + 1, bool)
    first[0] = first[cut] = True
    second = ~first[1:-1]
    third = second[1:] & second[:-1]
    # a word's form
    count = lambda k: np.concatenate([[0], np.cumsum(kind == k)])
    up, low = count(2), count(1)
    ups, lows = up[end] - up[start], low[end] - low[start]
    first_up = kind[start] == 2
    form = np.where(ups == 0, np.where(lows == 0, 3, 0), np.where(lows == 0, 2, np.where(first_up, 1, 4)))
    mark = group[start] == 2
    shape = np.where(mark, word, _FORMS[form])
    repeat = np.zeros(len(word), bool)
    repeat[1:] |= second & (word[1:] == word[:-1])
    repeat[2:] |= third & (word[2:] == word[:-2])
    repeat &= ~mark
    shape = np.where(repeat, _FORMS[5], shape)
    one = word * np.uint64(3)
    two, shapes2, shapes3 = one.copy(), shape * np.uint64(5), shape * np.uint64(7)
    two[1:] = np.where(second, word[:-1] * np.uint64(11) + word[1:] * np.uint64(13), two[1:])
    shapes2[1:] = np.where(second, shape[:-1] * np.uint64(17) + shape[1:] * np.uint64(19), shapes2[1:])
    shapes3[2:] = np.where(third, shape[:-2] * np.uint64(23) + shape[1:-1] * np.uint64(29) + shape[2:] * np.uint64(31),
                           shapes3[2:])
    shift = np.uint64(64 - bits)
    grams = np.stack([(mix(x) >> shift).astype(np.int32) for x in (one, two, shapes2, shapes3)], axis=1)
    out, begin = [], 0
    for last in cut.tolist():
        if last == begin:
            out.append(none)
            continue
        at, n = np.unique(grams[begin:last], return_counts=True)
        value = np.log1p(n).astype(np.float32)
        out.append((at, value / np.sqrt((value * value).sum())))
        begin = last
    return out


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-max(-35.0, min(35.0, x))))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, updates: int = UPDATES,
         alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights after two passes or more (the last one is the intercept)."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    ones = sum(label for _, _, label in rows)
    balance = [len(rows) / (2.0 * max(1, k)) for k in (len(rows) - ones, ones)]
    rows = [(np.append(at, size - 1), np.append(value, np.float32(1.0)), label) for at, value, label in rows]

    for _ in range(max(2, -(-updates // max(1, len(rows))))):
        for at, x, label in rows:
            za, root = z[at], np.sqrt(n[at])
            w = np.where(np.abs(za) <= l1, 0.0, (np.sign(za) * l1 - za) / ((beta + root) / alpha + l2))
            g = (balance[label] * (_sigmoid(float(w @ x)) - label)) * x
            more = n[at] + g * g
            z[at] = za + g - (np.sqrt(more) - root) / alpha * w
            n[at] = more
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE, bits: int = BITS) -> np.ndarray:
    """Weights learned from at most ``sample`` of the labelled rows."""
    chosen = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
              .filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    chosen = staged(chosen, "quality-sample")
    learners = max(1, round(chosen.count() / LEARNER_ROWS))
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
            .join(F.broadcast(chosen), "id")              # at most ``sample`` rows of 12 bytes
            .select("id", "text", "label"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", TEXT_BYTES):
            found = features(text_bytes(b, "text"), bits)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([a for a, _ in found], pa.list_(pa.int32())),
                 pa.array([v for _, v in found], pa.list_(pa.float32()))], ["id", "label", "at", "value"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            for i in range(b.num_rows):
                held.append((b.column(1)[i].values.to_numpy().astype(np.int64), b.column(2)[i].values.to_numpy(),
                             int(b.column(0)[i].as_py())))
        if held:
            w = ftrl(held, bits)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(held)], pa.int64()), pa.array([at], pa.list_(pa.int64())),
                 pa.array([w[at]], pa.list_(pa.float64()))], ["n", "at", "w"])

    order = F.xxhash64("id", F.lit(7))
    made = rows.mapInArrow(extract, "id long, label int, at array<int>, value array<float>")
    made = (made.repartition(learners, F.pmod(order, F.lit(learners))).sortWithinPartitions(order, "id")
            .select("label", "at", "value"))
    total, out = 0, np.zeros((1 << bits) + 1)
    for r in made.mapInArrow(learn, "n long, at array<long>, w array<double>").collect():
        out[r["at"]] += np.array(r["w"]) * r["n"]
        total += r["n"]
    return (out / max(1, total)).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with a score (0 to 1; higher: label 1 is likelier)."""
    docs = rename_clashes(docs, ["score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias = float(weights[-1])
        for b in pieces(batches, text_col, TEXT_BYTES):
            found = features(text_bytes(b, text_col), bits)
            values = [_sigmoid(bias + float(weights[a] @ v)) for a, v in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, pa.float64())], [*b.schema.names, "score"])

    return docs.mapInArrow(run, extended(docs, "score double"))
