"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last ``WINDOW`` bytes ends a chunk wherever its low
``level`` bits are zero, so chunk borders depend on content alone and an edit
moves only the borders near it. A chunk's hash becomes one letter of a
signature. The level starts where about ``LETTERS`` chunks are expected of a
text of this length and falls while there are fewer than half as many; a
signature holds at most ``LETTERS`` letters, the last one for all the rest of
the text. A fingerprint is ``block:signature:signature:signature`` at block
sizes ``block``, twice and four times that (block = 2**level).

Two fingerprints are compared at the block sizes they share: 1 - edit
distance / longer length, if the signatures share a run of letters (``RUN``,
or half the shorter one if that is less), else 0; the best block size counts.
Fingerprints without a common block size have likeness 0, equal ones 1.

Defined cases: a null text is empty; an empty text's fingerprint is ``1:::``
and like itself only; equal texts have equal fingerprints. In
:func:`compare_next` rows are in order of id, null ids first, rows of one id
in order of their text's hash; a table of one row is its own next; an empty
table gives an empty result; columns other than id and text are not read.

Scale: a text is hashed in blocks of ``BLOCK`` bytes, so working memory does
not follow its length. :func:`compare_next` deals rows to ranges of
(id, text hash, row number) and sorts them, the only shuffle of texts; one
pass over each range compares neighbours. The first and last row of each
range (as many as shuffle partitions) meet in a join.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, staged, text_bytes

WINDOW = 7
LETTERS = 64
LEVELS = 3            # block sizes in a fingerprint
RUN = 7
BLOCK = 1 << 18       # bytes hashed at once

_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_CODE = np.random.RandomState(20240613).randint(1, 2**31, 256).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_BASE = np.uint32(0x01000193)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def _rolling(text: bytes, start: int, stop: int) -> np.ndarray:
    """Mixed hash of the window ending at each byte of [start, stop)."""
    first = max(0, start - WINDOW + 1)
    code = np.zeros(stop - start + WINDOW - 1, np.uint32)
    code[WINDOW - 1 - (start - first):] = _CODE[np.frombuffer(text, np.uint8, stop - first, first)]
    n = stop - start
    h = code[:n].copy()
    for k in range(1, WINDOW):
        h *= _BASE
        h += code[k:k + n]
    return _mix(h)


def _blocks(text: bytes) -> Iterator[np.ndarray]:
    for start in range(0, len(text), BLOCK):
        yield _rolling(text, start, min(start + BLOCK, len(text)))


def _signature(blocks, level: int) -> str:
    """One letter per chunk, the last for all that follows."""
    mask, sums, open_ = np.uint32((1 << level) - 1), [], 0
    pending = False                    # bytes after the last border
    for h in blocks:
        value = (h * np.uint32(0x9E3779B1)) >> np.uint32(8)      # 24 bits: sums of a block are exact
        room = LETTERS - 1 - len(sums)
        border = np.flatnonzero((h & mask) == 0)[:max(room, 0)] + 1
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(value, dtype=np.int64)])
        part = np.diff(total[np.unique(np.concatenate([[0], border, [len(h)]]))]).tolist()
        whole = part[:len(border)]
        if whole:
            whole[0] += open_
            sums += whole
            open_, pending = 0, False
        if len(part) > len(border):
            open_, pending = open_ + part[-1], True
    if pending:
        sums.append(open_)
    if not sums:
        return ""
    letters = _mix(np.array([s & 0xFFFFFFFF for s in sums], np.uint32)) >> np.uint32(26)
    return _LETTERS[letters].tobytes().decode()


def fingerprint(text: bytes) -> str:
    """``block:signature:signature:signature`` of a text in UTF-8."""
    # a text of one block is hashed once, a longer one again for each level
    held = [_rolling(text, 0, len(text))] if len(text) <= BLOCK else None

    def blocks():
        return held if held is not None else _blocks(text)

    level = 0
    while LETTERS << level < len(text):
        level += 1
    while level and sum(int(np.count_nonzero((h & np.uint32((1 << level) - 1)) == 0)) for h in blocks()) < LETTERS // 2:
        level -= 1
    return ":".join([str(1 << level), *(_signature(blocks(), level + k) for k in range(LEVELS))])


# --- comparison -----------------------------------------------------------------------

def _codes(words: list[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters as a matrix of ``LETTERS`` columns, and the lengths."""
    raw = b"".join(w.encode().ljust(LETTERS, bytes([fill])) for w in words)
    return np.frombuffer(raw, np.uint8).reshape(-1, LETTERS), np.array([len(w) for w in words])


def distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distances of pairs of signatures, all pairs at once: each row of
    the distance table is held as two words of up and down steps."""
    x, m = _codes(a, 1)
    y, n = _codes(b, 2)
    one = np.uint64(1)
    bit = one << np.arange(LETTERS, dtype=np.uint64)
    up, down = np.full(len(x), ~np.uint64(0)), np.zeros(len(x), np.uint64)
    score, last = m.copy(), one << np.maximum(m - 1, 0).astype(np.uint64)
    for j in range(int(n.max(initial=0))):
        same = np.where(x == y[:, j:j + 1], bit, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        flat = (((same & up) + up) ^ up) | same | down
        rise, fall = down | ~(flat | up), up & flat
        on = j < n
        score += on * ((rise & last != 0).astype(np.int64) - (fall & last != 0))
        rise = (rise << one) | one
        up, down = (fall << one) | ~((same | down) | rise), rise & (same | down)
    return np.where(m == 0, n, score)


def _share_a_run(a: str, b: str) -> bool:
    k = min(RUN, (min(len(a), len(b)) + 1) // 2)
    if not k:
        return False
    seen = {a[i:i + k] for i in range(len(a) - k + 1)}
    return any(b[i:i + k] in seen for i in range(len(b) - k + 1))


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness (0 to 1) of pairs of fingerprints."""
    out = np.zeros(len(a))
    at, left, right = [], [], []
    for i, (f, g) in enumerate(zip(a, b)):
        if f == g:
            out[i] = 1.0
            continue
        (p, *s), (q, *t) = f.split(":"), g.split(":")
        p, q = int(p), int(q)
        by_size = {q << k: w for k, w in enumerate(t)}
        for k, w in enumerate(s):
            other = by_size.get(p << k)
            if other is not None and _share_a_run(w, other):
                at.append(i)
                left.append(w)
                right.append(other)
    if at:
        most = np.array([max(len(v), len(w)) for v, w in zip(left, right)])
        np.maximum.at(out, np.array(at), 1 - distances(left, right) / most)
    return out


# --- DataFrames -----------------------------------------------------------------------

def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars and fingerprint of every document."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.char_length(text).cast("long").alias("n_chars"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([fingerprint(t) for t in text_bytes(b, "text")])],
                                             ["id", "n_chars", "fingerprint"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as many first characters of another."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


_NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(ids: list, texts: list[str], marks: list[str], nexts: list[str], next_marks: list[str], kind: pa.DataType) -> pa.RecordBatch:
    """Result rows of texts and the texts after them."""
    other = [edited(t, u).encode() for t, u in zip(texts, nexts)]
    other_marks = [m if o == t.encode() else fingerprint(o) for m, o, t in zip(marks, other, texts)]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, kind), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(o).hexdigest() for o in other], pa.string()), pa.array(marks, pa.string()),
        pa.array(other_marks, pa.string()), pa.array(likeness(marks, other_marks)), pa.array(likeness(marks, next_marks))],
        _NAMES)


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text (see :func:`edited`,
    with the next document's text), and the likeness to it and to the next document's."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc_nulls_first(), "hash", "row"]
    ranged = (rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
              .repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .select("id", "text", F.spark_partition_id().alias("part")))
    schema = (f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    # a range's last row waits for the next range's first: both come with their text
    whole = f"{schema}, part int, place string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept = None, None                       # the last row so far: id, text, fingerprint

        def border(place: str) -> pa.RecordBatch:
            i, t, m = held
            cells = {"id": pa.array([i], kept), "n_chars": pa.array([len(t)]), "fingerprint": pa.array([m]),
                     "part": pa.array([part], pa.int32()), "place": pa.array([place]), "text": pa.array([t])}
            none = {"near_edited": pa.float64(), "near_next": pa.float64()}
            return pa.RecordBatch.from_arrays(
                [cells[n] if n in cells else pa.nulls(1, none.get(n, pa.string())) for n in [*_NAMES, "part", "place", "text"]],
                [*_NAMES, "part", "place", "text"])

        for b in pieces(batches, "text"):
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            part, kept = b.column(2)[0].as_py(), b.column(0).type
            marks = [fingerprint(t.encode()) for t in texts]
            if held is None:
                held = ids[0], texts[0], marks[0]
                yield border("first")
                held = None
            else:
                ids, texts, marks = [held[0], *ids], [held[1], *texts], [held[2], *marks]
            held = ids[-1], texts[-1], marks[-1]
            out = _compared(ids[:-1], texts[:-1], marks[:-1], texts[1:], marks[1:], kept)
            n = out.num_rows
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())],
                [*_NAMES, "part", "place", "text"])
        if held is not None:
            yield border("last")

    made = staged(ranged.mapInArrow(run, whole), "piecewise")
    inner = made.filter("place IS NULL").select(*_NAMES)
    first = made.filter("place = 'first'").select("part", F.col("text").alias("next"), F.col("fingerprint").alias("mark"))
    used = sorted(r.part for r in first.select("part").collect())             # at most one number a shuffle partition
    if not used:
        return inner.withColumnRenamed("id", id_col)
    after = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "part int, following int")
    last = (made.filter("place = 'last'").select("id", "text", "fingerprint", "part").join(F.broadcast(after), "part")
            .join(first.withColumnRenamed("part", "following"), "following")
            .select("id", "text", "fingerprint", "next", "mark"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            yield _compared(*(b.column(i).to_pylist() for i in range(3)), *(b.column(i).to_pylist() for i in (3, 4)),
                            b.column(0).type)

    return inner.unionByName(last.mapInArrow(ends, schema)).withColumnRenamed("id", id_col)
