"""Sequence packing: shortest pack first over the length histogram.

Documents become token ids; a document is cut into full pieces of ``size``
ids and one remainder. The histogram of piece lengths (at most ``size``
rows) is all that reaches the driver: lengths are placed longest first, each
into the emptiest open pack that holds it, for whole counts at a time, which
gives packing patterns with counts. A piece then finds its place by its rank
among the pieces of its length: ranks are a task-local count plus the counts
of the tasks before it, so no task sees all pieces of a length.

Defined cases: a null or empty text is just the end id; null and repeated
ids are packed like any other row; an empty table gives no piece; input
columns other than id and text are not read.

Scale: one pass over the texts, written once with the ids; the placement
joins (task, length) counts and looks patterns up in a table of at most a
few thousand rows. A length that a third of all pieces share (full pieces)
is spread over all tasks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import extended, pieces as slices, release_kept, staged

SIZE = 1024


@dataclass
class Pattern:
    """``count`` packs that hold pieces of these lengths."""
    count: int
    lengths: tuple[int, ...]


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Packing patterns that place every piece of the histogram once."""
    open_: dict[int, list[Pattern]] = {}          # by space left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max((s for s, p in open_.items() if p), default=0)
            if space >= length:                    # the shortest pack first
                p = open_[space].pop()
                n = min(p.count, left)
                if p.count > n:
                    open_[space].append(Pattern(p.count - n, p.lengths))
                open_.setdefault(space - length, []).append(Pattern(n, p.lengths + (length,)))
                left -= n
            else:                                  # new packs, as full as this length makes them
                per = min(size // length, left)
                n = left // per
                open_.setdefault(size - per * length, []).append(Pattern(n, (length,) * per))
                left -= n * per
    return [p for space in sorted(open_) for p in open_[space]]


@dataclass
class Places:
    """For each length the rank intervals of its slots (sorted arrays)."""
    key: np.ndarray          # length << 40 | first rank
    sequence: np.ndarray     # sequence of the first rank
    offset: np.ndarray

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        want = (length.astype(np.int64) << 40) | rank
        at = np.searchsorted(self.key, want, side="right") - 1
        return self.sequence[at] + (want - self.key[at]), self.offset[at]


def places(patterns: list[Pattern]) -> Places:
    rows, used, sequence = [], {}, 0
    for p in patterns:
        offset = 0
        for length in p.lengths:
            first = used.get(length, 0)
            rows.append(((length << 40) | first, sequence, offset))
            used[length] = first + p.count
            offset += length
        sequence += p.count
    rows.sort()
    out = np.array(rows, np.int64).reshape(-1, 3)
    return Places(out[:, 0], out[:, 1], out[:, 2])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool = True, size: int = SIZE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, ids (little-endian),
    the task that made it and its number among that task's pieces of its length."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.spark_partition_id().alias("part"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer, spaced)
        w, end = enc.width, int(end_id).to_bytes(enc.width, "little")
        seen = np.zeros(size + 1, np.int64)
        for b in slices(batches, "text", tokens.TEXT_BYTES):
            own, start, ids, total, nth = [], [], [], [], []
            for i, raw in enumerate(enc.encode_all(b.column(b.schema.get_field_index("text")).to_pylist())):
                raw += end
                n = len(raw) // w
                for s in range(0, n, size):
                    piece = raw[s * w:(s + size) * w]
                    length = len(piece) // w
                    own.append(i)
                    start.append(s)
                    ids.append(piece)
                    total.append(n)
                    nth.append(int(seen[length]))
                    seen[length] += 1
            at = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays([
                b.column(b.schema.get_field_index("id")).take(at), pa.array(start, pa.int64()),
                pa.array([len(x) // w for x in ids], pa.int64()), pa.array(total, pa.int64()),
                pa.array(ids, pa.binary()), b.column(b.schema.get_field_index("part")).take(at),
                pa.array(nth, pa.int64())], ["id", "start", "length", "doc_tokens", "ids", "part", "nth"])

    out = rows.mapInArrow(run, f"id {id_type}, start long, length long, doc_tokens long, ids binary, part int, nth long")
    return out.withColumnRenamed("id", id_col)


def place(made: DataFrame, size: int = SIZE, digest: bool = False) -> DataFrame:
    """``made`` (staged pieces, with any other columns) with sequence_id and
    offset instead of the task's numbers; with ``digest`` ids_crc32 instead of
    the ids."""
    counts = staged(made.groupBy("part", "length").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found = places(shortest_pack_first(histogram, size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = staged(counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                  "pack-ranks")
    ranked = made.join(base, ["part", "length"])
    keep = [c for c in made.columns if c not in ("part", "nth")]
    ranked = ranked.select(*keep, (F.col("before") + F.col("nth")).alias("rank"))
    at = keep.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()                # the texts are encoded by now
        for b in slices(batches, "ids"):
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            sequence, offset = found.find(length, b.column(b.num_columns - 1).to_numpy())
            cells, names = list(b.columns[:-1]), list(b.schema.names[:-1])
            if digest:
                cells[at] = pa.array(checksums(b.column(at).to_pylist(), length.tolist()), pa.int64())
                names[at] = "ids_crc32"
            yield pa.RecordBatch.from_arrays([*cells, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    out = ranked.drop("rank")
    if digest:
        out = out.withColumn("ids", F.lit(0).cast("bigint")).withColumnRenamed("ids", "ids_crc32")
    return ranked.mapInArrow(run, extended(out, "sequence_id long, offset long"))


def pack(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool = True, size: int = SIZE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its ids, sequence_id and offset."""
    return place(staged(token_pieces(docs, tokenizer, end_id, spaced, size, id_col, text_col), "pack-pieces"), size)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids joined in order and its number of ids
    (at most ``size`` pieces a group)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "length")))
    return (packed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"),
                    F.expr("aggregate(p, 0L, (a, x) -> a + x.length)").alias("n_tokens")))


def crc_of(ids: bytes, width: int) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())


def checksums(ids: list[bytes], lengths: list[int]) -> list[int]:
    return [crc_of(x, len(x) // k if k else 4) for x, k in zip(ids, lengths)]


def with_crc(df: DataFrame, length_col: str = "length") -> DataFrame:
    """``df`` with ids_crc32 instead of the ids."""
    at, n = df.columns.index("ids"), df.columns.index(length_col)
    rest = [c for c in df.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for b in slices(batches, "ids"):
            crc = checksums(b.column(at).to_pylist(), b.column(n).to_pylist())
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(b.columns) if i != at] + [pa.array(crc, pa.int64())],
                                             [*rest, "ids_crc32"])

    return df.mapInArrow(run, extended(df.drop("ids"), "ids_crc32 long"))
