"""Token-id store: zstandard frames with one shared dictionary.

Every document's ids are one zstandard frame, compressed on its own with a
dictionary trained on serialized id arrays, so a short document is read
without its neighbours. Layout of a store folder (written by Spark, so it
works on any file system and a lost task leaves nothing behind):

``dictionary``  one row: sha256 of the dictionary, its bytes, bytes per id
``blocks``      rows (part, seq, first_id, last_id, n_docs, n_tokens, start,
                payload), in ascending id order; ``start`` counts the ids
                before the block within its part
``parts``       rows (part, start): ids before each part

A payload is ``TIDS``, version, bytes per id, the dictionary's 32-byte
sha256, the number of documents, then the index (id, a flag for a null id,
number of tokens, end offset of the frame) and the frames.

The dictionary only makes frames smaller; it is trained on a sample of at
most ``SAMPLE_DOCS`` documents of at most ``SAMPLE_TOKENS`` ids (the ones
with the smallest hash of their id), both parameters. Ids come back equal
whatever the sample was. Everything else covers all rows.

Defined cases: null and empty texts hold just the end id; null ids sort
first; repeated ids keep their order by content; an empty table gives an
empty store that reads back empty.
"""

from __future__ import annotations

import hashlib
import struct
from typing import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import pieces, staged

SAMPLE_DOCS = 2_000
SAMPLE_TOKENS = 2_048
DICTIONARY_BYTES = 64 << 10
BLOCK_DOCS = 512
BLOCK_BYTES = 1 << 20
LEVEL = 3
_MAGIC = b"TIDS"
_HEAD = struct.Struct("<4sBB32sI")


# --- payloads ---------------------------------------------------------------------

def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialized id arrays; empty if there is too little
    to train on (frames then need none)."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def write_payload(ids: list[int | None], frames: list[bytes], n_tokens: list[int], width: int, digest: bytes) -> bytes:
    n = len(ids)
    index = [np.array([0 if i is None else i for i in ids], "<i8"), np.array([i is None for i in ids], np.uint8),
             np.array(n_tokens, "<u4"), np.cumsum([len(f) for f in frames], dtype="<u8")]
    return b"".join([_HEAD.pack(_MAGIC, 1, width, digest, n), *(a.tobytes() for a in index), *frames])


class Payload:
    """Random access to one block."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, version, self.width, digest, n = _HEAD.unpack_from(data)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a token block")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        at = _HEAD.size
        values = np.frombuffer(data, "<i8", n, at)
        null = np.frombuffer(data, np.uint8, n, at + 8 * n)
        self.ids = [None if z else int(v) for v, z in zip(values, null)]
        self.n_tokens = np.frombuffer(data, "<u4", n, at + 9 * n).astype(np.int64)
        self.ends = np.frombuffer(data, "<u8", n, at + 13 * n).astype(np.int64)
        self.base = at + 21 * n
        self.data = data
        self.reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def read(self, i: int) -> bytes:
        """The ids of the block's i-th document."""
        start = int(self.ends[i - 1]) if i else 0
        frame = self.data[self.base + start:self.base + int(self.ends[i])]
        return self.reader.decompress(frame, max_output_size=int(self.n_tokens[i]) * self.width)


# --- writing ----------------------------------------------------------------------

def encode(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids) of every row, the end id included."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer, spaced)
        end = int(end_id).to_bytes(enc.width, "little")
        for b in pieces(batches, "text", tokens.TEXT_BYTES):
            ids = [x + end for x in enc.encode_all(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // enc.width for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["id", "n_tokens", "ids"])

    return rows.mapInArrow(run, "id long, n_tokens long, ids binary")


def write_store(encoded: DataFrame, path: str, width: int, sample_docs: int = SAMPLE_DOCS,
                sample_tokens: int = SAMPLE_TOKENS) -> None:
    """Write (id, n_tokens, ids) rows as a store; ``encoded`` is read three
    times, so pass a written table."""
    spark = encoded.sparkSession
    brief = encoded.filter(F.col("n_tokens") <= sample_tokens).withColumn("h", F.xxhash64("id", F.crc32("ids")))
    # hashes alone are ranked; only the chosen rows' ids then reach the driver
    chosen = staged(brief.select("h").orderBy("h").limit(sample_docs), "token-sample")
    sample = brief.join(F.broadcast(chosen.distinct()), "h", "left_semi").orderBy("h").limit(sample_docs).select("ids").collect()
    data = train([bytes(r.ids) for r in sample])
    digest = hashlib.sha256(data).digest()
    spark.createDataFrame([(digest.hex(), data, width)], "sha256 string, dictionary binary, width int") \
        .coalesce(1).write.parquet(f"{path}/dictionary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_checksum=False)
        ids: list[int | None] = []
        frames: list[bytes] = []
        counts: list[int] = []
        part, seq, start, size = 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, frames, counts, seq, start, size
            out = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([ids[0]], pa.int64()),
                pa.array([ids[-1]], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([sum(counts)], pa.int64()),
                pa.array([start], pa.int64()), pa.array([write_payload(ids, frames, counts, width, digest)], pa.binary())],
                ["part", "seq", "first_id", "last_id", "n_docs", "n_tokens", "start", "payload"])
            seq, start, size = seq + 1, start + sum(counts), 0
            ids, frames, counts = [], [], []
            return out

        for b in pieces(batches, "ids"):
            part = b.column(3)[0].as_py()
            for i, n, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                frame = packer.compress(raw)
                ids.append(i)
                counts.append(n)
                frames.append(frame)
                size += len(frame)
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield close()
        if ids:
            yield close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.crc32("ids")                       # repeated ids: any number of tasks, a fixed order
    ordered = (encoded.repartitionByRange(parts, F.col("id").asc_nulls_first(), tie)
               .sortWithinPartitions(F.col("id").asc_nulls_first(), tie, "ids")
               .select("id", "n_tokens", "ids", F.spark_partition_id().alias("part")))
    schema = ("part int, seq long, first_id long, last_id long, n_docs long, n_tokens long, start long, payload binary")
    ordered.mapInArrow(blocks, schema).write.option("compression", "none").parquet(f"{path}/blocks")
    # one row per part (as many as shuffle partitions) reaches the driver
    totals = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    rows, before = [], 0
    for r in sorted(totals, key=lambda r: r.part):
        rows.append((r.part, before))
        before += r.n
    spark.createDataFrame(rows, "part int, part_start long").coalesce(1).write.parquet(f"{path}/parts")


# --- reading ----------------------------------------------------------------------

def _head(spark: SparkSession, path: str) -> tuple[bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return bytes(row.dictionary), row.width


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids) of every document of a store."""
    data, _ = _head(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                block = Payload(payload, data)
                begin = first + np.concatenate([[0], np.cumsum(block.n_tokens)[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids, pa.int64()), pa.array(begin), pa.array(block.n_tokens),
                     pa.array([block.read(i) for i in range(len(block.ids))], pa.binary())],
                    ["id", "start", "n_tokens", "ids"])

    parts = spark.read.parquet(f"{path}/parts")       # a row for each shuffle partition
    blocks = (spark.read.parquet(f"{path}/blocks").join(F.broadcast(parts), "part")
              .select((F.col("start") + F.col("part_start")).alias("start"), "payload"))
    return blocks.mapInArrow(run, "id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> np.ndarray | None:
    """The ids of one document: the block statistics find its block, the
    block's index its frame; nothing else is decompressed."""
    data, width = _head(spark, path)
    rows = (spark.read.parquet(f"{path}/blocks")
            .filter((F.coalesce("first_id", F.lit(-2**63)) <= doc_id) & (F.col("last_id") >= doc_id))
            .select("payload").collect())
    for r in rows:
        block = Payload(bytes(r.payload), data)
        if doc_id in block.ids:
            return np.frombuffer(block.read(block.ids.index(doc_id)), f"<u{width}").astype(np.int64)
    return None


def store(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaced: bool, width: int = 2,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode ``docs``, write the store, and read it back."""
    write_store(staged(encode(docs, tokenizer, end_id, spaced, id_col, text_col), "token-ids"), path, width)
    return read_store(docs.sparkSession, path)
