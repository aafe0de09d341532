"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from typing import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import _sc, scratch_path

CHUNK_BYTES = 4 << 20      # text handled at once inside a task
LEAN_BYTES = 1 << 20       # where arrays hold many bytes for each byte of text
BATCH_BYTES = 8 << 20      # of an Arrow batch between the JVM and Python
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH_BYTES``. Spark's default of
    64 MB stands several times over in an executor (both directions, in the
    JVM's buffers and in Python) for each task that runs."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables (a parquet file or folder)."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file (installed with the environment on
    every machine; operators take any path instead)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps
    scan the files, and a lost executor costs no recomputation. The shuffle
    files of the write go as it ends: nothing reads them again, and by
    themselves they stay until the driver collects its garbage."""
    path = scratch_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What modules keep in a Python worker for its next task: functions that drop it.
KEPT: list[Callable[[], None]] = []


def release_kept() -> None:
    """Drop what other operators keep in this worker (vocabularies, memos) and
    give freed memory back. Called by tasks that need none of it, since Spark
    hands a worker from stage to stage."""
    for drop in KEPT:
        drop()
    pa.default_memory_pool().release_unused()      # Arrow keeps what batches used
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):          # another C library
        pass


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`staged` wrote once no later step reads them."""
    for df in tables:
        sc = _sc(df.sparkSession)
        if sc is None:                       # no file system at hand: they stay
            return
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            place = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(folder))
            place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def pieces(batches: Iterable[pa.RecordBatch], column: str,
           max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``max_bytes`` of ``column``
    (one row at least), so that a task's memory does not follow the batch."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.binary_length(batch.column(batch.schema.get_field_index(column)))
        ends = np.cumsum(np.nan_to_num(size.to_numpy(zero_copy_only=False).astype(np.float64), nan=0.0))
        start, base = 0, 0.0
        while start < n:
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            base = ends[stop - 1]
            start = stop


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The column's texts as UTF-8 bytes, without decoding."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def id_remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id's text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def rename_clashes(df: DataFrame, new: Iterable[str]) -> DataFrame:
    """Drop columns of ``df`` that an operator is about to add: its own
    columns win over input columns of the same name."""
    gone = {n.lower() for n in new}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns c0_, c1_, ... (so that an operator's own columns
    cannot clash with them), and the new name of each old one."""
    new = [f"c{i}_" for i in range(len(df.columns))]
    return df.toDF(*new), dict(zip(df.columns, new))


def extended(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` with more fields at its end."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

MapFn = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
