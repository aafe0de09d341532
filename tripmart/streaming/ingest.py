"""Incremental file load with Structured Streaming.

The scheduled monthly load with backfill becomes: process the files in a
landing folder that have not been seen yet, each exactly once. A file
source remembers processed files in its checkpoint; ``availableNow`` runs
what is there and stops; ``maxFilesPerTrigger`` bounds one micro-batch, and
a large backlog is loaded many files at a time. Within a micro-batch a key
comes from the first file (by name) that holds it, with that file's
repeats: the result is the same for any number of files per batch.
``foreachBatch`` merges each batch insert-only into the target, so a
replayed batch after a failure adds nothing. No watermark is needed: the
state is the target table.

With a quarantine folder, rows that the reader reported in ``bad_columns`` go
there instead. A micro-batch is written once and both sinks read that table;
the bad rows of a batch are the folder of its id, which a replay writes anew,
so neither sink gets a row twice.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge as MG
from ..session import scratch_path
from ..sinks.writers import persist_table

FILES_PER_BATCH = 1000


def file_stream(spark: SparkSession, landing: str, schema, fmt: str = "parquet",
                files_per_batch: int = FILES_PER_BATCH, **options) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(landing)


def ingest_available(spark: SparkSession, landing: str, schema, target_path: str,
                     checkpoint: str, key: str, ts_col: str, date_col: str = "event_date",
                     prepare: Callable[[DataFrame], DataFrame] | None = None,
                     fmt: str = "parquet", files_per_batch: int = FILES_PER_BATCH,
                     key_holds_date: bool = False, quarantine: str | None = None, **options) -> int:
    """Run one availableNow pass; returns the number of micro-batches run.
    ``quarantine``: folder of the rows whose ``bad_columns`` (an array that
    ``prepare`` adds) is not empty, partitioned by the batch's id."""
    stream = file_stream(spark, landing, schema, fmt, files_per_batch, **options)
    stream = stream.withColumn("_file", F.col("_metadata.file_path"))
    if prepare is not None:
        stream = prepare(stream)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if quarantine is not None:
            batch = split_bad(batch, batch_id, quarantine)
        MG.append_new(batch.sparkSession, batch, target_path, key=key, ts_col=ts_col, date_col=date_col,
                      key_holds_date=key_holds_date, first_by="_file", keep_first_by=False)

    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    progress = q.recentProgress
    return sum(1 for p in progress if p.get("numInputRows", 0) > 0)


def split_bad(batch: DataFrame, batch_id: int, quarantine: str) -> DataFrame:
    """Write the batch once, put its bad rows into their own folder, and
    return the good ones."""
    rows = persist_table(batch, scratch_path(batch.sparkSession, "stream_batch"))
    is_bad = F.size("bad_columns") > 0
    rows.filter(is_bad).write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
    return rows.filter(~is_bad).drop("bad_columns")


def land_files_by_day(df: DataFrame, landing: str, ts_col: str, mode: str = "errorifexists") -> None:
    """Write a table into a landing folder as files range-partitioned by the
    day of ``ts_col`` (consecutive days per file, as drops arrive)."""
    day = F.to_date(F.col(ts_col))
    df.repartitionByRange(day).sortWithinPartitions(ts_col).write.mode(mode).parquet(landing)
