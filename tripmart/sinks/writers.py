"""Sinks and materialization.

Writers are thin on purpose: they are Spark's own writers with the options
the reference's loads need (overwrite vs. error, partition + cluster
layout, create-if-absent, views vs. tables).
"""

from __future__ import annotations

import uuid
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..session import ROWS_PER_TASK, cores, small_tasks
from ..sources import readers as R


def write_parquet(df: DataFrame, path: str, n: int | None = None, mode: str = "errorifexists") -> None:
    """K1: ``repartition(n)`` (a round-robin shuffle, even file sizes), then parquet."""
    (df.repartition(n) if n else df).write.mode(mode).parquet(path)


def _table_writer(df: DataFrame, mode: str, path: str | None):
    """A parquet table writer: managed, or at ``path``."""
    w = df.write.mode(mode).format("parquet")
    return w.option("path", path) if path else w


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a table's rows without a gap: the new rows are written to a
    fresh folder (below ``path``, or beside the table's own), then the table
    is pointed at it. Readers see the old rows until then, a query that began
    earlier finishes on the old files, and a failed write changes nothing.
    Old folders stay until :func:`remove_versions`. Only where the columns
    change is the catalog entry dropped and made anew, after the write."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if not exists and not path:
        df.write.format("parquet").saveAsTable(name)
        return spark.table(name)
    base = path or table_location(spark, name).rstrip("/")
    place = f"{base}/{VERSION}{uuid.uuid4().hex[:12]}" if path else f"{base}-{VERSION}{uuid.uuid4().hex[:12]}"
    df.write.parquet(place)
    same = exists and [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(place)}")
        spark.catalog.refreshTable(name)
    else:
        if exists:
            spark.sql(f"DROP TABLE {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION {_text(place)}")
    return spark.table(name)


VERSION = "version-"


def table_location(spark: SparkSession, name: str) -> str:
    """Where a table's files lie now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()     # one row
    return rows[0].data_type


def remove_versions(spark: SparkSession, name: str, path: str) -> int:
    """Remove the folders below ``path`` that :func:`replace_table` left and
    the table no longer uses; returns their number."""
    jvm, now = spark.sparkContext._jvm, table_location(spark, name).rstrip("/")
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [f.getPath() for f in fs.listStatus(base)
            if f.getPath().getName().startswith(VERSION) and f.getPath().getName() != now.rsplit("/", 1)[1]]
    for place in gone:
        fs.delete(place, True)
    return len(gone)


def load_overwrite(spark: SparkSession, name: str, glob: str, fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Bulk load files into a table, replacing its contents without a gap."""
    return replace_table(spark.read.format(fmt).load(glob), name, path)


def persist_table(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write a model once to the shared folder and read it back: later
    plans scan the written files instead of re-deriving the model, and a
    lost executor recomputes from the files (lineage cut), not from raw."""
    df.write.mode("errorifexists").options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def csv_to_parquet(spark: SparkSession, src: str, dst: str, service: str, n: int | None = None,
                   filename: bool = False) -> None:
    """K2: typed CSV to parquet; skipped when the target exists (mode ignore)."""
    df = R.read_trips_csv(spark, src, service, filename=filename)
    (df.repartition(n) if n else df).write.mode("ignore").parquet(dst)


def export_data(df: DataFrame, path: str, overwrite: bool = False,
                partition_by: Sequence[str] = ()) -> None:
    """K3: export a result. Without ``overwrite`` an existing target is an
    error; with ``partition_by`` and overwrite only the partitions present
    in ``df`` are replaced (dynamic overwrite), the others stay."""
    w = df.write.mode("overwrite" if overwrite else "errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def create_table_as(df: DataFrame, name: str, replace: bool = True, path: str | None = None) -> None:
    """K4: CTAS / CREATE OR REPLACE TABLE (readers never meet a missing table)."""
    if replace:
        replace_table(df, name, path)
    else:
        _table_writer(df, "errorifexists", path).saveAsTable(name)


def with_date_column(df: DataFrame, ts_col: str, date_col: str | None = None) -> DataFrame:
    return df.withColumn(date_col or f"{ts_col}_date", F.to_date(F.col(ts_col)))


def write_partitioned(df: DataFrame, path: str, ts_col: str, cluster_by: Sequence[str] = (),
                      date_col: str | None = None, mode: str = "overwrite") -> str:
    """K5: partition by the date of ``ts_col``, cluster (sort) within files.
    ``mode="overwrite"`` replaces the whole table, older dates included.

    The input is read once: rows are dealt by date and rebalanced by the sizes
    that the shuffle itself measured (no sampling pass). Small dates share a
    task, a large or hot date is split over as many as its size needs. Files
    are sorted by the clustering columns so parquet row-group statistics skip
    blocks. Returns the partition column name (filter on it to prune).
    """
    date_col = date_col or f"{ts_col}_date"
    out = with_date_column(df, ts_col, date_col).hint("rebalance", date_col)
    out = out.sortWithinPartitions(date_col, *cluster_by)
    (out.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(date_col).parquet(path))
    return date_col


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_table(spark: SparkSession, name: str, schema: T.StructType | str,
                 partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """K6: CREATE TABLE IF NOT EXISTS with a fixed schema (comments kept)."""
    cols = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT {_text(f.metadata['comment'])}" if f.metadata.get("comment") else "")
        for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part}{loc}")


# What the columns that the trip loads add hold; other columns are the file's own.
TARGET_COMMENTS = {
    "unique_row_id": "Hash of the trip's key fields; identifies the row.",
    "filename": "Name of the file the row was loaded from.",
}


def trips_table_schema(service: str) -> T.StructType:
    """K6: columns of a service's target table: row id, file name, then the
    file's columns in their order, and the pickup date that partitions it."""
    added = [("unique_row_id", "binary"), ("filename", "string")]
    fields = T.StructType.fromDDL(R.ddl([*added, *R.CSV_COLUMNS[service], ("pickup_date", "date")])).fields
    for f in fields:
        f.metadata = {"comment": TARGET_COMMENTS.get(f.name, f"Column {f.name} of the {service} trip file.")}
    return T.StructType(fields)


def ensure_trips_table(spark: SparkSession, name: str, service: str, path: str | None = None) -> None:
    """K6: the target table of a service, made once, partitioned by pickup date."""
    ensure_table(spark, name, trips_table_schema(service), partition_by=["pickup_date"], path=path)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """K7: truncate-and-load staging: the table holds this batch only."""
    return replace_table(df, name, path)


def write_table(df: DataFrame, name: str, mode: str = "append", path: str | None = None) -> None:
    """K9: replace ('overwrite', without a gap) or add to ('append') a table."""
    if mode == "overwrite":
        replace_table(df, name, path)
    elif mode == "append" and df.sparkSession.catalog.tableExists(name):
        df.select(*df.sparkSession.table(name).columns).write.insertInto(name)
    else:
        _table_writer(df, mode, path).saveAsTable(name)


def model_schema(spark: SparkSession, model_kind: str, schemas: Mapping[str, str] | None = None) -> str:
    """V2: the schema (database) a model goes to by its kind, made if new:
    from ``schemas``, else from the environment (:func:`config.schema_for`)."""
    schema = (schemas or {}).get(model_kind) or config.schema_for(model_kind)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    return schema


def materialize(df: DataFrame, name: str, kind: str = "view", model_kind: str | None = None,
                path: str | None = None, schemas: Mapping[str, str] | None = None) -> DataFrame:
    """A model as a temp view ('view'), a table ('table') or
    nothing ('ephemeral': the DataFrame is inlined where it is used). With a
    ``model_kind`` a table goes to that kind's schema (V2)."""
    if kind == "table" and model_kind:
        name = f"{model_schema(df.sparkSession, model_kind, schemas)}.{name}"
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind == "table":
        return replace_table(df, name, path)
    if kind == "ephemeral":
        return df
    raise ValueError(f"unknown materialization {kind!r}")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one file per partition."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    """CSV with a header line and the trip files' timestamp text; a folder
    for each value of ``partition_by``."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)      # a hot value is split over several files
    _csv_writer(df, mode, partition_by).csv(path)


def _csv_writer(df: DataFrame, mode: str, partition_by: Sequence[str]):
    w = df.write.mode(mode).option("header", True).option("timestampNTZFormat", R.CSV_TIMESTAMP_FORMAT)
    return w.partitionBy(*partition_by) if partition_by else w


OPEN_MONTHS = 32         # files that a task keeps open while it writes months


def write_month_files(raw: DataFrame, path: str, service: str, filename: Column,
                      ts_col: str = "pickup_datetime") -> None:
    """Raw trips as the service's monthly files: gzipped CSV in the files'
    columns, a folder for each ``filename`` (a column over ``raw``).

    Rows are dealt once, as they are stored: the files' wider types are made
    where they are written. They are dealt by ranges of days, a hot day to
    several tasks, so that a file holds few dates (a load by date finds them
    together) and at most about ``ROWS_PER_TASK`` rows (gzip does not split)."""
    spark, rows = raw.sparkSession, raw.count()
    tasks = max(cores(spark), -(-rows // ROWS_PER_TASK))
    dealt = raw.repartitionByRange(tasks, F.to_date(ts_col), F.xxhash64(*raw.columns))
    laid = R.file_layout(dealt, service, filename=filename)
    with small_tasks(spark, rows, folders=OPEN_MONTHS):
        _csv_writer(laid, "errorifexists", ["filename"]).option("compression", "gzip").csv(path)


def drop_table(spark: SparkSession, name: str) -> None:
    """K13."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
