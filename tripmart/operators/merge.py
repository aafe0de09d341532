"""Insert-only merge on a row id (K8) and the monthly file load.

``MERGE ... WHEN NOT MATCHED THEN INSERT`` is an anti join plus an append:
source rows whose id is not in the target are added; every unmatched
source row goes in, duplicates inside one batch included (T10).

The target is partitioned by pickup date; the match is on the key over the
whole target, whatever its date. Where equal keys imply equal dates (trip
row ids hash the pickup time) the caller may say so, and only the batch's
dates are read. One writer per target; the plan never overwrites a path it
reads.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..session import scratch_path, small_tasks
from ..sinks.writers import persist_table

# Fields of the two row-id variants (fixed values, in hashing order).
ROW_ID_TEXT_FIELDS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
                      "dropoff_location_id", "fare_amount", "trip_distance"]
ROW_ID_BYTES_FIELDS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
                       "dropoff_location_id"]
CODEC = {"compression": "zstd"}      # md5 text takes half the room of snappy's


def new_rows(source: DataFrame, target: DataFrame, key: str = "unique_row_id") -> DataFrame:
    """Source rows whose key is absent from the target."""
    ids = target.select(F.col(key).alias("_tkey"))
    return source.join(ids, source[key] == ids._tkey, "left_anti")


def merge_insert_new(source: DataFrame, target: DataFrame, key: str = "unique_row_id") -> DataFrame:
    """The merged table as a DataFrame: target plus the new source rows."""
    return target.unionByName(new_rows(source, target, key).select(*target.columns))


def with_row_id(df: DataFrame, variant: str = "text", key: str = "unique_row_id") -> DataFrame:
    """X1 ('text', 7 fields, md5 hex) or X2 ('bytes', 5 fields, 16 bytes).
    Decimals are hashed without trailing zeros."""
    def fields(names):
        return [X.number_text(n) if isinstance(df.schema[n].dataType, T.DecimalType) else n for n in names]
    if variant == "text":
        rid = X.row_hash_text(*fields(ROW_ID_TEXT_FIELDS))
    elif variant == "bytes":
        rid = X.row_hash_bytes(*fields(ROW_ID_BYTES_FIELDS))
    else:
        raise ValueError(variant)
    return df.select(rid.alias(key), *df.columns)


def tag_file(df: DataFrame, filename: str | None = None) -> DataFrame:
    """P5: the source file name as a column (the given name, or the file
    each row was read from)."""
    name = F.lit(filename) if filename else F.col("_metadata.file_name")
    return df.withColumn("filename", name)


ROWS_PER_FILE = 5_000_000
ROWS_WORTH_A_FILE = 250_000
BROADCAST_KEYS = 100_000


def _days(batch: DataFrame, date_col: str, file_col: str | None = None) -> DataFrame:
    """A row for each date of a batch that lies in files: its rows, how many
    tasks that scan the batch hold some, the most that one holds, and its
    first and last file. One scan of these columns; the result is written."""
    files = [f(file_col or F.lit(None).cast("string")).alias(n) for f, n in ((F.min, "_first"), (F.max, "_last"))]
    held = batch.groupBy(F.col(date_col).alias("_date"), F.spark_partition_id().alias("_task")).agg(
        F.count(F.lit(1)).alias("_rows"), *files)
    days = held.groupBy("_date").agg(F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_tasks"),
                                     F.max("_rows").alias("_most"), F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    return persist_table(days, scratch_path(batch.sparkSession, "merge_days"))


def _layout(df: DataFrame, days: DataFrame, date_col: str, key: str) -> DataFrame:
    """Deal rows by (date, hash of the key) in one pass: a date of the batch
    gets a task for each ``ROWS_PER_FILE`` rows, so a hot date is split and a
    small one makes one file. Files are sorted by key. The number of tasks is
    given: merging small ones would open thousands of date files in a row."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = days.select("_date", F.ceil(F.col("_rows") / ROWS_PER_FILE).cast("int").alias("_tasks"))
    dealt = df.join(F.broadcast(sizes), df[date_col].eqNullSafe(sizes["_date"]), "left")
    part = F.pmod(F.xxhash64(key), F.coalesce("_tasks", F.lit(1)))
    return (dealt.repartition(tasks, F.col(date_col), part).select(*df.columns)
            .sortWithinPartitions(date_col, key))


def _read_target(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The target with the batch's schema; None only if the path is not there
    (a folder without data files is an empty target)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_new(spark: SparkSession, batch: DataFrame, target_path: str, key: str = "unique_row_id",
               ts_col: str = "pickup_datetime", date_col: str = "pickup_date",
               key_holds_date: bool = False, first_by: str | None = None, keep_first_by: bool = True,
               stored: bool = False) -> None:
    """Merge one batch into a date-partitioned parquet target (insert only).

    The batch is written once to the shared folder (read and hashed once; a
    lost executor reads it again from there), then anti-joined on the key
    against the whole target. ``first_by`` names a column that holds each
    row's file: of several files with a key the first brings it (see
    :func:`first_file_rows`), decided on the written batch. With ``key_holds_date`` (equal keys imply equal
    dates, as for ids that hash the pickup time) only the target's dates
    between the batch's first and last, and its NULL date, are read, and only
    the batch's rows between the target's first and last of these are joined.
    ``stored``: the batch is a plain scan of written files (and hashes of its
    columns), so that it is not written once more. A first scan reads dates
    and files alone (see :func:`_days`); the second writes.
    """
    batch = batch.withColumn(date_col, F.to_date(F.col(ts_col)))
    if not stored:
        batch = persist_table(batch, scratch_path(spark, "merge_batch"), **CODEC)
    with small_tasks(spark, 0, scans=True):
        days = _days(batch, date_col, first_by)
    lies = days.agg(
        F.min("_date").alias("lo"), F.max("_date").alias("hi"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_tasks"), F.lit(0)).alias("pieces"), F.coalesce(F.max("_most"), F.lit(0)).alias("most"),
        F.coalesce(F.sum(F.ceil(F.col("_rows") / ROWS_WORTH_A_FILE)), F.lit(0)).alias("files"),
        F.coalesce(F.bool_or(F.col("_date").isNull()), F.lit(False)).alias("undated")).first()     # one row
    with small_tasks(spark, lies.rows, scans=True):
        _append_written(spark, batch, days, lies, target_path, key, date_col, key_holds_date, first_by, keep_first_by)


def _append_written(spark: SparkSession, batch: DataFrame, days: DataFrame, lies: Row, target_path: str, key: str,
                    date_col: str, key_holds_date: bool, first_by: str | None, keep_first_by: bool) -> None:
    """:func:`append_new` of a batch that lies in files. Where its dates lie
    together in them (files of months) and no join moves the rows, they go to
    their date folders straight from the scan; else they are dealt by date."""
    together = lies.pieces <= 2 * lies.files and lies.most <= ROWS_PER_FILE
    if first_by:
        dates = None
        if key_holds_date and not lies.undated:      # a key of several files has a date of several files
            dates = days.filter(F.col("_first") < F.col("_last")).select("_date")
        if dates is None or not dates.isEmpty():
            first = _first_files(batch, key, first_by, dates, date_col)
            few = first.count() <= BROADCAST_KEYS
            batch, together = _without_later(batch, F.broadcast(first) if few else first, key, first_by), together and few
        batch = batch if keep_first_by else batch.drop(first_by)
    target = _read_target(spark, target_path, batch.schema)
    add = batch
    if target is not None and key_holds_date:
        dates = F.col(date_col).isNull()
        if lies.lo is not None:
            dates = dates | F.col(date_col).between(F.lit(lies.lo), F.lit(lies.hi))
        target = target.filter(dates)
        held = target.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
        both = F.col(date_col).isNull()
        if held.lo is not None:
            both = both | F.col(date_col).between(F.lit(held.lo), F.lit(held.hi))
        if held.lo is not None or lies.undated:
            # rows of dates that the target lacks are new without a look at it
            add = (batch.filter(~both)
                   .unionByName(new_rows(batch.filter(both), target.select(key), key).select(*batch.columns)))
            together = False
    elif target is not None:
        add, together = new_rows(batch, target.select(key), key).select(*batch.columns), False
    out = add.sortWithinPartitions(date_col, key) if together else _layout(add, days, date_col, key)
    out.write.mode("append").options(**CODEC).partitionBy(date_col).parquet(target_path)


def ingest_month(spark: SparkSession, month_df: DataFrame, target_path: str, filename: str,
                 variant: str = "text", ts_col: str = "pickup_datetime", stored: bool = False) -> None:
    """Type (already done by the reader), hash, tag the file, merge. Row
    ids hash the pickup time, so equal ids share a date."""
    staged = tag_file(with_row_id(month_df, variant), filename)
    append_new(spark, staged, target_path, ts_col=ts_col, key_holds_date=True, stored=stored)


def ingest_files(spark: SparkSession, files: DataFrame, target_path: str, variant: str = "text",
                 ts_col: str = "pickup_datetime", stored: bool = False) -> None:
    """I1 for any number of files at once. ``files`` are typed rows with the
    column ``filename``. The result is that of loading the files one after
    the other in order of their names: a row id that a file brings is taken
    from the first file that has it, with that file's repeats (T10)."""
    append_new(spark, with_row_id(files, variant), target_path, ts_col=ts_col, key_holds_date=True, first_by="filename",
               stored=stored)


def first_file_rows(df: DataFrame, key: str, file_col: str) -> DataFrame:
    """Rows whose file is the first (by name) that holds their key. Rows
    without a key all stay, as an insert-only merge keeps them.

    ``df`` is a written table. Only keys that several files hold can lose a
    row; they are few where files are months, and found first."""
    return _without_later(df, _first_files(df, key, file_col), key, file_col)


def _first_files(df: DataFrame, key: str, file_col: str, dates: DataFrame | None = None,
                 date_col: str | None = None) -> DataFrame:
    """The keys that several files hold, with the first of these; of the
    given ``dates`` only.

    Rows are counted by a hash of the key: a key of one row needs no look at
    its file, and of the others only the rows with a hash that repeats go on
    by their key. Both small results are written, so that Spark plans the
    joins by their sizes and leaves the rows of ``df`` where they are."""
    if dates is not None:
        df = df.join(F.broadcast(dates), df[date_col].eqNullSafe(dates["_date"]), "left_semi")
    code = F.xxhash64(key)
    keyed = df.filter(F.col(key).isNotNull()).select(F.col(key), F.col(file_col), code.alias("_code"))
    repeated = keyed.groupBy(F.col("_code").alias("_again")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_again")
    repeated = persist_table(repeated, scratch_path(df.sparkSession, "repeated_keys"))
    keyed = keyed.join(repeated, keyed["_code"] == repeated["_again"], "left_semi")
    spans = keyed.groupBy(F.col(key).alias("_key")).agg(
        F.min(file_col).alias("_first"), F.max(file_col).alias("_last"))
    first = spans.filter(F.col("_first") < F.col("_last")).drop("_last")
    return persist_table(first, scratch_path(df.sparkSession, "first_files"))


def _without_later(df: DataFrame, first: DataFrame, key: str, file_col: str) -> DataFrame:
    """Rows that no earlier file of :func:`_first_files` brings."""
    later = (df[key] == first["_key"]) & (df[file_col] > first["_first"])
    return df.join(first, later, "left_anti")


# --- a target bucketed by its key -----------------------------------------------------

def ensure_bucketed(spark: SparkSession, name: str, schema: T.StructType, buckets: int,
                    key: str = "unique_row_id", path: str | None = None) -> None:
    """A target table clustered by its key into ``buckets`` buckets, made once.
    Size the buckets for the table to come (a few hundred MB each): their
    number stays."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS{place}")


BUCKET_ROWS = 400_000


def bucket_count(rows: int, least: int = 8) -> int:
    """Buckets for a table of about ``rows`` rows: a bucket is one task's work
    in every merge, so their number follows the table."""
    return max(least, -(-rows // BUCKET_ROWS))


def new_bucketed_rows(spark: SparkSession, batch: DataFrame, name: str, buckets: int, key: str = "unique_row_id") -> DataFrame:
    """The rows of a written batch whose key the bucketed table lacks. The
    batch is dealt to the buckets; the table is read where it lies."""
    dealt = batch.repartition(buckets, F.col(key))           # the hash and number of a bucketed write
    return new_rows(dealt, spark.table(name).hint("merge"), key)


def append_bucketed(spark: SparkSession, batch: DataFrame, name: str, buckets: int, key: str = "unique_row_id") -> None:
    """K8 on a bucketed target: insert-only merge in which only the batch
    shuffles, once, for the join and the write alike. The batch is written
    first, so that it is read and hashed once."""
    batch = persist_table(batch, scratch_path(spark, "merge_batch"))
    add = new_bucketed_rows(spark, batch, name, buckets, key).select(*spark.table(name).columns)
    add.write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def month_file(service: str, ts_col: str = "pickup_datetime"):
    """Name of the monthly file that holds a row (a column)."""
    return F.concat(F.lit(f"{service}_tripdata_"), F.date_format(ts_col, "yyyy-MM"), F.lit(".csv"))


def month_file_name(service: str, year: int, month: int) -> str:
    """Name of a monthly trip file (e.g. yellow_tripdata_2019-01.csv)."""
    return f"{service}_tripdata_{year:04d}-{month:02d}.csv"


def month_bounds(year: int, month: int) -> tuple[str, str]:
    ny, nm = (year + 1, 1) if month == 12 else (year, month + 1)
    return f"{year:04d}-{month:02d}-01", f"{ny:04d}-{nm:02d}-01"


def month_slice(df: DataFrame, year: int, month: int, ts_col: str = "pickup_datetime") -> DataFrame:
    lo, hi = month_bounds(year, month)
    return df.filter(X.in_range(ts_col, lo, hi))


__all__ = ["new_rows", "merge_insert_new", "with_row_id", "tag_file", "append_new", "ingest_month",
           "ingest_files", "first_file_rows", "ensure_bucketed", "new_bucketed_rows", "append_bucketed", "month_file_name", "month_bounds", "month_slice"]
