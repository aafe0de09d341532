"""Sources S1-S9: typed CSV, external tables, parquet, JSON, seeds.

Schemas are always declared (``StructType`` or DDL); inference is only used
by ``read_inferred`` for exploration, never by the marts.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import NUMERIC

# Column order of the monthly trip CSV files (fixed values, file order).
# Amounts are exact decimals (NUMERIC).
YELLOW_CSV_COLUMNS = [
    ("VendorID", "string"), ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"), ("passenger_count", "bigint"),
    ("trip_distance", NUMERIC), ("RatecodeID", "string"), ("store_and_fwd_flag", "string"),
    ("PULocationID", "string"), ("DOLocationID", "string"), ("payment_type", "bigint"),
    ("fare_amount", NUMERIC), ("extra", NUMERIC), ("mta_tax", NUMERIC),
    ("tip_amount", NUMERIC), ("tolls_amount", NUMERIC), ("improvement_surcharge", NUMERIC),
    ("total_amount", NUMERIC), ("congestion_surcharge", NUMERIC),
]
GREEN_CSV_COLUMNS = [
    ("VendorID", "string"), ("lpep_pickup_datetime", "timestamp_ntz"),
    ("lpep_dropoff_datetime", "timestamp_ntz"), ("store_and_fwd_flag", "string"),
    ("RatecodeID", "string"), ("PULocationID", "string"), ("DOLocationID", "string"),
    ("passenger_count", "bigint"), ("trip_distance", NUMERIC), ("fare_amount", NUMERIC),
    ("extra", NUMERIC), ("mta_tax", NUMERIC), ("tip_amount", NUMERIC),
    ("tolls_amount", NUMERIC), ("ehail_fee", NUMERIC), ("improvement_surcharge", NUMERIC),
    ("total_amount", NUMERIC), ("payment_type", "bigint"), ("trip_type", "string"),
    ("congestion_surcharge", NUMERIC),
]
FHV_CSV_COLUMNS = [
    ("dispatching_base_num", "string"), ("pickup_datetime", "timestamp_ntz"),
    ("dropOff_datetime", "timestamp_ntz"), ("PUlocationID", "string"),
    ("DOlocationID", "string"), ("SR_Flag", "string"), ("Affiliated_base_number", "string"),
]
CSV_COLUMNS = {"yellow": YELLOW_CSV_COLUMNS, "green": GREEN_CSV_COLUMNS, "fhv": FHV_CSV_COLUMNS}

# File column -> column of the raw tables that the staging models read.
# Other columns keep their names (all of the fhv ones do).
RAW_NAMES = {
    "VendorID": "vendor_id", "RatecodeID": "rate_code",
    "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime",
    "PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id",
    "improvement_surcharge": "imp_surcharge",
}

# Yellow parquet after the notebook's cast (A5).
YELLOW_PARQUET_SCHEMA = T.StructType([
    T.StructField("VendorID", T.ShortType()),
    T.StructField("tpep_pickup_datetime", T.TimestampType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.FloatType()),
    T.StructField("RatecodeID", T.ShortType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.ShortType()),
    T.StructField("DOLocationID", T.ShortType()),
    T.StructField("payment_type", T.ByteType()),
    T.StructField("fare_amount", T.FloatType()),
    T.StructField("extra", T.FloatType()),
    T.StructField("mta_tax", T.FloatType()),
    T.StructField("tip_amount", T.FloatType()),
    T.StructField("tolls_amount", T.FloatType()),
    T.StructField("improvement_surcharge", T.FloatType()),
    T.StructField("total_amount", T.FloatType()),
    T.StructField("congestion_surcharge", T.FloatType()),
    T.StructField("Airport_fee", T.FloatType()),
])

ZONE_SEED_SCHEMA = "locationid bigint, borough string, zone string, service_zone string"
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def ddl(columns) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in columns)


def typed(df: DataFrame, schema: T.StructType, on_bad: str = "fail") -> DataFrame:
    """Give text columns their declared types. A value that does not convert
    is an error that names column and value (``on_bad="fail"``); with
    ``"report"`` it becomes NULL and its column's name is listed in the extra
    column ``bad_columns``. No value is lost silently."""
    if on_bad not in ("fail", "report"):
        raise ValueError(on_bad)
    cols, bad = [], []
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            cols.append(text)
            continue
        if isinstance(f.dataType, T.TimestampNTZType):
            value = F.try_to_timestamp(text, F.lit(CSV_TIMESTAMP_FORMAT)).cast("timestamp_ntz")
        else:
            value = text.try_cast(f.dataType)
        wrong = text.isNotNull() & value.isNull()
        if on_bad == "fail":
            told = F.raise_error(F.concat(F.lit(f"bad value in column {f.name}: "), text)).cast(f.dataType)
            value = F.when(wrong, told).otherwise(value)
        else:
            bad.append(F.when(wrong, F.lit(f.name)))
        cols.append(value.alias(f.name))
    if on_bad == "report":
        cols.append(F.array_compact(F.array(*bad) if bad else F.array().cast("array<string>")).alias("bad_columns"))
    return df.select(*cols, *[c for c in df.columns if c not in schema.fieldNames()])


def csv_external(spark: SparkSession, path: str, schema, skip_header: bool = True,
                 on_bad: str = "fail", filename: bool = False) -> DataFrame:
    """Declared schema over CSV files, nothing copied.

    Extra trailing columns of a file are dropped and missing ones are NULL;
    bad values are an error, or reported (see :func:`typed`). ``filename``
    adds the name of each row's file.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = spark.read.schema(texts).option("header", skip_header).option("enforceSchema", True).csv(path)
    if filename:
        df = df.withColumn("filename", F.col("_metadata.file_name"))
    return typed(df, schema, on_bad)


def read_trips_csv(spark: SparkSession, path: str, service: str, schema: str | T.StructType | None = None,
                   repartition: int | None = None, on_bad: str = "fail", filename: bool = False) -> DataFrame:
    """Monthly trip CSV files (plain or .gz) with a header line, in the
    column order of their service.

    gzip is not splittable (one task per file): with fewer splits than
    cores the rows are spread straight after the read (``spread``), or into
    ``repartition`` partitions when given.
    """
    df = csv_external(spark, path, schema or ddl(CSV_COLUMNS[service]), on_bad=on_bad, filename=filename)
    return df.repartition(repartition) if repartition else spread(df)


def raw_names(df: DataFrame) -> DataFrame:
    """File columns under the names that the staging models read."""
    return df.select(*[F.col(f"`{c}`").alias(RAW_NAMES.get(c, c)) for c in df.columns])


def file_layout(raw: DataFrame, service: str, **more) -> DataFrame:
    """The reverse: raw trips in the column names and order of the service's
    files. Columns that the raw trips lack are NULL, and so are codes that a
    file's type cannot hold. ``more`` are columns over the raw trips that
    follow by name."""
    pickup = {"yellow": "tpep_", "green": "lpep_"}.get(service, "")
    back = {v: k for k, v in RAW_NAMES.items() if not k.startswith(("tpep_", "lpep_"))}
    back |= {f"{w}_datetime": f"{pickup}{w}_datetime" for w in ("pickup", "dropoff")} if pickup else {}
    named = {back.get(c, c): c for c in raw.columns}
    return raw.select(*[(F.col(named[n]).try_cast(t) if n in named else F.lit(None).cast(t)).alias(n)
                        for n, t in CSV_COLUMNS[service]], *[c.alias(n) for n, c in more.items()])


def spread(df: DataFrame, keys=(), min_partitions: int | None = None) -> DataFrame:
    """Give a scan at least as many partitions as the cluster has cores.

    A single large file with one row group, or a gzip file, is read by one
    task, and every narrow operator after it (broadcast joins, projections,
    partial aggregates) then runs in that one task. Only in that case the
    rows are hash-partitioned on ``keys`` (deterministic on retry; round
    robin when no keys). A scan that already has enough splits, as any
    large table on a cluster does, is left alone: no extra shuffle.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism  # no context: except
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a Connect session): leave the scan as is
        return df
    if have >= want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.parquet(path)


def external_table(spark: SparkSession, name: str, glob: str, fmt: str = "parquet") -> DataFrame:
    """A view over files matched by a glob; queries read them in place."""
    df = spark.read.format(fmt).load(glob)
    df.createOrReplaceTempView(name)
    return df


def external_catalog_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                           schema: T.StructType | str | None = None, partition_by: Sequence[str] = (),
                           options: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table over files where they lie, seen by every session of
    the catalog. Nothing is copied, and dropping it leaves the files. Without
    a schema the files' own is declared; ``partition_by`` are its folder
    columns. Partitions that come later are found by :func:`refresh_external`."""
    if schema is None:
        reader = spark.read.format(fmt)
        schema = (reader.options(**options) if options else reader).load(path).schema
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    given = f" OPTIONS ({', '.join(f'{k!r} {v!r}' for k, v in options.items())})" if options else ""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{given}{parts} LOCATION '{path}'")
    if partition_by:
        refresh_external(spark, name)
    return spark.table(name)


def refresh_external(spark: SparkSession, name: str) -> None:
    """Make files and partition folders that came after the table was read
    visible: a catalog that keeps partitions recovers them, another lists
    the folders anew."""
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    except AnalysisException:               # not partitioned, or the catalog keeps no partitions
        pass
    spark.catalog.refreshTable(name)


def metadata_summary(spark: SparkSession, path: str, cols: Sequence[str] = ()) -> DataFrame:
    """A1: number of rows, and ``min_<c>`` / ``max_<c>`` of each column, from
    the footers of parquet files: no column is read. Columns must have a type
    whose footer statistics are exact (numbers, dates). The aggregate is
    pushed into the scan by a session of its own, which has the setting."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    both = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))]
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), *both)


def read_json_records(spark: SparkSession, path: str, field: str,
                      item_type: str = "map<string,string>") -> DataFrame:
    """A JSON document holding an array of records -> one row per record.

    ``item_type`` map keeps keys that are absent apart from explicit nulls.
    """
    doc = spark.read.schema(f"`{field}` array<{item_type}>").option("multiLine", True).json(path)
    return doc.select(F.explode(F.col(field)).alias("record"))


def read_json_pages(spark: SparkSession, path: str, schema) -> DataFrame:
    """Landed pages, each a JSON array of records; empty pages add none."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_seed(spark: SparkSession, path: str, schema: str = ZONE_SEED_SCHEMA) -> DataFrame:
    """Small versioned CSV dimension with typed columns."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_inferred(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Schema inference, for exploration only (an extra pass over the data)."""
    r = spark.read.option("header", True)
    if fmt == "csv":
        r = r.option("inferSchema", True)
    return r.format(fmt).load(path)


def describe_schema(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) pairs."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
