"""Registered data-test, merge, ingest, layout and streaming queries
(Q1-Q5, K5, K8, I1, I2).

The merge and ingest queries write to fresh folders under the shared
scratch root (``spark.checkpoint.dir``) and return the resulting table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators import merge as MG
from ..operators import quality as Q
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import readers as R
from ..streaming import ingest as ST
from . import marts as M
from . import oracle as O
from .catalog import Models, neutral, register


# --- data tests -------------------------------------------------------------------

def _unique_input(m: Models):
    """tripid of green rows before de-duplication (so duplicates exist)."""
    raw = m.raw_green.filter(F.col("vendor_id").isNotNull())
    return raw.select(X.surrogate_key("vendor_id", "pickup_datetime").alias("tripid"))


_UNIQUE_IN = f"SELECT {O.surrogate('vendor_id', 'pickup_datetime')} AS tripid FROM raw_green WHERE vendor_id IS NOT NULL"


@register("dq_unique", O.sql("""SELECT tripid AS unique_field, CAST(count(*) AS BIGINT) AS n_records
FROM unique_in WHERE tripid IS NOT NULL GROUP BY tripid HAVING count(*) > 1""", "raw_green",
                             extra={"unique_in": _UNIQUE_IN}))
def q_dq_unique(m: Models):
    """Q1 on tripid of green rows before de-duplication."""
    return Q.check_unique(_unique_input(m), "tripid")


@register("dq_unique_services", O.sql("""SELECT service, tripid AS unique_field, CAST(count(*) AS BIGINT) AS n_records
FROM unique_in WHERE tripid IS NOT NULL GROUP BY service, tripid HAVING count(*) > 1""", "trips_raw", extra={
    "unique_in": f"SELECT service, {O.surrogate('vendor_id', 'pickup_datetime')} AS tripid FROM trips_raw WHERE vendor_id IS NOT NULL"}))
def q_dq_unique_services(m: Models):
    """Q1 on tripid of both services before de-duplication."""
    raw = m.trips_raw.filter(F.col("vendor_id").isNotNull())
    return Q.check_unique(raw.select("service", X.surrogate_key("vendor_id", "pickup_datetime").alias("tripid")),
                          "tripid", within=["service"])


@register("dq_not_null", O.sql("""SELECT service, pickup_datetime, CAST(fare_amount AS DOUBLE) AS fare_amount
FROM trips_raw WHERE vendor_id IS NULL""", "trips_raw"))
def q_dq_not_null(m: Models):
    """Q2 on raw vendor_id."""
    return neutral(Q.check_not_null(m.trips_raw, "vendor_id").select("service", "pickup_datetime", "fare_amount"))


def _known(m: Models):
    return m.dim_zones.filter(F.col("borough") != "Unknown")


@register("dq_relationships", O.sql("""SELECT CAST(t.pickup_locationid AS BIGINT) AS from_field
FROM trips_unioned t
WHERE t.pickup_locationid IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM known_zones z WHERE z.locationid = t.pickup_locationid)""",
                                    "trips_unioned", "known_zones"))
def q_dq_relationships(m: Models):
    """Staged pickup ids against zones without the Unknown borough."""
    t = M.trips_unioned(m.stg_green, m.stg_yellow)
    return neutral(Q.check_relationships(t, "pickup_locationid", _known(m), "locationid"))


@register("dq_accepted_values", O.sql("""SELECT CAST(payment_type AS BIGINT) AS value_field,
  CAST(count(*) AS BIGINT) AS n_records
FROM trips_unioned GROUP BY payment_type HAVING payment_type NOT IN (1, 2, 3, 4, 5, 6)""", "trips_unioned"))
def q_dq_accepted_values(m: Models):
    """Q4: payment_type against the project's accepted list (0 fails, T19)."""
    from ..config import PAYMENT_TYPE_VALUES
    t = M.trips_unioned(m.stg_green, m.stg_yellow)
    return neutral(Q.check_accepted_values(t, "payment_type", PAYMENT_TYPE_VALUES))


def _suite_sql() -> str:
    rows = []
    for service, dropoff in (("green", "error"), ("yellow", "warn")):
        stg = f"stg_{service}"
        lost = ("SELECT 1 FROM {s} t WHERE t.{c} IS NOT NULL AND NOT EXISTS "
                "(SELECT 1 FROM dim_zones z WHERE z.locationid = t.{c})")
        rows += [
            (stg, "unique", "tripid", "warn", f"SELECT tripid FROM {stg} WHERE tripid IS NOT NULL GROUP BY tripid HAVING count(*) > 1"),
            (stg, "not_null", "tripid", "warn", f"SELECT 1 FROM {stg} WHERE tripid IS NULL"),
            (stg, "relationships", "pickup_locationid", "warn", lost.format(s=stg, c="pickup_locationid")),
            (stg, "relationships", "dropoff_locationid", dropoff, lost.format(s=stg, c="dropoff_locationid")),
            (stg, "accepted_values", "payment_type", "warn",
             f"SELECT payment_type FROM {stg} GROUP BY payment_type HAVING payment_type NOT IN (1, 2, 3, 4, 5, 6)"),
        ]
    rows.append(("monthly_zone_revenue", "not_null", "revenue_monthly_total_amount", "error",
                 "SELECT 1 FROM fact_trips GROUP BY pickup_zone, date_trunc('month', pickup_datetime), service_type "
                 "HAVING sum(total_amount) IS NULL"))
    return "\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, '{name}' AS check_name, '{col}' AS column_name, '{sev}' AS severity, "
        f"CAST(count(*) AS BIGINT) AS failures, "
        f"CASE WHEN count(*) = 0 THEN 'pass' WHEN '{sev}' = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ({body})"
        for model, name, col, sev, body in rows)


@register("dq_report", O.sql(_suite_sql(), "stg_green", "stg_yellow", "dim_zones", "fact_trips"))
def q_dq_report(m: Models):
    """Q5: the project's 11 declared tests, one row each (not raised here).
    The staged trips are built once; the row tests are counted meanwhile."""
    trips = M.trips_unioned(m.stg_green, m.stg_yellow)
    t, observed = Q.build_observed(trips, m.dim_zones, scratch_path(m.spark, "stg_trips"))
    return Q.run_suite(t, m.dim_zones, M.monthly_zone_revenue(M.fact_from_unioned(t, m.dim_zones)), observed=observed)


# --- insert-only merge and monthly ingest -----------------------------------------

_KEEP = ["unique_row_id", "service", "vendor_id", "pickup_datetime", "fare_amount"]


@register("merge_insert_new", O.sql(f"""
SELECT unique_row_id, service, vendor_id, pickup_datetime, CAST(fare_amount AS DOUBLE) AS fare_amount FROM tgt
UNION ALL
SELECT unique_row_id, service, vendor_id, pickup_datetime, CAST(fare_amount AS DOUBLE) AS fare_amount FROM src s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.unique_row_id = s.unique_row_id)""", "trips_raw", extra={
    "hashed": f"SELECT {O.row_hash(*MG.ROW_ID_TEXT_FIELDS)} AS unique_row_id, * FROM trips_raw",
    "tgt": "SELECT * FROM hashed WHERE pickup_datetime < TIMESTAMP '1998-01-01'",
    "src": "SELECT * FROM hashed WHERE pickup_datetime >= TIMESTAMP '1997-12-01'",
}))
def q_merge_insert_new(m: Models):
    """target = trips before 1998-01, source = all trips from
    1997-12 on (one overlapping month); the merged target is returned."""
    hashed = MG.with_row_id(m.trips_raw, "text")
    path = scratch_path(m.spark, "merge_target")
    MG.append_new(m.spark, hashed.filter(F.col("pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")),
                  path, key_holds_date=True, stored=True)
    MG.append_new(m.spark, hashed.filter(F.col("pickup_datetime") >= F.lit("1997-12-01").cast("timestamp_ntz")), path,
                  key_holds_date=True, stored=True)
    return neutral(m.spark.read.parquet(path).select(*_KEEP))


_MERGED = """
SELECT unique_row_id, service, vendor_id, pickup_datetime, CAST(fare_amount AS DOUBLE) AS fare_amount FROM tgt
UNION ALL
SELECT unique_row_id, service, vendor_id, pickup_datetime, CAST(fare_amount AS DOUBLE) AS fare_amount FROM src s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.unique_row_id = s.unique_row_id)"""


@register("merge_bucketed", O.sql(_MERGED, "trips_raw", extra={
    "hashed": f"SELECT {O.row_hash(*MG.ROW_ID_TEXT_FIELDS)} AS unique_row_id, * FROM trips_raw",
    "tgt": "SELECT * FROM hashed WHERE pickup_datetime < TIMESTAMP '1998-01-01'",
    "src": "SELECT * FROM hashed WHERE pickup_datetime >= TIMESTAMP '1997-12-01'",
}))
def q_merge_bucketed(m: Models):
    """The merge of ``merge_insert_new`` on a target bucketed by
    the row id: only the batch shuffles, the target is read where it lies."""
    hashed = MG.with_row_id(m.trips_raw, "text").select(*_KEEP)
    name, buckets = f"tm_bucketed_{uuid.uuid4().hex[:10]}", MG.bucket_count(m.n_trips)
    MG.ensure_bucketed(m.spark, name, hashed.schema, buckets, path=scratch_path(m.spark, "bucketed"))
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    MG.append_bucketed(m.spark, hashed.filter(F.col("pickup_datetime") < split), name, buckets)
    MG.append_bucketed(m.spark, hashed.filter(F.col("pickup_datetime") >= F.lit("1997-12-01").cast("timestamp_ntz")), name, buckets)
    return neutral(m.spark.table(name))


def _month_sql(service: str) -> str:
    return f"'{service}_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.csv'"


@register("ingest_month", O.sql(f"""SELECT {O.row_hash(*MG.ROW_ID_BYTES_FIELDS)} AS unique_row_id_hex,
  {_month_sql('yellow')} AS filename, vendor_id, pickup_datetime, dropoff_datetime,
  CAST(total_amount AS DOUBLE) AS total_amount
FROM raw_yellow""", "raw_yellow"))
def q_ingest_month(m: Models):
    """All monthly yellow files in one load, then one month again (it
    adds nothing); 5-field byte row ids, file names kept."""
    path = scratch_path(m.spark, "ingest_target")
    files = m.raw_yellow.withColumn("filename", MG.month_file("yellow"))
    MG.ingest_files(m.spark, files, path, variant="bytes", stored=True)
    again = MG.month_slice(m.raw_yellow, 1997, 12)
    MG.ingest_month(m.spark, again, path, MG.month_file_name("yellow", 1997, 12), variant="bytes", stored=True)
    t = m.spark.read.parquet(path)
    return neutral(t.select(F.lower(F.hex("unique_row_id")).alias("unique_row_id_hex"), "filename",
                            "vendor_id", "pickup_datetime", "dropoff_datetime", "total_amount"))


def _loaded_sql(service: str) -> str:
    fields = [c for c in MG.ROW_ID_TEXT_FIELDS]
    return f"""SELECT '{service}' AS service, {_month_sql(service)} AS filename, {O.row_hash(*fields)} AS unique_row_id,
  pickup_datetime, dropoff_datetime, CAST(pickup_location_id AS VARCHAR) AS pickup_location,
  CAST(dropoff_location_id AS VARCHAR) AS dropoff_location, CAST({O.int_text('payment_type')} AS DOUBLE) AS payment_type,
  CAST(total_amount AS DOUBLE) AS total_amount FROM raw_{service}"""


@register("ingest_csv", O.sql(f"""{_loaded_sql('yellow')}
UNION ALL {_loaded_sql('green')}
UNION ALL SELECT 'fhv', {_month_sql('fhv')}, NULL, pickup_datetime, dropOff_datetime, PUlocationID, DOlocationID, NULL, NULL
FROM fhv_raw""", "raw_yellow", "raw_green", "fhv_raw"))
def q_ingest_csv(m: Models):
    """S1 / S2 / P4 / I1 / K2 end to end: every month of yellow, green and fhv
    as gzipped CSV files in their real column order, read with the declared schema.
    Yellow and green are renamed, hashed (7 fields) and merged insert-only,
    and one month arrives again and adds nothing; fhv is landed as parquet."""
    out = None
    for service in ("yellow", "green"):
        raw = m.raw_yellow if service == "yellow" else m.raw_green
        landing, target = (scratch_path(m.spark, f"csv_{service}_{x}") for x in ("landing", "target"))
        W.write_month_files(raw, landing, service, MG.month_file(service))
        files = R.raw_names(R.read_trips_csv(m.spark, landing, service))
        MG.ingest_files(m.spark, files, target, stored=True)
        MG.ingest_files(m.spark, files.filter(F.col("filename") == MG.month_file_name(service, 1997, 6)), target, stored=True)
        part = m.spark.read.parquet(target).select(
            F.lit(service).alias("service"), "filename", "unique_row_id", "pickup_datetime", "dropoff_datetime",
            F.col("pickup_location_id").alias("pickup_location"), F.col("dropoff_location_id").alias("dropoff_location"),
            F.col("payment_type").cast("double").alias("payment_type"), F.col("total_amount").cast("double").alias("total_amount"))
        out = part if out is None else out.unionByName(part)
    landing, target = (scratch_path(m.spark, f"csv_fhv_{x}") for x in ("landing", "target"))
    W.write_month_files(m.fhv_raw, landing, "fhv", MG.month_file("fhv"))
    W.csv_to_parquet(m.spark, landing, target, "fhv")
    fhv = m.spark.read.parquet(target).select(
        F.lit("fhv").alias("service"), "filename", F.lit(None).cast("string").alias("unique_row_id"), "pickup_datetime",
        F.col("dropOff_datetime").alias("dropoff_datetime"), F.col("PUlocationID").alias("pickup_location"),
        F.col("DOlocationID").alias("dropoff_location"), F.lit(None).cast("double").alias("payment_type"),
        F.lit(None).cast("double").alias("total_amount"))
    return out.unionByName(fhv)


# --- layout: partitioned + clustered table, pruned scan ----------------------------

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("partition_pruned_scan", """SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'""")
def q_partition_pruned_scan(m: Models):
    """K5 / F1: events written partitioned by date and clustered by user;
    the date filter reads one partition directory (PartitionFilters)."""
    path = scratch_path(m.spark, "events_by_date")
    date_col = W.write_partitioned(m.table("events"), path, "ts", cluster_by=["user_id"], date_col="event_date")
    t = m.spark.read.parquet(path)
    return t.filter(F.col(date_col) == F.lit("2024-01-05").cast("date")).select(*EVENT_COLS)


# --- streaming ingest (I2) ----------------------------------------------------------

@register("ingest_stream", "SELECT * FROM events")
def q_ingest_stream(m: Models):
    """Events landed as daily files, loaded by an availableNow file
    stream (many files per micro-batch) merging insert-only on event_id; a
    second run finds no new files and adds nothing."""
    events = m.table("events")
    landing = scratch_path(m.spark, "landing_events")
    ST.land_files_by_day(events, landing, "ts")
    target = scratch_path(m.spark, "stream_target")
    ckpt = scratch_path(m.spark, "stream_ckpt")
    for _ in range(2):
        ST.ingest_available(m.spark, landing, events.schema, target, ckpt, key="event_id", ts_col="ts")
    return m.spark.read.parquet(target).select(*EVENT_COLS)


@register("ingest_quarantine", """SELECT event_id, event_id % 50 <> 0 AS loaded,
  CASE WHEN event_id % 50 = 0 THEN 'value' END AS bad_columns FROM events""")
def q_ingest_quarantine(m: Models):
    """I2 / S2 with bad rows: events landed as CSV, every fiftieth with a value
    that is no number. A stream merges the good rows and puts the others into
    quarantine with the columns that were bad; a second run adds nothing."""
    events = m.table("events").select("event_id", "ts", F.when(F.col("event_id") % 50 == 0, "n/a")
                                      .otherwise(F.col("value").cast("string")).alias("value"))
    schema = T.StructType.fromDDL("event_id bigint, ts timestamp_ntz, value double")
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    landing, target, bad, ckpt = (scratch_path(m.spark, f"quarantine_{x}") for x in ("landing", "target", "bad", "ckpt"))
    W.write_csv(events, landing)
    for _ in range(2):
        ST.ingest_available(m.spark, landing, texts, target, ckpt, key="event_id", ts_col="ts", fmt="csv", header=True,
                            prepare=lambda df: R.typed(df, schema, "report"), quarantine=bad)
    good = m.spark.read.parquet(target).select("event_id", F.lit(True).alias("loaded"), F.lit(None).cast("string").alias("bad_columns"))
    kept = m.spark.read.parquet(bad).select("event_id", F.lit(False).alias("loaded"), F.array_join("bad_columns", ",").alias("bad_columns"))
    return good.unionByName(kept)
