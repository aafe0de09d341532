"""Registered queries for the staging and core models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import merge as MG
from ..operators import staging as S
from ..sources import fixtures as FX
from . import marts as M
from . import oracle as O
from .catalog import Models, neutral, register

STG_COLS = ("tripid, vendorid, ratecodeid, pickup_locationid, dropoff_locationid, pickup_datetime, "
            "dropoff_datetime, store_and_fwd_flag, passenger_count, trip_distance, trip_type, "
            "fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge, "
            "total_amount, payment_type, payment_type_description")


def _neutral_sql(cols: str, src: str, ints=(), decs=()) -> str:
    out = []
    for c in [c.strip() for c in cols.split(",")]:
        if c in ints:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        elif c in decs:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)} FROM {src}"


STG_INTS = ("vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid", "passenger_count",
            "trip_type", "payment_type")
STG_DECS = ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "ehail_fee", "improvement_surcharge", "total_amount")
FACT_COLS = ("tripid, vendorid, service_type, ratecodeid, pickup_locationid, pickup_borough, pickup_zone, "
             "dropoff_locationid, dropoff_borough, dropoff_zone, pickup_datetime, dropoff_datetime, "
             "store_and_fwd_flag, passenger_count, trip_distance, trip_type, fare_amount, extra, mta_tax, "
             "tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount, payment_type, "
             "payment_type_description, year, quarter, year_quarter, month")
FACT_INTS = STG_INTS + ("year", "quarter", "month")


@register("dim_zones", O.sql("SELECT * FROM dim_zones", "dim_zones"))
def q_dim_zones(m: Models):
    """M4."""
    return neutral(m.dim_zones)


@register("stg_green", O.sql(_neutral_sql(STG_COLS, "stg_green", STG_INTS, STG_DECS), "stg_green"))
def q_stg_green(m: Models):
    """M1: whole green staging view."""
    return neutral(m.stg_green)


@register("stg_yellow", O.sql(_neutral_sql(STG_COLS, "stg_yellow", STG_INTS, STG_DECS), "stg_yellow"))
def q_stg_yellow(m: Models):
    """M2."""
    return neutral(m.stg_yellow)


@register("stg_fhv", O.sql("""SELECT dispatching_base_num, CAST(pickup_locationid AS DOUBLE) AS pickup_locationid,
  CAST(dropoff_locationid AS BIGINT) AS dropoff_locationid, pickup_datetime, dropoff_datetime, sr_flag
FROM stg_fhv""", "stg_fhv"))
def q_stg_fhv(m: Models):
    """M3: no null filter, no de-duplication (pickup ids with NULLs are
    shown as DOUBLE)."""
    return neutral(m.stg_fhv, nullable_ints=["pickup_locationid"])


@register("stg_test_run", O.sql(
    _neutral_sql(STG_COLS, "stg_green", STG_INTS, STG_DECS) + " ORDER BY tripid NULLS FIRST LIMIT 100",
    "stg_green"))
def q_stg_test_run(m: Models):
    """L4: the development cap switched on: first 100 rows by tripid."""
    return neutral(S.stg_green(m.raw_green, FX.MONEY, test_run=True))


@register("trips_unioned", O.sql(
    _neutral_sql(STG_COLS + ", service_type", "trips_unioned", STG_INTS, STG_DECS), "trips_unioned"))
def q_trips_unioned(m: Models):
    """U1."""
    return neutral(M.trips_unioned(m.stg_green, m.stg_yellow))


@register("fact_trips", O.sql(_neutral_sql(FACT_COLS, "fact_trips", FACT_INTS, STG_DECS), "fact_trips"))
def q_fact_trips(m: Models):
    """M5: green + yellow with zones."""
    return neutral(m.fact_trips)


@register("fact_fhv_trips", O.sql("""SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
  dispatching_base_num, CAST(pickup_locationid AS BIGINT) AS pickup_locationid,
  CAST(dropoff_locationid AS BIGINT) AS dropoff_locationid, pickup_datetime, dropoff_datetime, sr_flag,
  service_type, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone
FROM fact_fhv_trips""", "fact_fhv_trips"))
def q_fact_fhv_trips(m: Models):
    """M6."""
    return neutral(m.fact_fhv_trips)


@register("monthly_zone_revenue", O.sql(f"""SELECT pickup_zone AS revenue_zone,
  CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month,
  service_type,
  {O.revenue('monthly')}
FROM fact_trips GROUP BY 1, 2, 3""", "fact_trips"))
def q_monthly_zone_revenue(m: Models):
    """M7 / A5: the flagship mart."""
    return neutral(M.monthly_zone_revenue(m.fact_trips),
                   round4=["avg_monthly_passenger_count", "avg_monthly_trip_distance"])


@register("quarterly_revenue", O.sql(f"""SELECT CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,
  service_type,
  {O.revenue('quarterly')}
FROM fact_trips GROUP BY 1, 2, 3""", "fact_trips"))
def q_quarterly_revenue(m: Models):
    """M8 / A6 (A12: group by ordinals in the SQL twin)."""
    return neutral(m.quarterly_revenue,
                   round4=["avg_quarterly_passenger_count", "avg_quarterly_trip_distance"])


_P_SQL = """SELECT DISTINCT service_type, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
  round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.90) OVER w, 4) AS p90,
  round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.95) OVER w, 4) AS p95,
  round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.97) OVER w, 4) AS p97
FROM fact_trips
WHERE fare_amount > 0 AND trip_distance > 0 AND payment_type_description IN ('Cash', 'Credit card')
WINDOW w AS (PARTITION BY service_type, year, month)"""


@register("fare_percentiles", O.sql(_P_SQL, "fact_trips"))
def q_fare_percentiles(m: Models):
    """M9 / A9 / F6 with the intended labels ('Cash', 'Credit card')."""
    return neutral(M.fare_percentiles(m.fact_trips), round4=["p90", "p95", "p97"])


@register("fare_percentiles_literal", O.sql(_P_SQL.replace("'Credit card'", "'Credit Card'"), "fact_trips"))
def q_fare_percentiles_literal(m: Models):
    """M9 with the literal label list of the original model (T1): card
    trips drop out, only Cash remains."""
    return neutral(M.fare_percentiles(m.fact_trips, labels=("Cash", "Credit Card")),
                   round4=["p90", "p95", "p97"])


@register("fhv_traveltime_p90", O.sql("""SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
  pickup_zone, dropoff_zone, round(p90_duration, 4) AS p90_duration FROM fhv_p90""", "fhv_p90"))
def q_fhv_traveltime_p90(m: Models):
    """M10 / W2 / X10 / U3."""
    return neutral(m.fhv_p90, round4=["p90_duration"])


@register("fhv_top3_dropoff", O.sql("""SELECT pickup_zone, dropoff_zone, round(p90_duration, 4) AS p90_duration
FROM (
  SELECT pickup_zone, dropoff_zone, p90_duration,
    row_number() OVER (PARTITION BY pickup_zone ORDER BY p90_duration DESC NULLS LAST, dropoff_zone ASC NULLS FIRST) AS rn
  FROM fhv_p90
  WHERE year = 1997 AND month = 11 AND pickup_zone IN ('NATION_0', 'NATION_1', 'NATION_5')
) WHERE rn < 4
ORDER BY pickup_zone, p90_duration DESC""", "fhv_p90"))
def q_fhv_top3_dropoff(m: Models):
    """Year 1997, month 11, three pickup zones."""
    return neutral(M.fhv_top3_dropoff(m.fhv_p90, 1997, 11, ["NATION_0", "NATION_1", "NATION_5"]),
                   round4=["p90_duration"])


@register("revenue_yoy", O.sql("""SELECT service_type, CAST(1997 AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,
  CAST(sum(total_amount) FILTER (WHERE year = 1997) AS DOUBLE) AS total,
  CAST(sum(total_amount) FILTER (WHERE year = 1996) AS DOUBLE) AS last_total,
  round(CAST(sum(total_amount) FILTER (WHERE year = 1997) AS DOUBLE)
        / CAST(sum(total_amount) FILTER (WHERE year = 1996) AS DOUBLE) - 1, 4) AS yoy
FROM fact_trips WHERE year IN (1996, 1997)
GROUP BY service_type, quarter HAVING count(DISTINCT year) = 2""", "fact_trips"))
def q_revenue_yoy(m: Models):
    """Year 1997 against 1996."""
    return neutral(M.revenue_yoy(m.fact_trips, 1997), round4=["yoy"])


@register("dedupe_trips", O.sql(f"""SELECT service, vendor_id, pickup_datetime, dropoff_datetime,
  CAST(trip_distance AS DOUBLE) AS trip_distance, CAST(fare_amount AS DOUBLE) AS fare_amount, payment_type
FROM (
  SELECT *, row_number() OVER (PARTITION BY service, vendor_id, pickup_datetime
                               ORDER BY {O._dedup_order(O.GREEN_RAW_COLS)}) AS rn
  FROM trips_raw WHERE vendor_id IS NOT NULL
) WHERE rn = 1""", "trips_raw"))
def q_dedupe_trips(m: Models):
    """One row per (service, vendor, pickup time); total order on the
    remaining columns (T2)."""
    raw = m.trips_raw.filter(F.col("vendor_id").isNotNull())
    d = S.dedupe(raw, ["service", "vendor_id", "pickup_datetime"])
    return neutral(d.select("service", "vendor_id", "pickup_datetime", "dropoff_datetime",
                            "trip_distance", "fare_amount", "payment_type"))


@register("surrogate_key", O.sql(f"""SELECT service, vendor_id, pickup_datetime,
  {O.surrogate('vendor_id', 'pickup_datetime')} AS tripid
FROM trips_raw""", "trips_raw"))
def q_surrogate_key(m: Models):
    """X3 over every raw trip, NULL vendors included (marker text)."""
    return m.trips_raw.select("service", "vendor_id", "pickup_datetime",
                              X.surrogate_key("vendor_id", "pickup_datetime").alias("tripid"))


@register("payment_label", O.sql(f"""SELECT payment_type, {O.payment_label('payment_type')} AS payment_type_description,
  CAST(count(*) AS BIGINT) AS trips
FROM trips_raw GROUP BY 1, 2""", "trips_raw"))
def q_payment_label(m: Models):
    """Label of every raw code (text -> float -> rounded int)."""
    return (m.trips_raw.groupBy("payment_type",
                                X.payment_type_description("payment_type").alias("payment_type_description"))
            .agg(F.count(F.lit(1)).alias("trips")))


@register("safe_cast", O.sql(f"""SELECT payment_type,
  CAST({O.int_text('payment_type')} AS DOUBLE) AS as_int,
  TRY_CAST(payment_type AS DOUBLE) AS as_double,
  CAST(count(*) AS BIGINT) AS trips
FROM trips_raw GROUP BY 1, 2, 3""", "trips_raw"))
def q_safe_cast(m: Models):
    """NULL instead of an error ('x', '2.0' as integer)."""
    return neutral(m.trips_raw.groupBy(
        "payment_type",
        X.safe_cast("payment_type", "int").alias("as_int"),
        X.safe_cast("payment_type", "double").alias("as_double"))
        .agg(F.count(F.lit(1)).alias("trips")), nullable_ints=["as_int"])


_HASH7 = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
          "dropoff_location_id", "fare_amount", "trip_distance"]
_HASH5 = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]


@register("row_hash", O.sql(f"""SELECT service, vendor_id, pickup_datetime, {O.row_hash(*_HASH7)} AS unique_row_id
FROM trips_raw""", "trips_raw"))
def q_row_hash(m: Models):
    """7-field md5 hex row id (fields joined with no separator, T8)."""
    return MG.with_row_id(m.trips_raw, "text").select("service", "vendor_id", "pickup_datetime", "unique_row_id")


@register("row_hash_month", O.sql(f"""SELECT service, vendor_id, pickup_datetime,
  lower(hex(unhex({O.row_hash(*_HASH5)}))) AS unique_row_id_hex
FROM trips_raw""", "trips_raw"))
def q_row_hash_month(m: Models):
    """5-field md5 as 16 bytes (shown as hex for the comparison)."""
    return m.trips_raw.select("service", "vendor_id", "pickup_datetime",
                              F.lower(F.hex(X.row_hash_bytes(*_HASH5))).alias("unique_row_id_hex"))
