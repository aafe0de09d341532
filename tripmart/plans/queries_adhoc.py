"""Registered ad-hoc queries (F*, A*, J2, J4, J7, L1-L3, U2, S3, S4, P1, P6)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import staging as S
from ..sources import readers as R
from . import adhoc as A
from . import oracle as O
from .catalog import Models, neutral, register

DAY = "1997-06-15"


def _green(m: Models):
    return m.trips_raw.filter(F.col("service") == "green")


def _yellow(m: Models):
    return m.trips_raw.filter(F.col("service") == "yellow")


@register("scan_parquet", "SELECT * FROM lineitem")
def q_scan_parquet(m: Models):
    """S3: the whole lineitem table."""
    return R.read_parquet(m.spark, f"{m.sf_dir}/lineitem.parquet")


@register("external_count", "SELECT CAST(count(*) AS BIGINT) AS row_count FROM lineitem")
def q_external_count(m: Models):
    """A view over a file glob; count(*)."""
    df = R.external_table(m.spark, "lineitem_ext", f"{m.sf_dir}/lineitem*.parquet")
    return A.count_rows(df, "row_count")


@register("zones_preview", O.sql("SELECT * FROM zones ORDER BY locationid NULLS FIRST LIMIT 5", "zones"))
def q_zones_preview(m: Models):
    """L3: first five zones by id."""
    return A.preview(m.zones, ["locationid"], 5)


NARROW_LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.IntegerType()),
    T.StructField("l_suppkey", T.IntegerType()), T.StructField("l_linenumber", T.ShortType()),
    T.StructField("l_quantity", T.FloatType()), T.StructField("l_extendedprice", T.FloatType()),
    T.StructField("l_discount", T.FloatType()), T.StructField("l_tax", T.FloatType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


@register("cast_to_schema", """SELECT l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
  CAST(l_suppkey AS INTEGER) AS l_suppkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
  CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_extendedprice AS FLOAT) AS l_extendedprice,
  CAST(l_discount AS FLOAT) AS l_discount, CAST(l_tax AS FLOAT) AS l_tax,
  l_returnflag, l_linestatus, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate
FROM lineitem""")
def q_cast_to_schema(m: Models):
    """Narrow types in one projection (other columns kept)."""
    return S.cast_to_schema(m.table("lineitem"), NARROW_LINEITEM)


@register("keep_columns", """SELECT event_id,
  CASE WHEN json_exists(props, '$.k') THEN json_extract_string(props, '$.k') ELSE 'N/A' END AS k,
  CASE WHEN json_exists(props, '$.brand') THEN json_extract_string(props, '$.brand') ELSE 'N/A' END AS brand
FROM events""")
def q_keep_columns(m: Models):
    """Keys 'k' (present) and 'brand' (absent) from events.props."""
    return S.keep_columns(m.table("events"), "props", ["k", "brand"], default="N/A", keep=["event_id"])


@register("trips_on_date", O.sql(f"""SELECT CAST(count(*) AS BIGINT) AS trips FROM trips_raw
WHERE CAST(pickup_datetime AS DATE) = DATE '{DAY}'""", "trips_raw"))
def q_trips_on_date(m: Models):
    """F1 / X12."""
    return A.trips_on_date(m.trips_by_date, DAY, date_col="pickup_date")


@register("range_count", O.sql("""SELECT CAST(count(*) AS BIGINT) AS trips FROM trips_raw
WHERE pickup_datetime >= TIMESTAMP '1997-06-01' AND dropoff_datetime < TIMESTAMP '1997-07-01'
  AND trip_distance > 10""", "trips_raw"))
def q_range_count(m: Models):
    """F2."""
    return A.range_count(m.trips_by_date, "1997-06-01", "1997-07-01", 10, date_col="pickup_date")


@register("distance_bands", O.sql("""SELECT CASE WHEN trip_distance <= 1 THEN '<=1'
  WHEN trip_distance <= 3 THEN '1-3' WHEN trip_distance <= 7 THEN '3-7'
  WHEN trip_distance <= 10 THEN '7-10' WHEN trip_distance > 10 THEN '>10' END AS band,
  CAST(count(*) AS BIGINT) AS trips
FROM trips_raw GROUP BY 1""", "trips_raw"))
def q_distance_bands(m: Models):
    """F3."""
    return A.distance_bands(m.trips_raw)


@register("zero_fare_count", O.sql("SELECT CAST(count(*) AS BIGINT) AS trips FROM trips_raw WHERE fare_amount = 0",
                                   "trips_raw"))
def q_zero_fare_count(m: Models):
    """F7."""
    return A.zero_fare_count(m.trips_raw)


@register("distinct_pickups", O.sql(
    "SELECT CAST(count(DISTINCT pickup_location_id) AS BIGINT) AS distinct_pickups FROM trips_raw", "trips_raw"))
def q_distinct_pickups(m: Models):
    """A2: exact."""
    return A.distinct_count(m.trips_raw, "pickup_location_id", "distinct_pickups")


@register("last_n_days", """SELECT * FROM events
WHERE ts >= CAST(DATE '2024-01-31' - INTERVAL 7 DAY AS TIMESTAMP)""")
def q_last_n_days(m: Models):
    """as_of 2024-01-31, 7 days."""
    return A.last_n_days(m.table("events"), "ts", 7, "2024-01-31")


@register("longest_trip", O.sql("""SELECT pickup_datetime, CAST(trip_distance AS DOUBLE) AS trip_distance
FROM trips_raw WHERE service = 'green'
  AND trip_distance = (SELECT max(trip_distance) FROM trips_raw WHERE service = 'green')""", "trips_raw"))
def q_longest_trip(m: Models):
    """scalar subquery."""
    return neutral(A.longest_trip(_green(m)))


@register("largest_tip_dropoff", O.sql("""SELECT z.zone AS dropoff_zone, CAST(g.tip_amount AS DOUBLE) AS tip_amount
FROM (SELECT * FROM trips_raw WHERE service = 'green') g
LEFT JOIN zones z ON g.dropoff_location_id = z.locationid
WHERE g.tip_amount = (
  SELECT max(g2.tip_amount) FROM trips_raw g2
  JOIN zones z2 ON g2.pickup_location_id = z2.locationid
  WHERE g2.service = 'green' AND z2.zone = 'NATION_3')""", "trips_raw", "zones"))
def q_largest_tip_dropoff(m: Models):
    """F10 / J7."""
    return neutral(A.largest_tip_dropoff(_green(m), m.zones, "NATION_3"))


@register("top_pickup_zones", O.sql(f"""SELECT CAST(t.total AS DOUBLE) AS total, z.zone
FROM (SELECT pickup_location_id, sum(total_amount) AS total FROM trips_raw
      WHERE service = 'green' AND CAST(pickup_datetime AS DATE) = DATE '{DAY}'
      GROUP BY pickup_location_id HAVING sum(total_amount) > 50000) t
LEFT JOIN zones z ON t.pickup_location_id = z.locationid
ORDER BY t.total DESC""", "trips_raw", "zones"))
def q_top_pickup_zones(m: Models):
    """A4 / F11 / J2."""
    green = m.trips_by_date.filter(F.col("service") == "green")
    return neutral(A.top_pickup_zones(green, m.zones, DAY, 50000, date_col="pickup_date"))


@register("pickup_frequency", O.sql("""SELECT pickup_location_id, z.zone, CAST(count(*) AS BIGINT) AS numtrips
FROM trips_raw t JOIN zones z ON t.pickup_location_id = z.locationid
WHERE t.service = 'yellow'
GROUP BY t.pickup_location_id, z.zone ORDER BY numtrips""", "trips_raw", "zones"))
def q_pickup_frequency(m: Models):
    """J4 / L1."""
    return A.pickup_frequency(_yellow(m), m.zones)


@register("max_duration", O.sql("""SELECT max(date_sub('second', pickup_datetime, dropoff_datetime)) AS max_duration_sec
FROM trips_raw WHERE service = 'yellow'""", "trips_raw"))
def q_max_duration(m: Models):
    """A3 / X10."""
    return A.max_duration(_yellow(m))


@register("avg_trip_minutes", O.sql("""SELECT round(avg(date_diff('minute', pickup_datetime, dropoff_datetime)), 4)
  AS avg_trip_minutes FROM trips_raw""", "trips_raw"))
def q_avg_trip_minutes(m: Models):
    """Minute boundaries."""
    return neutral(A.avg_trip_minutes(m.trips_raw), round4=["avg_trip_minutes"])


@register("avg_price_by_brand", """SELECT p_brand AS brand, round(avg(p_retailprice), 2) AS avg_price
FROM part GROUP BY p_brand ORDER BY avg_price DESC""")
def q_avg_price_by_brand(m: Models):
    """A8 / X14 over part (brand, price)."""
    return A.avg_by(m.table("part").withColumnRenamed("p_brand", "brand"), "brand", "p_retailprice",
                    "avg_price", 2)


def _describe_sql(cols):
    stats = [("count", "CAST(count({c}) AS DOUBLE)"), ("mean", "avg({c})"), ("stddev", "stddev_samp({c})"),
             ("min", "CAST(min({c}) AS DOUBLE)"), ("25%", "quantile_cont({c}, 0.25)"),
             ("50%", "quantile_cont({c}, 0.5)"), ("75%", "quantile_cont({c}, 0.75)"),
             ("max", "CAST(max({c}) AS DOUBLE)")]
    parts = []
    for s, e in stats:
        vals = ", ".join(f"round({e.format(c=c)}, 4) + 0.0 AS {c}" for c in cols)
        parts.append(f"SELECT '{s}' AS summary, {vals} FROM lineitem")
    return "\nUNION ALL\n".join(parts)


_LINEITEM_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax"]


@register("describe_numeric", _describe_sql(_LINEITEM_NUMBERS))
def q_describe_numeric(m: Models):
    """A10: summary of every numeric column of lineitem."""
    return neutral(A.describe_numeric(m.table("lineitem")), round4=_LINEITEM_NUMBERS)


@register("yearly_union", """SELECT * FROM orders WHERE year(o_orderdate) = 1996
UNION ALL SELECT * FROM orders WHERE year(o_orderdate) = 1997""")
def q_yearly_union(m: Models):
    """One table per year, stacked."""
    o = m.table("orders")
    return A.union_all([o.filter(F.year("o_orderdate") == y) for y in (1996, 1997)])

