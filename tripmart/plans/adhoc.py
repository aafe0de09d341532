"""Ad-hoc analytical queries over trips.

Counts and global aggregates return one-row DataFrames (never a Python
number), so they compose and stay lazy. Scalar subqueries (F9, F10) use
``DataFrame.scalar()``: Spark runs the inner aggregate once, distributed,
and the outer filter is an ordinary parallel scan.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import exprs as X
from ..operators import quantiles as QT


def count_rows(df: DataFrame, name: str = "trips") -> DataFrame:
    """A1: ``count(*)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def trips_on_date(trips: DataFrame, day: str, ts: str = "pickup_datetime",
                  date_col: str | None = None) -> DataFrame:
    """trips that start on a calendar day. ``date_col``: the table's
    partition column with the date of ``ts``, so that one partition is read."""
    return count_rows(trips.filter(X.on_date(ts, day, date_col)))


def range_count(trips: DataFrame, start: str, end: str, min_distance: float,
                start_col: str = "pickup_datetime", end_col: str = "dropoff_datetime",
                date_col: str | None = None) -> DataFrame:
    """started on/after ``start``, ended before ``end``, longer than the
    threshold. ``date_col``: partition column with the date of ``start_col``."""
    return count_rows(trips.filter(
        X.since(start_col, F.lit(start).cast("timestamp_ntz"), date_col)
        & (F.col(end_col) < F.lit(end).cast("timestamp_ntz"))
        & (F.col("trip_distance") > min_distance)))


def distance_bands(trips: DataFrame, edges: Sequence[float] = (1, 3, 7, 10),
                   col: str = "trip_distance") -> DataFrame:
    """trips per distance band, one pass."""
    return (trips.groupBy(X.distance_band(col, edges).alias("band"))
                 .agg(F.count(F.lit(1)).alias("trips")))


def zero_fare_count(trips: DataFrame) -> DataFrame:
    """F7."""
    return count_rows(trips.filter(F.col("fare_amount") == 0))


def last_n_days(df: DataFrame, col: str, n: int | None = None, as_of: str | None = None,
                date_col: str | None = None) -> DataFrame:
    """F8 / V2: rows on/after ``as_of - n days``. The number of days is the
    argument, else the environment's ``DAYS_BACK``, else 30; ``as_of`` is
    today unless given (give it for results that repeat)."""
    days = config.setting("days_back", config.DEFAULT_DAYS_BACK, value=n, cast=int)
    start = X.days_back(as_of, days) if as_of else F.date_sub(F.current_date(), days).cast("timestamp_ntz")
    return df.filter(X.since(col, start, date_col))


def longest_trip(trips: DataFrame) -> DataFrame:
    """pickup time of the trip(s) with the greatest distance (ties kept)."""
    longest = trips.select(F.max("trip_distance")).scalar()
    return trips.filter(F.col("trip_distance") == longest).select("pickup_datetime", "trip_distance")


def largest_tip_dropoff(trips: DataFrame, zones: DataFrame, pickup_zone: str) -> DataFrame:
    """Drop-off zone of every trip whose tip equals the largest tip
    among trips picked up in ``pickup_zone``."""
    z = zones.select("locationid", "zone")
    top_tip = (trips.join(z.filter(F.col("zone") == pickup_zone),
                          trips.pickup_location_id == z.locationid, "inner")
                    .select(F.max("tip_amount"))).scalar()
    hits = trips.filter(F.col("tip_amount") == top_tip)
    return (hits.join(z, hits.dropoff_location_id == z.locationid, "left")
                .select(F.col("zone").alias("dropoff_zone"), "tip_amount"))


def top_pickup_zones(trips: DataFrame, zones: DataFrame, day: str, threshold: float,
                     date_col: str | None = None) -> DataFrame:
    """Per pickup location on one day, total amount over a
    threshold (HAVING), named by a left join after the aggregate, largest first."""
    t = (trips.filter(X.on_date("pickup_datetime", day, date_col))
              .groupBy("pickup_location_id").agg(F.sum("total_amount").alias("total"))
              .filter(F.col("total") > threshold))
    z = zones.select("locationid", "zone")
    return (t.join(z, t.pickup_location_id == z.locationid, "left")
             .select("total", "zone").orderBy(F.col("total").desc_nulls_last()))


def pickup_frequency(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per pickup location and zone, least frequent first."""
    z = zones.select("locationid", "zone")
    j = trips.join(z, trips.pickup_location_id == z.locationid, "inner")
    return (j.groupBy("pickup_location_id", "zone").agg(F.count(F.lit(1)).alias("numtrips"))
             .orderBy(F.col("numtrips").asc_nulls_first()))


def distinct_count(df: DataFrame, col: str, name: str = "distinct_count") -> DataFrame:
    """A2: exact distinct count (never the approximate sketch)."""
    return df.agg(F.count_distinct(F.col(col)).alias(name))


def max_duration(trips: DataFrame) -> DataFrame:
    """Longest trip in whole seconds."""
    return trips.agg(F.max(X.seconds_between("pickup_datetime", "dropoff_datetime"))
                     .alias("max_duration_sec"))


def avg_trip_minutes(trips: DataFrame, start: str = "pickup_datetime",
                     end: str = "dropoff_datetime") -> DataFrame:
    """Mean of minute boundaries crossed per trip."""
    return trips.agg(F.avg(X.minute_boundaries_between(start, end)).alias("avg_trip_minutes"))


def avg_by(df: DataFrame, key: str, value: str, name: str, places: int = 2) -> DataFrame:
    """Rounded mean per key, largest first.

    The mean is taken over exact decimals, so it does not depend on the order
    in which partial sums are added, and rounded half away from zero; a group
    of only NULLs has a NULL mean."""
    exact = F.avg(F.col(value).cast("decimal(28,9)"))
    return (df.groupBy(key).agg(F.round(exact, places).cast("double").alias(name))
            .orderBy(F.col(name).desc_nulls_last()))


SUMMARY = ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A10: count, mean, stddev, min, exact quartiles, max: one row per
    statistic, one column per numeric column (all of them by default).

    The moments of all columns are one global aggregate. The quartiles are the
    exact percentile by column over (column, value) rows: values are counted
    by buckets and only the few wanted buckets' values shuffle.
    """
    cols = list(cols) if cols is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    x = {c: F.col(f"`{c}`").cast("double") for c in cols}
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), x[c].alias("x")) for c in cols])
    moments = df.agg(F.array(*[F.struct(
        F.lit(c).alias("name"), F.count(x[c]).cast("double").alias("count"), F.avg(x[c]).alias("mean"),
        F.stddev_samp(x[c]).alias("stddev"), (F.min(x[c]) + 0.0).alias("min"), (F.max(x[c]) + 0.0).alias("max"))
        for c in cols]).alias("m"))
    quarters = QT.grouped_percentiles(df.select(F.inline(pairs)), ["name"], F.col("x"), {"25%": 0.25, "50%": 0.5, "75%": 0.75})
    both = moments.select(F.inline("m")).join(quarters, "name", "left")          # a row a column
    stats = F.array(*[F.struct(F.lit(s).alias("summary"), F.col(f"`{s}`").alias("v")) for s in SUMMARY])
    return (both.select("name", F.inline(stats)).groupBy("summary")
            .agg(*[F.max(F.when(F.col("name") == c, F.col("v"))).alias(c) for c in cols]))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """L3: ``LIMIT n`` with an explicit order so the rows repeat."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
