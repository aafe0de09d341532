"""Core models (M5-M12): fact tables and marts.

Plans are declarative; Catalyst pushes the borough filter below the joins,
prunes columns down to the scans and picks the join strategy from size
statistics (the zone dimension is tiny, so it is broadcast: no shuffle of
the fact side). Percentiles are counted by value with map-side partial
aggregation, never a window over all trips plus DISTINCT (A9, W2).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import quantiles as QT

FARE_LABELS = ("Cash", "Credit card")     # intended labels (T1)
MONEY_COLUMNS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "ehail_fee", "improvement_surcharge", "total_amount"]


def _known_zones(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("borough") != "Unknown")


def _zone_side(dim: DataFrame, role: str) -> DataFrame:
    return dim.select(F.col("locationid").alias(f"_{role}_id"),
                      F.col("borough").alias(f"{role}_borough"),
                      F.col("zone").alias(f"{role}_zone"))


def trips_unioned(green_stg: DataFrame, yellow_stg: DataFrame) -> DataFrame:
    """Both services with their tag, matched by column name."""
    return (green_stg.withColumn("service_type", F.lit("Green"))
            .unionByName(yellow_stg.withColumn("service_type", F.lit("Yellow"))))


def fact_trips(green_stg: DataFrame, yellow_stg: DataFrame, dim_zones: DataFrame) -> DataFrame:
    """M5: trips of both services with pickup and drop-off zones (inner joins,
    Unknown borough excluded, T14) and calendar parts."""
    return fact_from_unioned(trips_unioned(green_stg, yellow_stg), dim_zones)


def fact_from_unioned(t: DataFrame, dim_zones: DataFrame) -> DataFrame:
    """M5 from already unioned staged trips (e.g. a written staging table)."""
    z = _known_zones(dim_zones)
    pu, do = _zone_side(z, "pickup"), _zone_side(z, "dropoff")
    j = (t.join(pu, t.pickup_locationid == pu._pickup_id, "inner")
          .join(do, t.dropoff_locationid == do._dropoff_id, "inner"))
    ts = F.col("pickup_datetime")
    return j.select(
        "tripid", "vendorid", "service_type", "ratecodeid",
        "pickup_locationid", "pickup_borough", "pickup_zone",
        "dropoff_locationid", "dropoff_borough", "dropoff_zone",
        "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
        "trip_distance", "trip_type", *MONEY_COLUMNS, "payment_type", "payment_type_description",
        X.year_of(ts).alias("year"), X.quarter_of(ts).alias("quarter"),
        X.year_quarter(ts).alias("year_quarter"), X.month_of(ts).alias("month"),
    )


def fact_fhv_trips(fhv_stg: DataFrame, dim_zones: DataFrame) -> DataFrame:
    """M6: FHV trips with zones; same inner-join rule as fact_trips."""
    f = fhv_stg.withColumn("service_type", F.lit("fhv"))
    z = _known_zones(dim_zones)
    pu, do = _zone_side(z, "pickup"), _zone_side(z, "dropoff")
    j = (f.join(pu, f.pickup_locationid == pu._pickup_id, "inner")
          .join(do, f.dropoff_locationid == do._dropoff_id, "inner"))
    ts = F.col("pickup_datetime")
    return j.select(X.year_of(ts).alias("year"), X.month_of(ts).alias("month"),
                    *[F.col(c) for c in f.columns],
                    "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


def _revenue_measures(period: str):
    names = {"fare_amount": "fare"}          # the mart says fare, not fare_amount
    return [F.sum(c).alias(f"revenue_{period}_{names.get(c, c)}") for c in MONEY_COLUMNS] + [
        F.count("tripid").alias(f"total_{period}_trips"),
        F.avg("passenger_count").alias(f"avg_{period}_passenger_count"),
        F.avg("trip_distance").alias(f"avg_{period}_trip_distance"),
    ]


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """M7 / A5: revenue by pickup zone name (repeated names merge, T13),
    month and service."""
    return (fact.groupBy(F.col("pickup_zone").alias("revenue_zone"),
                         X.month_start("pickup_datetime").alias("revenue_month"),
                         "service_type")
                .agg(*_revenue_measures("monthly")))


def quarterly_revenue(fact: DataFrame) -> DataFrame:
    """Revenue by year, quarter and service."""
    return fact.groupBy("year", "quarter", "service_type").agg(*_revenue_measures("quarterly"))


def fare_percentiles(fact: DataFrame, labels: Sequence[str] = FARE_LABELS,
                     probs: Sequence[float] = (0.90, 0.95, 0.97)) -> DataFrame:
    """Exact interpolated fare percentiles per service and month.

    Exact without a buffer per group: the fares (written once, with their
    keys) are counted by fixed value buckets, and only values in the buckets
    that hold a wanted rank shuffle (operators/quantiles.py).
    """
    valid = fact.filter((F.col("fare_amount") > 0) & (F.col("trip_distance") > 0)
                        & F.col("payment_type_description").isin(list(labels)))
    keys = ["service_type", "year", "month"]
    names = [f"p{round(p * 100):d}" for p in probs]
    out = QT.grouped_percentiles(valid, keys, F.col("fare_amount"), dict(zip(names, probs)), stage=True)
    return out.select(*keys, *names)


def fhv_traveltime_p90(fact_fhv: DataFrame, dim_zones: DataFrame, prob: float = 0.9) -> DataFrame:
    """p90 of whole-second durations per (year, month, pickup id,
    drop-off id), then zone names and DISTINCT (T12: ids first)."""
    t = fact_fhv.select("year", "month", "pickup_locationid", "dropoff_locationid",
                        X.seconds_between("pickup_datetime", "dropoff_datetime").alias("trip_duration"))
    p = t.groupBy("year", "month", "pickup_locationid", "dropoff_locationid").agg(
        F.percentile(F.col("trip_duration").cast("double"), F.lit(prob)).alias("p90_duration"))
    pz = dim_zones.select(F.col("locationid").alias("_pid"), F.col("zone").alias("pickup_zone"))
    dz = dim_zones.select(F.col("locationid").alias("_did"), F.col("zone").alias("dropoff_zone"))
    j = (p.join(pz, p.pickup_locationid == pz._pid, "inner")
          .join(dz, p.dropoff_locationid == dz._did, "inner"))
    return j.select("year", "month", "pickup_zone", "dropoff_zone", "p90_duration").distinct()


def revenue_yoy(fact: DataFrame, year: int) -> DataFrame:
    """Quarter totals of ``year`` against the same quarter a year
    earlier; a quarter that one of the two years lacks gives no row.

    One pass: both years are one range of pickup times (it reaches the scan),
    and one aggregate sums each year's share of a (service, quarter)."""
    both = fact.filter(X.in_range("pickup_datetime", f"{year - 1}-01-01", f"{year + 1}-01-01"))
    now = F.col("year") == year
    sums = both.groupBy("service_type", "quarter").agg(
        F.sum(F.when(now, F.col("total_amount"))).alias("total"),
        F.sum(F.when(~now, F.col("total_amount"))).alias("last_total"),
        F.count_if(now).alias("_now"), F.count_if(~now).alias("_before"))
    return (sums.filter("_now > 0 AND _before > 0")
            .select("service_type", F.lit(year).alias("year"), "quarter", "total", "last_total",
                    X.growth("total", "last_total").alias("yoy"))
            .orderBy(F.col("service_type").asc_nulls_first(), F.col("yoy").asc_nulls_first()))


def fhv_top3_dropoff(p90: DataFrame, year: int, month: int, pickup_zones: Sequence[str],
                     k: int = 3) -> DataFrame:
    """The k slowest drop-off zones per pickup zone.

    ``row_number() < k+1`` lets Spark insert a per-partition group limit
    before the shuffle, so a hot pickup zone ships at most k rows per task.
    Ties on the duration are broken by drop-off zone name.
    """
    w = Window.partitionBy("pickup_zone").orderBy(F.col("p90_duration").desc_nulls_last(),
                                                  F.col("dropoff_zone").asc_nulls_first())
    a = (p90.filter((F.col("year") == year) & (F.col("month") == month)
                    & F.col("pickup_zone").isin(list(pickup_zones)))
            .withColumn("rn", F.row_number().over(w)))
    return (a.filter(F.col("rn") <= k)
             .select("pickup_zone", "dropoff_zone", "p90_duration")
             .orderBy(F.col("pickup_zone").asc_nulls_first(), F.col("p90_duration").desc_nulls_last()))
