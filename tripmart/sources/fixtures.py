"""Trip-shaped views over the driver's tables (FIXTURES.md B1-B3).

The original pipelines read monthly taxi trip files and a zone seed. Offline
we play them from the TPC-H-like tables: ``trips_raw`` from lineitem x orders
x customer x supplier, ``fhv_raw`` from orders x customer and ``zones`` from
nation x region. Every value is derived from the source rows, so the work
grows with the tables.

Join order: orders is joined to customer first (one row per order), then
lineitem to that on the order key (the one large shuffle join), then to
supplier. Catalyst picks broadcast vs. sort-merge from the size statistics
(``spark.sql.autoBroadcastJoinThreshold``, re-checked by AQE at run time), so
no side is broadcast without a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import to_ts
from .readers import spread

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the fixture mapping (FIXTURES.md B1-B3).
SERVICE_BY_LINESTATUS = {"F": "green", "O": "yellow"}
UNKNOWN_REGION = "MIDDLE EAST"
REPEATED_ZONE_NATION = 6          # its zone name repeats nation 5's
MONEY = "decimal(18,2)"           # the fixture's amounts (T11)
SERVICE_ZONES = ["Boro Zone", "Yellow Zone", "Airports"]   # by n_nationkey % 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _reader(spark: SparkSession, sf_dir: str, tables):
    if tables is None:
        return lambda name: table(spark, sf_dir, name)
    return tables


def _money(c):
    return c.cast("decimal(18,2)")


def trips_raw(spark: SparkSession, sf_dir: str, tables=None) -> DataFrame:
    """Raw green + yellow trips, one row per lineitem (B1)."""
    t = _reader(spark, sf_dir, tables)
    # both large inputs: whichever side the planner streams gets all cores
    li = spread(t("lineitem"), ["l_orderkey", "l_linenumber"])   # a hot order still spreads
    orders = spread(t("orders").select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_orderkey"])
    cust = t("customer").select("c_custkey", "c_nationkey")
    supp = t("supplier").select("s_suppkey", "s_nationkey")

    oc = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey, "inner")
           .join(supp, li.l_suppkey == supp.s_suppkey, "inner"))

    service = F.when(F.col("l_linestatus") == "F", "green").when(F.col("l_linestatus") == "O", "yellow")
    pickup = F.timestamp_add("SECOND", (F.col("l_suppkey") * 997) % 86400, F.col("l_shipdate"))
    ride_secs = (F.col("l_quantity") * 60 + F.col("l_partkey") % 60).cast("bigint")
    pk20 = F.col("l_partkey") % 20
    payment = (F.when(pk20 == 0, F.lit(None).cast("string"))
                .when(pk20 == 1, F.lit("x"))
                .when(pk20 == 2, F.lit("2.0"))
                .when(pk20 == 3, F.lit("6"))
                .otherwise(F.substring("o_orderpriority", 1, 1)))
    price = _money(F.col("l_extendedprice"))
    fare = F.when(F.col("l_partkey") % 25 == 0, _money(F.lit(0))).otherwise(price)
    tip = (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")
    mta = (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)")
    is_green = F.col("l_linestatus") == "F"

    base = j.select(
        service.alias("service"),
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("l_suppkey").cast("string")).alias("vendor_id"),
        pickup.alias("pickup_datetime"),
        ride_secs.alias("_ride_secs"),
        F.col("c_nationkey").cast("bigint").alias("pickup_location_id"),
        F.col("s_nationkey").cast("bigint").alias("dropoff_location_id"),
        payment.alias("payment_type"),
        (F.col("l_linenumber") % 6 + 1).cast("string").alias("rate_code"),
        F.when(is_green, (F.col("l_linenumber") % 2 + 1).cast("string")).alias("trip_type"),
        F.col("l_linenumber").cast("string").alias("passenger_count"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        _money(F.col("l_quantity")).alias("trip_distance"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        mta.alias("mta_tax"),
        _money(F.lit(0.5)).alias("extra"),
        _money(F.lit(0.3)).alias("imp_surcharge"),
        _money(F.lit(0)).alias("tolls_amount"),
        F.when(is_green, _money(F.lit(None))).alias("ehail_fee"),
    )
    return base.select(
        "service", "vendor_id", "pickup_datetime",
        F.timestamp_add("SECOND", F.col("_ride_secs"), F.col("pickup_datetime")).alias("dropoff_datetime"),
        "pickup_location_id", "dropoff_location_id", "payment_type", "rate_code", "trip_type",
        "passenger_count", "store_and_fwd_flag", "trip_distance", "fare_amount", "extra", "mta_tax",
        "tip_amount", "tolls_amount", "ehail_fee", "imp_surcharge",
        (F.col("fare_amount") + F.col("tip_amount") + F.col("mta_tax") + _money(F.lit(0.8)))
        .cast("decimal(18,2)").alias("total_amount"),
    )


def service_trips(raw: DataFrame, service: str) -> DataFrame:
    """The raw table of one service ('green' or 'yellow')."""
    out = raw.filter(F.col("service") == service).drop("service")
    if service == "yellow":
        out = out.drop("trip_type", "ehail_fee")
    return out


def fhv_raw(spark: SparkSession, sf_dir: str, tables=None) -> DataFrame:
    """Raw for-hire-vehicle trips, one row per order (B2)."""
    t = _reader(spark, sf_dir, tables)
    orders = spread(t("orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_orderkey"])
    cust = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    return j.select(
        F.col("c_mktsegment").alias("dispatching_base_num"),
        to_ts("o_orderdate").alias("pickup_datetime"),
        F.timestamp_add("SECOND", (F.col("o_orderkey") * 7919) % 7200, to_ts("o_orderdate"))
         .alias("dropOff_datetime"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None).cast("string"))
         .otherwise((F.col("c_nationkey") % 7).cast("string")).alias("PUlocationID"),
        (F.col("o_orderkey") % 7).cast("string").alias("DOlocationID"),
        F.lit(None).cast("string").alias("SR_Flag"),
    )


def zones(spark: SparkSession, sf_dir: str, tables=None) -> DataFrame:
    """Zone seed: locationid, borough, zone, service_zone."""
    t = _reader(spark, sf_dir, tables)
    n = t("nation")
    r = t("region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "inner")
    sz = F.col("n_nationkey") % 3
    return j.select(
        F.col("n_nationkey").cast("bigint").alias("locationid"),
        F.when(F.col("r_name") == UNKNOWN_REGION, F.lit("Unknown")).otherwise(F.col("r_name")).alias("borough"),
        F.when(F.col("n_nationkey") == REPEATED_ZONE_NATION, F.lit("NATION_5")).otherwise(F.col("n_name")).alias("zone"),
        F.when(sz == 0, SERVICE_ZONES[0]).when(sz == 1, SERVICE_ZONES[1]).otherwise(SERVICE_ZONES[2]).alias("service_zone"),
    )


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Driver tables plus the three fixture views, for SQL users."""
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    trips_raw(spark, sf_dir).createOrReplaceTempView("trips_raw")
    fhv_raw(spark, sf_dir).createOrReplaceTempView("fhv_raw")
    zones(spark, sf_dir).createOrReplaceTempView("zones")
