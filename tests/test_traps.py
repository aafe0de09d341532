"""Remaining semantic traps with code: T9, T11, T15, T20, T21."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tripmart.functions import exprs as X
from tripmart.operators import staging as S
from tripmart.plans import marts as M
from tripmart.sinks import writers as W
from tripmart.sources import readers as R


def test_t9_hash_uses_decimal_text(spark):
    # doubles print differently across engines (1.0E7); decimals do not
    df = spark.createDataFrame([(1e7,)], "x double")
    r = df.select(X.as_text(F.col("x")).alias("d"), X.as_text(F.col("x").cast("decimal(18,2)")).alias("m")).first()
    assert r.d == "1.0E7" and r.m == "10000000.00"


def test_t11_money_sums_exact(spark):
    n = 1000
    df = spark.createDataFrame([(D("0.10"),)] * n, "x decimal(18,2)")
    s = df.agg(F.sum("x").alias("s")).first().s
    assert s == D("100.00")
    assert df.agg(F.sum("x")).schema[0].dataType.simpleString() == "decimal(28,2)"


def test_t15_all_csv_rows_loaded(spark, tmp_path):
    p = tmp_path / "big.csv"
    header = ",".join(n for n, _ in R.YELLOW_CSV_COLUMNS)
    row = "1,2019-01-01 00:10:00,2019-01-01 00:20:00,1,2.5,1,N,10,20,1,9.5,0.5,0.5,1,0,0.3,11.8,0"
    p.write_text(header + "\n" + "\n".join([row] * 25_000) + "\n")
    assert R.read_trips_csv(spark, str(p), "yellow").count() == 25_000     # no 10,000-row chunk cap


def test_t20_partition_column_is_an_argument(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 23, 0)
    df = spark.createDataFrame([(t, t + dt.timedelta(hours=2))], "pickup timestamp_ntz, dropoff timestamp_ntz")
    col = W.write_partitioned(df, str(tmp_path / "d"), "dropoff")
    back = spark.read.parquet(str(tmp_path / "d"))
    assert col == "dropoff_date" and back.first().dropoff_date == dt.date(2024, 1, 2)


def test_t21_staging_keeps_zoneless_timestamps(spark, sf_small):
    from tripmart.plans.catalog import Models
    m = Models(spark, sf_small)
    types = dict((f.name, f.dataType.simpleString()) for f in m.fact_trips.schema.fields)
    assert types["pickup_datetime"] == "timestamp_ntz" and types["dropoff_datetime"] == "timestamp_ntz"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_t13_revenue_by_zone_name_merges(spark):
    t = dt.datetime(2024, 1, 5)
    rows = [("a", "Green", t, "Z", D("1.00")), ("b", "Green", t, "Z", D("2.00"))]
    fact = spark.createDataFrame(rows, "tripid string, service_type string, pickup_datetime timestamp_ntz, "
                                       "pickup_zone string, total_amount decimal(18,2)")
    for c in ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge"]:
        fact = fact.withColumn(c, F.lit(D("0.00")))
    fact = fact.withColumn("passenger_count", F.lit(1)).withColumn("trip_distance", F.lit(D("1.00")))
    out = M.monthly_zone_revenue(fact).collect()
    assert len(out) == 1 and out[0].revenue_monthly_total_amount == D("3.00") and out[0].total_monthly_trips == 2


def test_dedupe_keeps_key_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k string, v int")
    assert S.dedupe(df, ["k"]).collect()[0].v == 1
