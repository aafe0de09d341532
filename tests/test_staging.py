"""Staging operators: casts, de-duplication, staging models."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import staging as S
from tripmart.plans.inspect import plan_string
from tripmart.sources import fixtures as FX

RAW = ("vendor_id string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
       "pickup_location_id bigint, dropoff_location_id bigint, payment_type string, rate_code string, "
       "trip_type string, passenger_count string, store_and_fwd_flag string, trip_distance decimal(18,2), "
       "fare_amount decimal(18,2), extra decimal(18,2), mta_tax decimal(18,2), tip_amount decimal(18,2), "
       "tolls_amount decimal(18,2), ehail_fee decimal(18,2), imp_surcharge decimal(18,2), "
       "total_amount decimal(18,2)")


def raw_row(vendor, pickup, payment="1", fare="10.00", dropoff_min=5):
    from decimal import Decimal as D
    p = dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=pickup)
    return (vendor, p, p + dt.timedelta(minutes=dropoff_min), 1, 2, payment, "1", "1", "1", "N",
            D("1.00"), D(fare), D("0.50"), D("0.50"), D("0.00"), D("0.00"), None, D("0.30"), D("11.30"))


def test_dedupe_total_order_and_unique(spark):
    df = spark.createDataFrame([raw_row("1", 0, fare="12.00"), raw_row("1", 0, fare="9.00"),
                                raw_row("1", 0, fare="9.00", dropoff_min=1), raw_row("2", 0)], RAW)
    out = S.dedupe(df, ["vendor_id", "pickup_datetime"])
    rows = {r.vendor_id: r for r in out.collect()}
    assert len(rows) == 2 and out.count() == 2
    # smallest by (dropoff, ...) -> the 1-minute ride
    assert rows["1"].dropoff_datetime == dt.datetime(2024, 1, 1, 0, 1)
    assert out.columns == df.columns


def test_dedupe_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([raw_row("1", 0)], RAW)
    plan = plan_string(S.dedupe(df, ["vendor_id", "pickup_datetime"]), "simple")
    assert "Window" not in plan and "Aggregate" in plan


def test_dedupe_nulls_first(spark):
    df = spark.createDataFrame([("k", None), ("k", "b"), ("k", "a")], "k string, v string")
    assert S.dedupe(df, ["k"]).first().v is None


def test_yellow_vs_green_payment_cast(spark):
    # T6: '2.0' is 0 in yellow (text -> int fails), 2 in green (text -> float -> int)
    df = spark.createDataFrame([raw_row("1", 0, payment="2.0"), raw_row("1", 1, payment="x"),
                                raw_row("1", 2, payment=None)], RAW)
    green = {r.pickup_datetime.minute: (r.payment_type, r.payment_type_description)
             for r in S.stg_green(df).collect()}
    yellow = {r.pickup_datetime.minute: (r.payment_type, r.payment_type_description)
              for r in S.stg_yellow(df.drop("trip_type", "ehail_fee")).collect()}
    assert green == {0: (2, "Cash"), 1: (0, "EMPTY"), 2: (0, "EMPTY")}
    assert yellow == {0: (0, "Cash"), 1: (0, "EMPTY"), 2: (0, "EMPTY")}


def test_staging_drops_null_vendor_and_duplicates(spark):
    df = spark.createDataFrame([raw_row(None, 0), raw_row("1", 0), raw_row("1", 0, fare="3.00")], RAW)
    out = S.stg_green(df)
    assert out.count() == 1
    # Tripid unique after de-duplication
    assert out.groupBy("tripid").count().filter("count > 1").count() == 0


def test_yellow_constants(spark):
    df = spark.createDataFrame([raw_row("1", 0)], RAW).drop("trip_type", "ehail_fee")
    r = S.stg_yellow(df).first()
    assert r.trip_type == 1 and float(r.ehail_fee) == 0.0


def test_sample_run_off_by_default_and_ordered(spark):
    df = spark.createDataFrame([raw_row(str(i), i) for i in range(150)], RAW)
    assert S.stg_green(df).count() == 150          # T3: no silent cap
    capped = S.stg_green(df, test_run=True)
    ids = [r.tripid for r in capped.collect()]
    assert len(ids) == 100 and ids == sorted(ids)


def test_stg_fhv_keeps_nulls_and_duplicates(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("B1", t, t, None, "1", None), ("B1", t, t, None, "1", None)],
                               "dispatching_base_num string, pickup_datetime timestamp_ntz, "
                               "dropOff_datetime timestamp_ntz, PUlocationID string, DOlocationID string, "
                               "SR_Flag string")
    out = S.stg_fhv(df)
    assert out.count() == 2
    assert out.columns == ["dispatching_base_num", "pickup_locationid", "dropoff_locationid",
                           "pickup_datetime", "dropoff_datetime", "sr_flag"]


def test_cast_to_schema_one_projection(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "a bigint, b double, c string")
    schema = T.StructType([T.StructField("a", T.ShortType()), T.StructField("b", T.FloatType())])
    out = S.cast_to_schema(df, schema)
    assert [f.dataType for f in out.schema.fields] == [T.ShortType(), T.FloatType(), T.StringType()]
    with pytest.raises(ValueError):
        S.cast_to_schema(df, T.StructType([T.StructField("zz", T.IntegerType())]))


def test_safe_cast_under_ansi(spark):
    df = spark.createDataFrame([("x",), ("7",)], "s string")
    assert [r.v for r in df.select(F.col("s").try_cast("int").alias("v")).collect()] == [None, 7]


def test_keep_columns_runtime_list(spark):
    df = spark.createDataFrame([(1, '{"brand": "A", "price": 2.5}'), (2, '{"price": 1}')], "id int, j string")
    out = S.keep_columns(df, "j", ["brand", "price"], keep=["id"]).orderBy("id").collect()
    assert [(r.brand, r.price) for r in out] == [("A", "2.5"), ("N/A", "1")]


def test_tighten_types(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None)], "a double, b double")
    out = S.tighten_types(df, ["a", "b"])
    assert out.schema["a"].dataType == T.LongType() and out.schema["b"].dataType == T.DoubleType()


def test_dim_zones_replace(spark):
    z = FX.zones(spark, "/root/testdata/sf0.001")
    d = S.dim_zones(z)
    vals = {r.service_zone for r in d.select("service_zone").distinct().collect()}
    assert vals == {"Green Zone", "Yellow Zone", "Airports"}


def test_wide_ids_and_nine_places(spark):
    from decimal import Decimal as D
    row = list(raw_row("3000000000", 0))
    row[3], row[4] = 5_000_000_000, 6_000_000_000
    wide = spark.createDataFrame([tuple(row)], RAW).withColumn("fare_amount", F.lit(D("1.123456789")).cast("decimal(28,9)"))
    for stg in (S.stg_green(wide), S.stg_yellow(wide)):
        r = stg.first()
        assert (r.vendorid, r.pickup_locationid, r.dropoff_locationid) == (3_000_000_000, 5_000_000_000, 6_000_000_000)
        assert r.fare_amount == D("1.123456789")
        assert stg.schema["payment_type"].dataType.simpleString() == "bigint"
