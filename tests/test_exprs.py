"""Column expressions and the semantic traps they carry."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tripmart.functions import exprs as X


def one(spark, col, data, schema):
    return spark.createDataFrame(data, schema).select(col.alias("v")).collect()


def test_surrogate_key_null_marker(spark):
    rows = one(spark, X.surrogate_key("a", "b"), [("1", None)], "a string, b string")
    expect = hashlib.md5(("1-" + X.SURROGATE_NULL_MARKER).encode()).hexdigest()
    assert rows[0].v == expect


def test_row_hash_text_no_separator_collides(spark):
    # Fields are joined with no separator, so ('1','23') == ('12','3')
    df = spark.createDataFrame([("1", "23"), ("12", "3")], "a string, b string")
    vals = {r.v for r in df.select(X.row_hash_text("a", "b").alias("v")).collect()}
    assert len(vals) == 1
    assert vals.pop() == hashlib.md5(b"123").hexdigest()


def test_row_hash_null_is_empty_and_bytes(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    r = df.select(X.row_hash_text("a", "b").alias("h"), X.row_hash_bytes("a", "b").alias("b")).first()
    assert r.h == hashlib.md5(b"x").hexdigest()
    assert bytes(r.b) == hashlib.md5(b"x").digest()


def test_payment_label_rounds_and_uses_argument(spark):
    # T4: the argument is honoured; T5: text -> float -> rounded integer
    data = [("1",), ("2.0",), ("1.5",), ("x",), (None,), ("6",), ("7",)]
    df = spark.createDataFrame(data, "code string")
    got = [r.v for r in df.select(X.payment_type_description("code").alias("v")).collect()]
    assert got == ["Credit card", "Cash", "Cash", "EMPTY", "EMPTY", "Voided trip", "EMPTY"]


def test_seconds_vs_minute_boundaries(spark):
    # 00:00:59 -> 00:01:01 is 2 whole seconds, 0 whole minutes, 1 boundary
    a, b = dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 1)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(X.seconds_between("a", "b").alias("s"),
                  F.timestamp_diff("MINUTE", F.col("a"), F.col("b")).alias("m"),
                  X.minute_boundaries_between("a", "b").alias("mb")).first()
    assert (r.s, r.m, r.mb) == (2, 0, 1)


def test_month_start_stays_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 17, 5, 6, 7),)], "t timestamp_ntz")
    out = df.select(X.month_start("t").alias("m"))
    assert out.schema["m"].dataType.simpleString() == "timestamp_ntz"
    assert out.first().m == dt.datetime(2024, 3, 1)


def test_json_field_missing_vs_null(spark):
    # A missing key gets the default, an explicit null stays NULL
    df = spark.createDataFrame([('{"brand": "a", "price": 3}',), ('{"brand": null}',), ("{}",)], "j string")
    got = [(r.b, r.p) for r in df.select(X.json_field_or("j", "brand").alias("b"),
                                         X.json_field_or("j", "price").alias("p")).collect()]
    assert got == [("a", "3"), (None, "N/A"), ("N/A", "N/A")]


def test_distance_band_edges(spark):
    df = spark.createDataFrame([(x,) for x in [0.5, 1.0, 1.01, 3.0, 7.0, 10.0, 10.5]], "d double")
    got = [r.v for r in df.select(X.distance_band("d").alias("v")).collect()]
    assert got == ["<=1", "<=1", "1-3", "1-3", "3-7", "7-10", ">10"]


def test_growth_zero_base_is_null(spark):
    df = spark.createDataFrame([(10.0, 0.0), (12.0, 10.0)], "a double, b double")
    got = [r.v for r in df.select(X.growth("a", "b").alias("v")).collect()]
    assert got[0] is None and abs(got[1] - 0.2) < 1e-12


def test_on_date_is_half_open(spark):
    ts = [dt.datetime(2024, 1, 4, 23, 59, 59), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5, 23, 59),
          dt.datetime(2024, 1, 6)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    assert df.filter(X.on_date("t", "2024-01-05")).count() == 2


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_number_text_in_both_modes(spark, ansi):
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = ["0", "0.0000001", "-0.0000001", "12.50", "-3", "9999999999999999999.999999999", "100", "0.5", "-0"]
        df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
        for kind in ("decimal(28,9)", "decimal(30,10)"):
            got = [r[0] for r in df.select(X.number_text(F.col("t").cast(kind))).collect()]
            assert got == ["0", "0.0000001", "-0.0000001", "12.5", "-3", "9999999999999999999.999999999", "100", "0.5", "0", None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)
