"""Marts: percentiles, year over year, top-k, revenue sums."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tripmart.plans import marts as M
from tripmart.plans.catalog import Models

FACT = ("service_type string, year int, month int, fare_amount decimal(18,2), trip_distance decimal(18,2), "
        "payment_type_description string")


def test_fare_percentiles_one_row_per_group_exact(spark):
    rows = [("Green", 2020, 1, D(f"{v}.00"), D("1.00"), "Cash") for v in range(1, 11)]
    rows += [("Green", 2020, 1, D("99.00"), D("0.00"), "Cash"),       # distance 0: out
             ("Green", 2020, 1, D("0.00"), D("1.00"), "Cash"),        # fare 0: out
             ("Green", 2020, 1, D("50.00"), D("1.00"), "Dispute")]    # label: out
    df = spark.createDataFrame(rows, FACT)
    out = M.fare_percentiles(df).collect()
    assert len(out) == 1
    r = out[0]
    # exact interpolation on 1..10: p90 at 0.9*9 = 8.1 -> 9.1
    assert abs(r.p90 - 9.1) < 1e-9 and abs(r.p95 - 9.55) < 1e-9 and abs(r.p97 - 9.73) < 1e-9


def test_fare_percentiles_literal_labels_drop_card(spark):
    # T1: 'Credit Card' (capital C) matches no label, only Cash remains
    rows = [("Green", 2020, 1, D("10.00"), D("1.00"), "Credit card"),
            ("Green", 2020, 1, D("20.00"), D("1.00"), "Cash")]
    df = spark.createDataFrame(rows, FACT)
    intended = M.fare_percentiles(df).first()
    literal = M.fare_percentiles(df, labels=("Cash", "Credit Card")).first()
    assert intended.p90 < 20.0 and literal.p90 == 20.0


def test_revenue_yoy(spark):
    rows = [(dt.datetime(y, 3 * q, 5), y, q, "Green", D(a)) for y, q, a in
            [(2019, 1, "60.00"), (2019, 1, "40.00"), (2020, 1, "150.00"), (2019, 2, "0.00"), (2020, 2, "5.00"),
             (2020, 3, "1.00"), (2019, 4, "1.00"), (2018, 3, "9.00")]]
    fact = spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, year int, quarter int, service_type string, "
                                       "total_amount decimal(18,2)")
    out = {r.quarter: r for r in M.revenue_yoy(fact, 2020).collect()}
    assert set(out) == {1, 2}                  # a quarter that one year lacks gives no row
    assert abs(float(out[1].yoy) - 0.5) < 1e-12 and out[2].yoy is None


def test_mart_column_names(spark, sf_small):
    from tripmart.plans.catalog import models_for
    for period, mart in (("monthly", M.monthly_zone_revenue), ("quarterly", M.quarterly_revenue)):
        names = mart(models_for(spark, sf_small).fact_trips).columns
        assert names[3:] == [f"revenue_{period}_fare", f"revenue_{period}_extra", f"revenue_{period}_mta_tax",
                             f"revenue_{period}_tip_amount", f"revenue_{period}_tolls_amount",
                             f"revenue_{period}_ehail_fee", f"revenue_{period}_improvement_surcharge",
                             f"revenue_{period}_total_amount", f"total_{period}_trips",
                             f"avg_{period}_passenger_count", f"avg_{period}_trip_distance"]


def test_avg_by_is_exact(spark):
    from tripmart.plans import adhoc as A
    rows = [("a", -1.01), ("b", 1.005), ("b", 1.005), ("c", None), ("d", 0.1234), ("d", 0.1236)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in A.avg_by(df, "k", "v", "m").collect()}
    assert got == {"a": -1.01, "b": 1.01, "c": None, "d": 0.12}
    assert {r.k: r.m for r in A.avg_by(df, "k", "v", "m", 4).collect()}["d"] == 0.1235


def test_days_back_argument_then_environment_then_default(spark, monkeypatch):
    from tripmart.plans import adhoc as A
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in range(1, 32)], "ts timestamp_ntz")
    assert A.last_n_days(df, "ts", 3, "2024-01-31").count() == 4
    assert A.last_n_days(df, "ts", as_of="2024-01-31").count() == 31
    monkeypatch.setenv("DAYS_BACK", "5")
    assert A.last_n_days(df, "ts", as_of="2024-01-31").count() == 6
    assert A.last_n_days(df, "ts", 3, "2024-01-31").count() == 4


def test_top3_per_zone(spark):
    rows = [(2019, 11, "A", f"D{i}", float(i)) for i in range(6)] + [(2019, 11, "B", "D0", 1.0),
                                                                      (2019, 10, "A", "DX", 99.0)]
    p = spark.createDataFrame(rows, "year int, month int, pickup_zone string, dropoff_zone string, "
                                    "p90_duration double")
    out = M.fhv_top3_dropoff(p, 2019, 11, ["A", "B"]).collect()
    assert [(r.pickup_zone, r.dropoff_zone) for r in out] == [("A", "D5"), ("A", "D4"), ("A", "D3"), ("B", "D0")]


def test_marts_sum_to_fact(spark, sf_small):
    m = Models(spark, sf_small)
    fact = m.fact_trips
    total = fact.agg(F.sum("total_amount")).first()[0]
    monthly = M.monthly_zone_revenue(fact).agg(F.sum("revenue_monthly_total_amount")).first()[0]
    quarterly = M.quarterly_revenue(fact).agg(F.sum("revenue_quarterly_total_amount")).first()[0]
    assert total == monthly == quarterly


def test_fact_trips_excludes_unknown_and_unmatched(spark, sf_small):
    m = Models(spark, sf_small)
    fact = m.fact_trips
    assert fact.filter((F.col("pickup_borough") == "Unknown") | (F.col("dropoff_borough") == "Unknown")).count() == 0
    assert fact.count() < m.stg_green.count() + m.stg_yellow.count()     # T14
    r = fact.select("year_quarter", "year", "quarter").first()
    assert r.year_quarter == f"{r.year}_Q{r.quarter}"


def test_repeated_zone_names(spark, sf_small):
    m = Models(spark, sf_small)
    # p90 is computed per id pair; two ids share the name NATION_5
    p = m.fhv_p90
    assert p.count() == p.distinct().count()
    # Monthly revenue groups by zone name, so ids 5 and 6 merge
    mz = M.monthly_zone_revenue(m.fact_trips)
    assert mz.filter(F.col("revenue_zone") == "NATION_6").count() == 0


def test_stg_fhv_to_p90_uses_whole_seconds(spark):
    t0 = dt.datetime(2019, 11, 1)
    rows = [("B", t0, t0 + dt.timedelta(seconds=s), "1", "2", None) for s in (10, 20, 30)]
    raw = spark.createDataFrame(rows, "dispatching_base_num string, pickup_datetime timestamp_ntz, "
                                      "dropOff_datetime timestamp_ntz, PUlocationID string, DOlocationID string, "
                                      "SR_Flag string")
    zones = spark.createDataFrame([(1, "Queens", "Z1", "Boro Zone"), (2, "Queens", "Z2", "Boro Zone")],
                                  "locationid bigint, borough string, zone string, service_zone string")
    from tripmart.operators import staging as S
    fact = M.fact_fhv_trips(S.stg_fhv(raw), S.dim_zones(zones))
    r = M.fhv_traveltime_p90(fact, S.dim_zones(zones)).first()
    assert abs(r.p90_duration - 28.0) < 1e-9
