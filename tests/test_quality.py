"""Data tests find planted faults; severities."""

import pytest

import __spark_entry__ as E
from tripmart.operators import quality as Q


def test_checks_find_planted_faults(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 7), (2, None, 0), (3, "c", 99)], "id int, name string, loc int")
    zones = spark.createDataFrame([(1,), (2,), (3,)], "locationid int")
    assert [r.unique_field for r in Q.check_unique(df, "id").collect()] == [1]
    assert Q.check_not_null(df, "name").count() == 1
    assert {r.from_field for r in Q.check_relationships(df, "loc", zones, "locationid").collect()} == {7, 99, 0}
    bad = {r.value_field: r.n_records for r in Q.check_accepted_values(df, "loc", [1, 2, 3, 4, 5, 6]).collect()}
    assert bad == {7: 1, 0: 1, 99: 1}


def test_unique_ids_of_both_services(spark, sf_small):
    df = spark.createDataFrame([("g", 1), ("g", 1), ("y", 1), ("y", 2), ("y", 2), ("y", None), ("y", None)], "service string, id int")
    found = Q.check_unique(df, "id", within=["service"]).collect()
    assert {(r.service, r.unique_field, r.n_records) for r in found} == {("g", 1, 2), ("y", 2, 2)}
    queries = E.queries()
    rows = queries["dq_unique_services"](spark, sf_small).collect()
    assert {r.service for r in rows} == {"green", "yellow"}
    green = {(r.unique_field, r.n_records) for r in rows if r.service == "green"}
    assert green == {tuple(r) for r in queries["dq_unique"](spark, sf_small).collect()}


def test_report_and_severity(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    checks = [Q.Check("unique", "id", Q.check_unique(df, "id"), "warn"),
              Q.Check("not_null", "id", Q.check_not_null(df, "id"), "error")]
    rep = {r.check_name: (r.failures, r.status) for r in Q.run_checks(checks).collect()}
    assert rep == {"unique": (1, "warn"), "not_null": (1, "fail")}
    with pytest.raises(Q.DataTestError):
        Q.raise_on_error(Q.run_checks(checks))
    Q.raise_on_error(Q.run_checks(checks[:1]))   # warnings let the build go on


def test_default_severity_is_error(spark):
    df = spark.createDataFrame([(None,)], "id int")
    assert Q.Check("not_null", "id", Q.check_not_null(df, "id")).severity == "error"


def test_counts_taken_while_writing_equal_a_pass_of_their_own(spark, tmp_path):
    zones = spark.createDataFrame([(1,), (2,)], "locationid int")
    rows = [("Green", "a", 1, 2, 1), ("Green", "a", 1, 9, 7), ("Green", None, None, 2, 7), ("Green", None, 8, 8, 8),
            ("Yellow", "b", 2, 1, None), ("Yellow", "b", 5, None, 0)]
    trips = spark.createDataFrame(rows, "service_type string, tripid string, pickup_locationid int, dropoff_locationid int, payment_type int")
    monthly = spark.createDataFrame([(1.0,), (None,)], "revenue_monthly_total_amount double")
    written, observed = Q.build_observed(trips, zones, str(tmp_path / "t"))
    assert written.count() == len(rows) and written.columns == trips.columns
    one = sorted(map(tuple, Q.run_suite(written, zones, monthly, observed=observed).collect()))
    two = sorted(map(tuple, Q.run_suite(trips, zones, monthly).collect()))
    assert one == two and len(one) == 11
    by = {(r[0], r[1], r[2]): r[4] for r in one}
    assert by["stg_green", "unique", "tripid"] == 1 and by["stg_green", "not_null", "tripid"] == 2
    assert by["stg_green", "relationships", "dropoff_locationid"] == 2 and by["stg_green", "accepted_values", "payment_type"] == 2
    assert by["stg_yellow", "relationships", "pickup_locationid"] == 1 and by["stg_yellow", "accepted_values", "payment_type"] == 1
