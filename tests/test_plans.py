"""Physical plan checks: broadcast of the zone dimension, no Python in any
plan, partial aggregation for de-duplication, group limit for top-k."""

import pytest

import __spark_entry__ as E
from tripmart.plans import catalog
from tripmart.plans.inspect import plan_string, python_nodes

SKIP_SIDE_EFFECTS = {"merge_insert_new", "ingest_month", "ingest_csv", "ingest_stream", "partition_pruned_scan",
                     "target_table"}


def test_fact_trips_broadcasts_zones(spark, sf_small):
    plan = plan_string(E.queries()["fact_trips"](spark, sf_small))
    assert plan.count("BroadcastHashJoin") >= 2


def test_scan_prunes_columns(spark, sf_small):
    from pyspark.sql import functions as F
    from tripmart.plans.catalog import Models
    # the fixture plan itself: the lineitem scan reads only the columns a count needs
    m = Models(spark, sf_small, materialize_inputs=False)
    plan = plan_string(m.trips_raw.agg(F.count_distinct("pickup_location_id")))
    line = [l for l in plan.splitlines() if "ReadSchema" in l and "l_orderkey" in l][0]
    assert "l_extendedprice" not in line and "l_returnflag" not in line
    # the registered query over the landed raw table reads one column
    plan = plan_string(E.queries()["distinct_pickups"](spark, sf_small))
    assert "ReadSchema: struct<pickup_location_id:bigint>" in plan


def test_service_split_is_partition_pruning(spark, sf_small):
    from tripmart.plans.catalog import models_for
    plan = plan_string(models_for(spark, sf_small).raw_green)
    assert "PartitionFilters: [isnotnull(service" in plan and "(service#" in plan


@pytest.mark.parametrize("key", sorted(set(catalog.load()[0]) - SKIP_SIDE_EFFECTS))
def test_no_python_in_plans(spark, sf_small, key):
    assert python_nodes(E.queries()[key](spark, sf_small)) == []


def test_top3_uses_group_limit(spark, sf_small):
    plan = plan_string(E.queries()["fhv_top3_dropoff"](spark, sf_small))
    assert "WindowGroupLimit" in plan


def test_dedupe_has_partial_aggregate(spark, sf_small):
    plan = plan_string(E.queries()["dedupe_trips"](spark, sf_small))
    assert "partial_min" in plan and "Window" not in plan


def test_registered_pruned_scan_prunes(spark, sf_small):
    plan = plan_string(E.queries()["partition_pruned_scan"](spark, sf_small))
    assert "PartitionFilters: [isnotnull(event_date" in plan


@pytest.mark.parametrize("key", ["trips_on_date", "range_count", "top_pickup_zones"])
def test_date_queries_prune_partitions(spark, sf_small, key):
    plan = plan_string(E.queries()[key](spark, sf_small))
    line = [x for x in plan.splitlines() if "PartitionFilters" in x and "pickup_date#" in x]
    assert line and "pickup_date" in line[0].split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_yoy_reads_both_years_in_one_range(spark, sf_small):
    plan = plan_string(E.queries()["revenue_yoy"](spark, sf_small))
    scans = [x for x in plan.splitlines() if "PushedFilters" in x and "pickup_datetime" in x]
    assert len(scans) == 2                    # one scan a service
    assert all("GreaterThanOrEqual(pickup_datetime" in x and "LessThan(pickup_datetime" in x for x in scans)


def test_suite_scans_the_staged_trips_twice_at_most(spark, sf_small):
    from tripmart.operators import quality as Q
    from tripmart.plans import marts as M
    m = catalog.models_for(spark, sf_small)
    import tempfile
    path = tempfile.mkdtemp(prefix="tripmart-suite-") + "/t"
    M.trips_unioned(m.stg_green, m.stg_yellow).write.parquet(path)
    t = spark.read.parquet(path)
    zones = spark.createDataFrame([(1,)], "locationid bigint")
    monthly = spark.createDataFrame([(None,)], "revenue_monthly_total_amount double")
    plan = plan_string(Q.run_suite(t, zones, monthly))
    assert plan.count("FileScan parquet") <= 2 or plan.count("Scan parquet") <= 2
