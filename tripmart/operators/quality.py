"""Data tests (Q1-Q5): unique, not_null, relationships, accepted_values.

Each check returns the offending rows as a DataFrame (as a data test's SQL
does); ``run_checks`` turns a list of checks into one report frame with one
row per check, and ``raise_on_error`` fails the build when an error-level
check found rows. Only the report (one row per check) ever reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config


def check_unique(df: DataFrame, col: str, within: Sequence[str] = ()) -> DataFrame:
    """Q1: keys that occur more than once (NULL keys are ignored), for each
    value of the columns ``within``."""
    return (df.filter(F.col(col).isNotNull())
              .groupBy(*within, F.col(col).alias("unique_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Q2: rows whose column is NULL."""
    return df.filter(F.col(col).isNull())


def check_relationships(df: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Q3: child rows whose non-null key has no parent row (anti join)."""
    child = df.filter(F.col(col).isNotNull()).select(F.col(col).alias("from_field"))
    parents = parent.select(F.col(key).alias("_to_field"))
    return child.join(parents, child.from_field == parents._to_field, "left_anti")


def check_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q4: values outside the accepted list, with their counts."""
    return (df.groupBy(F.col(col).alias("value_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .filter(~F.col("value_field").isin(list(values))))


@dataclass
class Check:
    name: str
    column: str
    failures: DataFrame
    severity: str = "error"   # a check without a stated severity is an error (T18)


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """Q5: one report row per check: name, column, severity, failures, status.

    ``failures`` is the number of rows the check returned. Status is 'pass',
    'warn' or 'fail' (an error-level check with failures).
    """
    if not checks:
        raise ValueError("run_checks needs at least one check")
    parts = []
    for c in checks:
        n = c.failures.agg(F.count(F.lit(1)).alias("failures"))
        parts.append(n.select(
            F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
            F.lit(c.severity).alias("severity"), F.col("failures"),
            F.when(F.col("failures") == 0, "pass")
             .when(F.lit(c.severity) == "warn", "warn").otherwise("fail").alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The project's declared tests of a staged service: column -> severity.
SUITE_SEVERITY = {
    "green": {"unique": "warn", "not_null": "warn", "pickup": "warn", "dropoff": "error", "accepted": "warn"},
    "yellow": {"unique": "warn", "not_null": "warn", "pickup": "warn", "dropoff": "warn", "accepted": "warn"},
}


def _with_known(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with ``_service``, and for either location whether a zone has it."""
    ids = zones.select(F.col("locationid").alias("_id"), F.lit(True).alias("_known")).distinct()
    t = trips.withColumn("_service", F.lower("service_type"))
    for side in ("pickup", "dropoff"):
        z = ids.select(F.col("_id").alias(f"_{side}"), F.col("_known").alias(f"_{side}_known"))
        t = t.join(z, t[f"{side}_locationid"] == z[f"_{side}"], "left")
    return t


def _row_failures() -> dict:
    """Conditions under which a row of :func:`_with_known` fails a test."""
    lost = {s: F.col(f"{s}_locationid").isNotNull() & F.col(f"_{s}_known").isNull() for s in ("pickup", "dropoff")}
    return {"not_null": F.col("tripid").isNull(), **lost}


def build_observed(trips: DataFrame, zones: DataFrame, path: str) -> tuple[DataFrame, dict[str, dict[str, int]]]:
    """Write the staged trips and take the counts of the null and relationship
    tests while writing (no scan of their own): the written table, and failures
    by service and test. The counts are taken in the writing stage, so a task
    that runs again counts once."""
    seen = Observation()
    rows = _with_known(trips, zones)
    counts = [F.count_if((F.col("_service") == s) & bad).alias(f"{s}_{k}")
              for s in SUITE_SEVERITY for k, bad in _row_failures().items()]
    rows.observe(seen, *counts).select(*trips.columns).write.mode("errorifexists").parquet(path)
    got = seen.get
    failures = {s: {k: got[f"{s}_{k}"] for k in _row_failures()} for s in SUITE_SEVERITY}
    return trips.sparkSession.read.parquet(path), failures


def _keyed_failures(trips: DataFrame, accepted: Sequence[int]) -> DataFrame:
    """(_service, unique, accepted): ids that occur more than once and values
    outside the list, by one aggregate over two grouping sets."""
    strange = F.when(~F.col("payment_type").isin(list(accepted)), F.col("payment_type"))
    t = trips.select(F.lower("service_type").alias("_service"), "tripid", strange.alias("_value"))
    sets = t.groupingSets([[F.col("_service"), F.col("tripid")], [F.col("_service"), F.col("_value")]],
                          "_service", "tripid", "_value").agg(F.count(F.lit(1)).alias("_n"), F.grouping("tripid").alias("_of_value"))
    return sets.groupBy("_service").agg(
        F.count_if((F.col("_of_value") == 0) & F.col("tripid").isNotNull() & (F.col("_n") > 1)).alias("unique"),
        F.count_if((F.col("_of_value") == 1) & F.col("_value").isNotNull()).alias("accepted"))


def run_suite(staged_trips: DataFrame, zones: DataFrame, monthly: DataFrame,
              accepted: Sequence[int] = config.PAYMENT_TYPE_VALUES,
              observed: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """The project's test suite: five tests on each staged service and one on
    the monthly mart, one report row each (model, check_name, column_name,
    severity, failures, status).

    ``staged_trips`` holds both services (service_type Green or Yellow).
    ``observed`` are the row counts that :func:`build_observed` took while
    writing; without them one more pass counts (zones joined by left joins).
    ``unique`` and ``accepted_values`` share one aggregate.
    """
    spark, kinds = staged_trips.sparkSession, list(_row_failures())
    if observed is None:
        once = _with_known(staged_trips, zones).groupBy("_service").agg(
            *[F.count_if(bad).alias(k) for k, bad in _row_failures().items()])
    else:
        once = spark.createDataFrame([(s, *[v[k] for k in kinds]) for s, v in observed.items()],
                                     "_service string, " + ", ".join(f"{k} long" for k in kinds))
    counts = once.join(_keyed_failures(staged_trips, accepted), "_service", "left")
    names = [("unique", "unique", "tripid"), ("not_null", "not_null", "tripid"),
             ("relationships", "pickup", "pickup_locationid"), ("relationships", "dropoff", "dropoff_locationid"),
             ("accepted_values", "accepted", "payment_type")]
    # every declared test reports, also for a service without a row
    declared = spark.createDataFrame(
        [(s, k, n, c, SUITE_SEVERITY[s][k]) for s in SUITE_SEVERITY for n, k, c in names],
        "_service string, _key string, check_name string, column_name string, severity string")
    long = counts.select("_service", F.inline(F.array(*[
        F.struct(F.lit(k).alias("_key"), F.col(k).cast("bigint").alias("_failures")) for _, k, _ in names])))
    out = declared.join(long, ["_service", "_key"], "left").select(
        F.concat(F.lit("stg_"), "_service").alias("model"), "check_name", "column_name", "severity",
        F.coalesce("_failures", F.lit(0).cast("bigint")).alias("failures"))
    total = "revenue_monthly_total_amount"
    mart = monthly.agg(F.count_if(F.col(total).isNull()).alias("failures")).select(
        F.lit("monthly_zone_revenue").alias("model"), F.lit("not_null").alias("check_name"),
        F.lit(total).alias("column_name"), F.lit("error").alias("severity"), "failures")
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return out.unionByName(mart).withColumn("status", status)


class DataTestError(RuntimeError):
    pass


def raise_on_error(report: DataFrame) -> DataFrame:
    """Fail when any error-level check has failures; warnings let it pass."""
    bad = report.filter(F.col("status") == "fail").collect()   # one row per check at most
    if bad:
        names = ", ".join(f"{r.check_name}({r.column_name})={r.failures}" for r in bad)
        raise DataTestError(f"data tests failed: {names}")
    return report
