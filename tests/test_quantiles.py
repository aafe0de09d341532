"""Distributed exact percentiles against numpy's linear interpolation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.operators import quantiles as QT
from tripmart.operators.quantiles import exact_percentiles
from tripmart.plans.inspect import plan_string

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.97, 1.0]


@pytest.mark.parametrize("per_octave", [1, 16, 1024])
def test_matches_numpy_with_skew(spark, per_octave, monkeypatch):
    monkeypatch.setattr(QT.value_bucket, "__defaults__", (per_octave,))
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000).round(3), np.full(2000, 0.5)])   # a hot value: 40%
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "v double")
    got = exact_percentiles(df, "v", PROBS).first()
    want = np.quantile(vals, PROBS)
    for i, w in enumerate(want):
        assert abs(got[f"p{i}"] - w) < 1e-9


def test_single_value_and_empty(spark):
    one = spark.createDataFrame([(3.0,)], "v double")
    assert exact_percentiles(one, "v", [0.5, 0.9]).first() == (3.0, 3.0)
    empty = one.filter(F.col("v") > 10)
    assert exact_percentiles(empty, "v", [0.5]).first()[0] is None


def test_same_as_spark_percentile(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    ours = exact_percentiles(li, "l_extendedprice", [0.25, 0.5, 0.75]).first()
    ref = li.agg(F.percentile("l_extendedprice", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    assert all(abs(a - b) < 1e-6 for a, b in zip(ours, ref))


def test_buckets_follow_the_order_of_values(spark):
    vals = sorted({0.0, -0.0, 1e-310, 5e-324, 1.0, 2.0, 1.9999999999999998, 4.000000000000001, 1e308, -3.5, 7.0,
                   0.1, 0.30000000000000004, 1024.0, 1023.9999999999999, float("inf"), float("-inf")}
                  | {2.0 ** k * (1 + e) for k in range(-40, 40) for e in (-2e-16, 0.0, 2e-16, 0.33)})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r.b for r in df.select("i", QT.value_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


def test_groups_with_a_third_of_all_rows_in_one(spark):
    rng = np.random.default_rng(3)
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", float(x)) for i, x in enumerate(rng.gamma(2, 50, 6000).round(2))]
    rows += [(None, 5.0), (None, 7.0), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = QT.grouped_percentiles(df, ["g"], F.col("v"), {"p50": 0.5, "p95": 0.95})
    got = {r.g: (r.p50, r.p95) for r in out.collect()}
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert set(got) == set(by)
    for g, v in by.items():
        assert np.allclose(got[g], np.quantile(v, [0.5, 0.95]), atol=1e-9)
    # no group buffer: only sums and counts are aggregated
    assert "percentile" not in plan_string(out) and "ObjectHashAggregate" not in plan_string(out)


def test_only_wanted_values_shuffle(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.37).alias("v"))
    seen = []
    for stage in (False, True):
        out = QT.grouped_percentiles(df, ["g"], F.col("v"), {"p50": 0.5, "p95": 0.95}, stage=stage)
        tree = plan_string(out).split("\n\n(1)")[0]
        # values meet the wanted buckets before any exchange, and those are broadcast by their size
        assert tree.count("BroadcastHashJoin") == 2 and tree.count("LeftSemi") == 1
        assert " Exchange (" not in tree[tree.index("LeftSemi"):]
        seen.append(sorted(map(tuple, out.collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 3
