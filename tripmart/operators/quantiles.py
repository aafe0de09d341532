"""Exact interpolated percentiles, by group or over whole columns.

``percentile`` merges a group's distinct values into one buffer in one
task. Here values are selected by buckets, in two scans:

1. each value belongs to a fixed bucket: ``PER_OCTAVE`` equal steps between
   one power of two and the next, so buckets need no look at the data. The
   first scan counts buckets: per task one row for each (group, bucket)
   leaves the scan, whatever the rows. Running sums give each bucket's start
   rank, and the buckets that hold a wanted rank (at most two per
   probability and group) are written to the shared folder;
2. the second scan drops every value outside those buckets (Spark broadcasts
   them while they are small) and counts the values inside. Only these few
   distinct values shuffle and are ordered, a bucket at a time, to find the
   exact ones;
3. interpolation as ``percentile_cont``: v[floor(h)] + (h - floor(h)) *
   (v[ceil(h)] - v[floor(h)]) with h = p * (n - 1).

The first scan runs while the plan is built. ``stage=True`` first writes the
keys and the value to the shared folder, for inputs that are costly to derive
twice.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.writers import persist_table

PER_OCTAVE = 1024


def value_bucket(x: Column, per_octave: int = PER_OCTAVE) -> Column:
    """A whole number that never falls as x (a finite double) grows."""
    size = F.abs(x)
    # the smallest doubles share bucket 0 with zero; infinities have their own
    power = F.floor(F.log2(F.when((size > 1e-300) & (size < 1e300), size).otherwise(F.lit(1.0))))
    step = F.floor((size / F.pow(F.lit(2.0), power) - 1) * per_octave)
    bucket = F.when(size <= 1e-300, F.lit(0)).when(size >= 1e300, F.lit(2100 * per_octave)).otherwise(
        (power + 1050) * per_octave + step).cast("bigint")
    return F.when(x < 0, -bucket).otherwise(bucket)


def value_filter(x: Column) -> Column:
    """The values a percentile counts: non-null and not NaN."""
    return x.isNotNull() & ~F.isnan(x)


def wanted_buckets(x: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, _bucket, _start, _n, _ranks): buckets of ``x`` that hold wanted
    ranks, with their start rank, the group's size and those ranks."""
    sizes = x.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_bn"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = (sizes.withColumn("_start", F.sum("_bn").over(before) - F.col("_bn"))
             .withColumn("_n", F.sum("_bn").over(group)))
    height = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(h).cast("bigint") for h in height for f in (F.floor, F.ceil)]))
    mine = F.filter(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_bn")))
    return sizes.select(*keys, "_bucket", "_start", "_n", mine.alias("_ranks")).filter(F.size("_ranks") > 0)


def grouped_percentiles(df: DataFrame, keys: Sequence[str], value: Column, probs: Mapping[str, float],
                        stage: bool = False) -> DataFrame:
    """One row per group that has a value: ``keys`` and a double column for
    each named probability."""
    keys, spark = list(keys), df.sparkSession
    x = df.select(*keys, value.cast("double").alias("_x")).filter(value_filter(F.col("_x")))
    if stage:
        x = persist_table(x, scratch_path(spark, "rank_values"))
    x = x.withColumn("_bucket", value_bucket(F.col("_x")))
    needed = persist_table(wanted_buckets(x, keys, list(probs.values())), scratch_path(spark, "rank_buckets"))
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    needed = needed.select(*[F.col(k).alias(n) for k, n in names.items()], F.col("_bucket").alias("_kb"),
                           "_start", "_n", "_ranks")

    def inside(left: DataFrame, kind: str) -> DataFrame:
        same = F.col("_bucket") == F.col("_kb")
        for k, n in names.items():
            same = same & F.col(k).eqNullSafe(F.col(n))
        return left.join(needed, same, kind)

    counts = inside(x, "left_semi").groupBy(*keys, "_bucket", "_x").agg(F.count(F.lit(1)).alias("_c"))
    bucket = Window.partitionBy(*keys, "_bucket").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside(counts.withColumn("_upto", F.sum("_c").over(bucket)), "inner")
    end = F.col("_start") + F.col("_upto")
    mine = F.filter("_ranks", lambda r: (r >= end - F.col("_c")) & (r < end))
    hits = ranked.select(*keys, "_x", "_n", F.explode(mine).alias("_r"))
    out = []
    for name, p in probs.items():
        h = F.lit(float(p)) * (F.col("_n") - 1)
        low = F.max(F.when(F.col("_r") == F.floor(h), F.col("_x")))
        high = F.max(F.when(F.col("_r") == F.ceil(h), F.col("_x")))
        part = F.max(h - F.floor(h))
        out.append((low + part * (high - low)).alias(name))
    return hits.groupBy(*keys).agg(*out)


def exact_percentiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """One row, one double column ``p<i>`` per probability (NULL when empty)."""
    names = [f"p{i}" for i in range(len(probs))]
    one = df.select(F.lit(0).alias("_all"), F.col(f"`{col}`").alias("_v"))
    got = grouped_percentiles(one, ["_all"], F.col("_v"), dict(zip(names, probs)))
    return got.agg(*[F.max(n).alias(n) for n in names])
