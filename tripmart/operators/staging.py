"""Staging operators: casts, column selection, de-duplication
and the staging models (M1-M4).

De-duplication keeps one row per key without a window: a group-by with
``min(struct(...))`` picks the smallest row under a total order. That is an
aggregate, so Spark combines on the map side before the shuffle and a key
holding a third of all rows costs one row per map task, not one giant
window partition in a single task.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import exprs as X


# --- P1, P6, P7 ------------------------------------------------------------

def cast_to_schema(df: DataFrame, schema: T.StructType, safe: bool = False) -> DataFrame:
    """Cast the schema's columns in one projection; other columns stay."""
    targets = {f.name: f.dataType for f in schema.fields}
    missing = [n for n in targets if n not in df.columns]
    if missing:
        raise ValueError(f"columns not in frame: {missing}")
    cols = []
    for name in df.columns:
        if name in targets:
            c = F.col(name).try_cast(targets[name]) if safe else F.col(name).cast(targets[name])
            cols.append(c.alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def keep_columns(df: DataFrame, source: str, keys: Sequence[str], default: str = "N/A",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Project a runtime list of keys out of a JSON text (or map) column.

    A key that is absent gets ``default``; an explicit null stays NULL.
    """
    src_type = df.schema[source].dataType
    # parse once per row into a map, then look every key up in it
    m = F.col(source) if isinstance(src_type, T.MapType) else F.from_json(F.col(source), "map<string,string>")
    parsed = df.select(*[F.col(c) for c in keep], m.alias("_kv"))
    vals = [F.when(F.map_contains_key(F.col("_kv"), F.lit(k)), F.col("_kv")[k].cast("string"))
            .otherwise(F.lit(default)).alias(k) for k in keys]
    return parsed.select(*[F.col(c) for c in keep], *vals)


def tighten_types(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Float columns whose values are all integral become bigint.

    The decision needs one small aggregate (one boolean per column).
    """
    if not cols:
        return df
    checks = df.agg(*[
        F.coalesce(F.min(F.when(F.col(c).isNull(), True).otherwise(F.col(c) == F.floor(F.col(c)))),
                   F.lit(True)).alias(c)
        for c in cols]).first()
    integral = {c for c in cols if checks[c]}
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in integral else F.col(c)
                       for c in df.columns])


# --- W1 ----------------------------------------------------------------------

def dedupe(df: DataFrame, keys: Sequence[str], order: Iterable[str] = ()) -> DataFrame:
    """Keep one row per ``keys``.

    The kept row is the smallest under (``order`` columns, then every other
    column in frame order), ascending with NULLs first: a total order, so the
    result repeats run to run (T2).
    """
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    if not fields:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c) for c in fields])
    kept = df.groupBy(*keys).agg(F.min(packed).alias("_kept"))
    return kept.select(*[F.col(k) for k in keys],
                       *[F.col("_kept").getField(c).alias(c) for c in fields]).select(*df.columns)


def sample_run(df: DataFrame, enabled: bool, order: Sequence[str], n: int = config.TEST_RUN_LIMIT) -> DataFrame:
    """L4: the development cap. Off by default (T3); when on, ordered first."""
    if not enabled:
        return df
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


# --- M1-M4 ---------------------------------------------------------------------

DEDUPE_KEYS = ["vendor_id", "pickup_datetime"]


def _stg_taxi(raw: DataFrame, service: str, money_type: str, test_run: bool) -> DataFrame:
    t = raw.filter(F.col("vendor_id").isNotNull())
    t = dedupe(t, DEDUPE_KEYS)
    money = lambda c: X.to_numeric(c, money_type)
    if service == "green":
        trip_type = X.safe_cast("trip_type", "bigint")
        ehail = money("ehail_fee")
        # text -> float64 -> integer, halves away from zero
        pay = F.round(F.coalesce(X.safe_cast("payment_type", "double"), F.lit(0.0))).try_cast("bigint")
    else:
        trip_type = F.lit(1).cast("bigint")
        ehail = money(F.lit(0))
        # text -> integer directly: '2.0' is NULL, then 0
        pay = F.coalesce(X.safe_cast("payment_type", "bigint"), F.lit(0).cast("bigint"))
    out = t.select(
        X.surrogate_key("vendor_id", "pickup_datetime").alias("tripid"),
        X.safe_cast("vendor_id", "bigint").alias("vendorid"),
        X.safe_cast("rate_code", "bigint").alias("ratecodeid"),
        X.safe_cast("pickup_location_id", "bigint").alias("pickup_locationid"),
        X.safe_cast("dropoff_location_id", "bigint").alias("dropoff_locationid"),
        X.to_ts("pickup_datetime").alias("pickup_datetime"),
        X.to_ts("dropoff_datetime").alias("dropoff_datetime"),
        F.col("store_and_fwd_flag"),
        X.safe_cast("passenger_count", "bigint").alias("passenger_count"),
        money("trip_distance").alias("trip_distance"),
        trip_type.alias("trip_type"),
        money("fare_amount").alias("fare_amount"),
        money("extra").alias("extra"),
        money("mta_tax").alias("mta_tax"),
        money("tip_amount").alias("tip_amount"),
        money("tolls_amount").alias("tolls_amount"),
        ehail.alias("ehail_fee"),
        money("imp_surcharge").alias("improvement_surcharge"),
        money("total_amount").alias("total_amount"),
        pay.alias("payment_type"),
        # the label reads the raw text code (T4: the argument is honoured)
        X.payment_type_description("payment_type").alias("payment_type_description"),
    )
    return sample_run(out, test_run, ["tripid"])


def stg_green(raw_green: DataFrame, money_type: str = X.NUMERIC, test_run: bool = False) -> DataFrame:
    """M1: typed, de-duplicated green trips."""
    return _stg_taxi(raw_green, "green", money_type, test_run)


def stg_yellow(raw_yellow: DataFrame, money_type: str = X.NUMERIC, test_run: bool = False) -> DataFrame:
    """M2: typed, de-duplicated yellow trips (trip_type 1, ehail_fee 0)."""
    return _stg_taxi(raw_yellow, "yellow", money_type, test_run)


def stg_fhv(raw_fhv: DataFrame, test_run: bool = False) -> DataFrame:
    """M3: typed FHV trips; no null filter and no de-duplication."""
    out = raw_fhv.select(
        F.col("dispatching_base_num"),
        X.safe_cast("PUlocationID", "bigint").alias("pickup_locationid"),
        X.safe_cast("DOlocationID", "bigint").alias("dropoff_locationid"),
        X.to_ts("pickup_datetime").alias("pickup_datetime"),
        X.to_ts("dropOff_datetime").alias("dropoff_datetime"),
        F.col("SR_Flag").alias("sr_flag"),
    )
    return sample_run(out, test_run, ["pickup_datetime", "dropoff_datetime",
                                      "pickup_locationid", "dropoff_locationid", "dispatching_base_num"])


def dim_zones(seed: DataFrame) -> DataFrame:
    """M4: zone dimension; 'Boro' service zones are renamed 'Green'."""
    return seed.select("locationid", "borough", "zone",
                       X.replace_text("service_zone", "Boro", "Green").alias("service_zone"))
