"""DuckDB twins of the registered queries (the correctness oracle).

Shared building blocks are named CTEs; ``sql(final, *ctes)`` prepends the
CTEs a query needs (with their dependencies, in order). The CTEs mirror the
fixture views and the staging/fact models written in ``tripmart``.

Oracle hygiene (FIXTURES.md B5): DuckDB ``try_cast('2.0' as int)`` is 2
where Spark gives NULL, so integer casts of text are guarded by a digits
pattern; NULLs sort first on both sides; money is decimal(18,2); outputs are
cast to BIGINT / DOUBLE / VARCHAR / TIMESTAMP.
"""

from __future__ import annotations

from ..functions.exprs import SURROGATE_NULL_MARKER as NULL_MARKER


def int_text(x: str, t: str = "BIGINT") -> str:
    """Spark-compatible safe cast of text to an integer type."""
    return f"(CASE WHEN regexp_full_match(CAST({x} AS VARCHAR), '[+-]?[0-9]+') THEN TRY_CAST({x} AS {t}) END)"


def payment_label(x: str) -> str:
    code = f"TRY_CAST(round(TRY_CAST({x} AS DOUBLE)) AS BIGINT)"
    return (f"(CASE {code} WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' "
            f"WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'EMPTY' END)")


def surrogate(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_MARKER}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def _plain(c: str) -> str:
    """Text of a field; amounts without trailing zeros."""
    text = f"CAST({c} AS VARCHAR)"
    if c in ("fare_amount", "trip_distance"):
        text = f"rtrim(rtrim({text}, '0'), '.')"
    return text


def row_hash(*cols: str) -> str:
    parts = ", ".join(f"coalesce({_plain(c)}, '')" for c in cols)
    return f"md5(concat({parts}))"


GREEN_RAW_COLS = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
                  "dropoff_location_id", "payment_type", "rate_code", "trip_type", "passenger_count",
                  "store_and_fwd_flag", "trip_distance", "fare_amount", "extra", "mta_tax",
                  "tip_amount", "tolls_amount", "ehail_fee", "imp_surcharge", "total_amount"]
YELLOW_RAW_COLS = [c for c in GREEN_RAW_COLS if c not in ("trip_type", "ehail_fee")]


def _dedup_order(cols):
    rest = [c for c in cols if c not in ("vendor_id", "pickup_datetime")]
    return ", ".join(f"{c} ASC NULLS FIRST" for c in rest)


def _stg(service: str) -> str:
    cols = GREEN_RAW_COLS if service == "green" else YELLOW_RAW_COLS
    if service == "green":
        trip_type = int_text("trip_type")
        ehail = "CAST(ehail_fee AS DECIMAL(18,2))"
        pay = "TRY_CAST(round(coalesce(TRY_CAST(payment_type AS DOUBLE), 0.0)) AS BIGINT)"
    else:
        trip_type = "1"
        ehail = "CAST(0 AS DECIMAL(18,2))"
        pay = f"coalesce({int_text('payment_type')}, 0)"
    return f"""
    SELECT
      {surrogate('vendor_id', 'pickup_datetime')} AS tripid,
      {int_text('vendor_id')} AS vendorid,
      {int_text('rate_code')} AS ratecodeid,
      TRY_CAST(pickup_location_id AS BIGINT) AS pickup_locationid,
      TRY_CAST(dropoff_location_id AS BIGINT) AS dropoff_locationid,
      CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime,
      CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
      store_and_fwd_flag,
      {int_text('passenger_count')} AS passenger_count,
      CAST(trip_distance AS DECIMAL(18,2)) AS trip_distance,
      {trip_type} AS trip_type,
      CAST(fare_amount AS DECIMAL(18,2)) AS fare_amount,
      CAST(extra AS DECIMAL(18,2)) AS extra,
      CAST(mta_tax AS DECIMAL(18,2)) AS mta_tax,
      CAST(tip_amount AS DECIMAL(18,2)) AS tip_amount,
      CAST(tolls_amount AS DECIMAL(18,2)) AS tolls_amount,
      {ehail} AS ehail_fee,
      CAST(imp_surcharge AS DECIMAL(18,2)) AS improvement_surcharge,
      CAST(total_amount AS DECIMAL(18,2)) AS total_amount,
      {pay} AS payment_type,
      {payment_label('payment_type')} AS payment_type_description
    FROM (
      SELECT {', '.join(cols)},
             row_number() OVER (PARTITION BY vendor_id, pickup_datetime ORDER BY {_dedup_order(cols)}) AS rn
      FROM raw_{service}
      WHERE vendor_id IS NOT NULL
    ) WHERE rn = 1"""


_MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
          "improvement_surcharge", "total_amount"]


def _revenue(period: str) -> str:
    sums = ",\n      ".join(f"CAST(sum({c}) AS DOUBLE) AS revenue_{period}_{'fare' if c == 'fare_amount' else c}" for c in _MONEY)
    return f"""{sums},
      CAST(count(tripid) AS BIGINT) AS total_{period}_trips,
      round(avg(passenger_count), 4) AS avg_{period}_passenger_count,
      round(CAST(avg(trip_distance) AS DOUBLE), 4) AS avg_{period}_trip_distance"""


CTES: dict[str, tuple[str, list[str]]] = {
    "trips_base": ("""
    SELECT
      CASE l.l_linestatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'yellow' END AS service,
      CASE WHEN l.l_suppkey % 50 = 0 THEN NULL ELSE CAST(l.l_suppkey AS VARCHAR) END AS vendor_id,
      l.l_shipdate + to_seconds((l.l_suppkey * 997) % 86400) AS pickup_datetime,
      CAST(l.l_quantity * 60 + l.l_partkey % 60 AS BIGINT) AS ride_secs,
      CAST(c.c_nationkey AS BIGINT) AS pickup_location_id,
      CAST(s.s_nationkey AS BIGINT) AS dropoff_location_id,
      CASE l.l_partkey % 20 WHEN 0 THEN NULL WHEN 1 THEN 'x' WHEN 2 THEN '2.0' WHEN 3 THEN '6'
           ELSE substr(o.o_orderpriority, 1, 1) END AS payment_type,
      CAST(l.l_linenumber % 6 + 1 AS VARCHAR) AS rate_code,
      CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_linenumber % 2 + 1 AS VARCHAR) END AS trip_type,
      CAST(l.l_linenumber AS VARCHAR) AS passenger_count,
      l.l_returnflag AS store_and_fwd_flag,
      CAST(l.l_quantity AS DECIMAL(18,2)) AS trip_distance,
      CASE WHEN l.l_partkey % 25 = 0 THEN CAST(0 AS DECIMAL(18,2))
           ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS fare_amount,
      CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS tip_amount,
      CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS mta_tax,
      CAST(0.50 AS DECIMAL(18,2)) AS extra,
      CAST(0.30 AS DECIMAL(18,2)) AS imp_surcharge,
      CAST(0 AS DECIMAL(18,2)) AS tolls_amount,
      CASE WHEN l.l_linestatus = 'F' THEN CAST(NULL AS DECIMAL(18,2)) END AS ehail_fee
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey""", []),
    "trips_raw": ("""
    SELECT service, vendor_id, pickup_datetime,
      pickup_datetime + to_seconds(ride_secs) AS dropoff_datetime,
      pickup_location_id, dropoff_location_id, payment_type, rate_code, trip_type, passenger_count,
      store_and_fwd_flag, trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
      ehail_fee, imp_surcharge,
      CAST(fare_amount + tip_amount + mta_tax + CAST(0.80 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS total_amount
    FROM trips_base""", ["trips_base"]),
    "raw_green": (f"SELECT {', '.join(GREEN_RAW_COLS)} FROM trips_raw WHERE service = 'green'", ["trips_raw"]),
    "raw_yellow": (f"SELECT {', '.join(YELLOW_RAW_COLS)} FROM trips_raw WHERE service = 'yellow'", ["trips_raw"]),
    "fhv_raw": ("""
    SELECT c.c_mktsegment AS dispatching_base_num,
      o.o_orderdate AS pickup_datetime,
      o.o_orderdate + to_seconds((o.o_orderkey * 7919) % 7200) AS dropOff_datetime,
      CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE CAST(c.c_nationkey % 7 AS VARCHAR) END AS PUlocationID,
      CAST(o.o_orderkey % 7 AS VARCHAR) AS DOlocationID,
      CAST(NULL AS VARCHAR) AS SR_Flag
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""", []),
    "zones": ("""
    SELECT CAST(n.n_nationkey AS BIGINT) AS locationid,
      CASE WHEN r.r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r.r_name END AS borough,
      CASE WHEN n.n_nationkey = 6 THEN 'NATION_5' ELSE n.n_name END AS zone,
      CASE n.n_nationkey % 3 WHEN 0 THEN 'Boro Zone' WHEN 1 THEN 'Yellow Zone' ELSE 'Airports' END AS service_zone
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""", []),
    "dim_zones": ("SELECT locationid, borough, zone, replace(service_zone, 'Boro', 'Green') AS service_zone FROM zones",
                  ["zones"]),
    "known_zones": ("SELECT * FROM dim_zones WHERE borough <> 'Unknown'", ["dim_zones"]),
    "stg_green": (_stg("green"), ["raw_green"]),
    "stg_yellow": (_stg("yellow"), ["raw_yellow"]),
    "stg_fhv": (f"""
    SELECT dispatching_base_num,
      {int_text('PUlocationID')} AS pickup_locationid,
      {int_text('DOlocationID')} AS dropoff_locationid,
      CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime,
      CAST(dropOff_datetime AS TIMESTAMP) AS dropoff_datetime,
      SR_Flag AS sr_flag
    FROM fhv_raw""", ["fhv_raw"]),
    "trips_unioned": ("""
    SELECT *, 'Green' AS service_type FROM stg_green
    UNION ALL BY NAME
    SELECT *, 'Yellow' AS service_type FROM stg_yellow""", ["stg_green", "stg_yellow"]),
    "fact_trips": ("""
    SELECT t.tripid, t.vendorid, t.service_type, t.ratecodeid,
      t.pickup_locationid, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
      t.dropoff_locationid, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
      t.pickup_datetime, t.dropoff_datetime, t.store_and_fwd_flag, t.passenger_count,
      t.trip_distance, t.trip_type, t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount,
      t.ehail_fee, t.improvement_surcharge, t.total_amount, t.payment_type, t.payment_type_description,
      year(t.pickup_datetime) AS year, quarter(t.pickup_datetime) AS quarter,
      concat(CAST(year(t.pickup_datetime) AS VARCHAR), '_Q', CAST(quarter(t.pickup_datetime) AS VARCHAR)) AS year_quarter,
      month(t.pickup_datetime) AS month
    FROM trips_unioned t
    JOIN known_zones pz ON t.pickup_locationid = pz.locationid
    JOIN known_zones dz ON t.dropoff_locationid = dz.locationid""", ["trips_unioned", "known_zones"]),
    "fact_fhv_trips": ("""
    SELECT year(f.pickup_datetime) AS year, month(f.pickup_datetime) AS month,
      f.dispatching_base_num, f.pickup_locationid, f.dropoff_locationid, f.pickup_datetime,
      f.dropoff_datetime, f.sr_flag, 'fhv' AS service_type,
      pz.borough AS pickup_borough, pz.zone AS pickup_zone, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone
    FROM stg_fhv f
    JOIN known_zones pz ON f.pickup_locationid = pz.locationid
    JOIN known_zones dz ON f.dropoff_locationid = dz.locationid""", ["stg_fhv", "known_zones"]),
    # percentile by id group first, then the zone names, then one row per distinct line
    "fhv_p90": ("""
    SELECT DISTINCT g.year, g.month, pick.zone AS pickup_zone, goal.zone AS dropoff_zone, g.p90_duration
    FROM (
      SELECT year, month, pickup_locationid, dropoff_locationid,
        quantile_cont(CAST(date_sub('second', pickup_datetime, dropoff_datetime) AS DOUBLE), 0.9) AS p90_duration
      FROM fact_fhv_trips
      GROUP BY year, month, pickup_locationid, dropoff_locationid
    ) g, dim_zones pick, dim_zones goal
    WHERE pick.locationid = g.pickup_locationid AND goal.locationid = g.dropoff_locationid""",
                ["fact_fhv_trips", "dim_zones"]),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def sql(final: str, *ctes: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the needed CTEs (and ``extra`` ones after them), then ``final``."""
    parts = [f"{n} AS ({CTES[n][0]}\n)" for n in _closure(ctes)]
    for n, body in (extra or {}).items():
        parts.append(f"{n} AS ({body}\n)")
    head = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return head + final


def revenue(period: str) -> str:
    return _revenue(period)
