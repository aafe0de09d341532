"""Registered round trips of the sources and sinks (S5-S9, K1-K7, K9-K13,
P7, V2): each writes a given table, reads it back and returns what it read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import merge as MG
from ..operators import staging as S
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import readers as R
from . import adhoc as A
from . import marts as M
from . import oracle as O
from . import queries_models as QM
from .catalog import Models, neutral, register

_EVENTS = "SELECT event_id, user_id, event_type FROM events"
_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _name(kind: str) -> str:
    """A table name of its own, so that runs never meet."""
    return f"tm_{kind}_{uuid.uuid4().hex[:10]}"


def _event_arrays(m: Models):
    """The events of each minute-sized group as one JSON array (text)."""
    e = m.table("events")
    group = F.pmod(F.xxhash64("event_id"), F.lit(max(1, _files(m)))).cast("int")
    item = F.struct("event_id", "user_id", "event_type")
    return e.groupBy(group.alias("page")).agg(F.to_json(F.collect_list(item)).alias("items"))


def _files(m: Models, rows: int = 2_000) -> int:
    """JSON documents to land the events in: their number follows the table,
    so no document grows with it."""
    return -(-m.table("events").count() // rows)


@register("json_records", _EVENTS)
def q_json_records(m: Models):
    """Documents that hold an array of records, one file each."""
    path = scratch_path(m.spark, "json_records")
    docs = _event_arrays(m).select("page", F.concat(F.lit('{"source":"app","records":'), "items", F.lit("}")).alias("value"))
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)     # no folder for each document
    r = R.read_json_records(m.spark, path, "records").select("record")
    return r.select(F.col("record")["event_id"].cast("bigint").alias("event_id"),
                    F.col("record")["user_id"].cast("bigint").alias("user_id"),
                    F.col("record")["event_type"].alias("event_type"))


@register("json_pages", _EVENTS)
def q_json_pages(m: Models):
    """Landed pages, each a JSON array; an empty page adds nothing."""
    path = scratch_path(m.spark, "json_pages")
    pages = _event_arrays(m).select("page", F.col("items").alias("value"))
    pages = pages.unionByName(m.spark.sql("SELECT -1 AS page, '[]' AS value"))
    pages.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return (R.read_json_pages(m.spark, path, "event_id bigint, user_id bigint, event_type string")
            .select("event_id", "user_id", "event_type"))


@register("zones_seed", O.sql("SELECT * FROM zones", "zones"))
def q_zones_seed(m: Models):
    """The zone dimension as a CSV seed with declared types."""
    path = scratch_path(m.spark, "seed")
    W.write_csv(m.zones, path)
    return R.read_seed(m.spark, path)


@register("table_schema", """SELECT column_name AS name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type, n_rows
FROM information_schema.columns, (SELECT CAST(count(*) AS BIGINT) AS n_rows FROM orders) WHERE table_name = 'orders'""")
def q_table_schema(m: Models):
    """Names and types of orders, with its row count."""
    described = m.spark.createDataFrame(R.describe_schema(m.table("orders")), "name string, type string")
    return described.withColumn("n_rows", A.count_rows(m.table("orders"), "n_rows").scalar())


@register("bulk_load", _ORDERS)
def q_bulk_load(m: Models):
    """Parquet in n files; a table loaded twice from the glob
    holds it once; then half of it replaced and the rest appended."""
    path, name = scratch_path(m.spark, "orders_files"), _name("orders")
    W.write_parquet(m.table("orders"), path, n=4)
    place = scratch_path(m.spark, "orders_table")
    for _ in range(2):
        t = W.load_overwrite(m.spark, name, f"{path}/*.parquet", path=place)
    kept, other = scratch_path(m.spark, "orders_all"), _name("orders_all")
    W.write_table(t, other, mode="overwrite", path=kept)
    W.write_table(t.filter("o_orderkey % 2 = 0"), other, mode="overwrite", path=f"{kept}_2")
    W.write_table(t.filter("o_orderkey % 2 <> 0"), other, mode="append", path=f"{kept}_2")
    return m.spark.table(other)


@register("export_partitions", """SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders""")
def q_export_partitions(m: Models):
    """K3: an export by status; exporting one status again replaces it alone."""
    path = scratch_path(m.spark, "export")
    o = m.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    W.export_data(o, path, partition_by=["o_orderstatus"])
    again = o.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    W.export_data(again, path, overwrite=True, partition_by=["o_orderstatus"])
    return m.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("materialized_models", O.sql("SELECT * FROM dim_zones", "dim_zones"))
def q_materialized_models(m: Models):
    """The dimension as a replaced table, a staging table
    loaded twice, a view, a model table and an inlined model, one on the other."""
    name = _name("zones")
    W.create_table_as(m.dim_zones.limit(0), name, path=scratch_path(m.spark, "ctas"))
    W.create_table_as(m.dim_zones, name, path=scratch_path(m.spark, "ctas"))
    for _ in range(2):
        t = W.stage(m.spark.table(name), _name("stage"), path=scratch_path(m.spark, "stage"))
    view = W.materialize(t, _name("view"), "view")
    table = W.materialize(view, _name("model"), "table", path=scratch_path(m.spark, "model"))
    return W.materialize(table, "inline", "ephemeral")


@register("materialized_trips", O.sql(
    QM._neutral_sql(QM.STG_COLS + ", service_type", "trips_unioned", QM.STG_INTS, QM.STG_DECS), "trips_unioned"))
def q_materialized_trips(m: Models):
    """K4 / K7 / K10 / K11 over the staged trips: a replaced table of all
    trips, of which the green batch is staged, then the yellow one in its
    place; each batch becomes a view and a model table, inlined in the result."""
    name, stage = _name("trips"), _name("stage")
    path, stage_path = scratch_path(m.spark, "ctas"), scratch_path(m.spark, "stage")
    trips = M.trips_unioned(m.stg_green, m.stg_yellow)
    W.create_table_as(trips.limit(0), name, path=path)
    W.create_table_as(trips, name, path=path)
    models = []
    for service in ("Green", "Yellow"):
        batch = m.spark.table(name).filter(F.col("service_type") == service)
        view = W.materialize(W.stage(batch, stage, path=stage_path), _name("view"), "view")
        models.append(W.materialize(view, _name("model"), "table", path=scratch_path(m.spark, "model")))
    return neutral(W.materialize(A.union_all(models), "inline", "ephemeral"))


@register("target_table", O.sql(f"""SELECT {O.row_hash(*MG.ROW_ID_BYTES_FIELDS)} AS unique_row_id_hex,
  'yellow_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.csv' AS filename, vendor_id AS "VendorID",
  pickup_datetime AS tpep_pickup_datetime, CAST(fare_amount AS DOUBLE) AS fare_amount FROM raw_yellow""", "raw_yellow"))
def q_target_table(m: Models):
    """K6: the yellow target table made once with its fixed columns and
    comments (a second call changes nothing), filled and read back."""
    name = _name("yellow")
    path = scratch_path(m.spark, "yellow_target")
    for _ in range(2):
        W.ensure_trips_table(m.spark, name, "yellow", path=path)
    raw = MG.with_row_id(m.raw_yellow, "bytes").withColumn("filename", MG.month_file("yellow"))
    cols = R.file_layout(raw, "yellow").columns
    back = {R.RAW_NAMES.get(c, c): c for c in cols}
    laid = raw.select("unique_row_id", "filename", F.to_date("pickup_datetime").alias("pickup_date"),
                      *[F.col(c).alias(back[c]) for c in raw.columns if c in back])
    target = m.spark.table(name)
    types = {f.name: f.dataType for f in target.schema.fields}
    rows = laid.select(*[(F.col(c).try_cast(t) if c in laid.columns else F.lit(None).cast(t)).alias(c) for c, t in types.items()])
    rows.repartition("pickup_date").write.insertInto(name)
    t = m.spark.table(name)
    return neutral(t.select(F.lower(F.hex("unique_row_id")).alias("unique_row_id_hex"), "filename", "VendorID",
                            "tpep_pickup_datetime", "fare_amount"))


@register("json_export", _EVENTS)
def q_json_export(m: Models):
    """Events as JSON lines, read back."""
    path = scratch_path(m.spark, "json_lines")
    W.write_json(m.table("events").select("event_id", "user_id", "event_type"), path)
    return m.spark.read.schema("event_id bigint, user_id bigint, event_type string").json(path)


@register("dropped_table", "SELECT true AS was_there, false AS still_there, CAST(count(*) AS BIGINT) AS n_rows FROM orders")
def q_dropped_table(m: Models):
    """A table of all orders, counted, then dropped (twice: no error)."""
    name = _name("gone")
    W.write_table(m.table("orders"), name, path=scratch_path(m.spark, "gone"))
    there, n = m.spark.catalog.tableExists(name), m.spark.table(name).count()
    W.drop_table(m.spark, name)
    W.drop_table(m.spark, name)
    return m.spark.createDataFrame([(there, m.spark.catalog.tableExists(name), n)],
                                   "was_there boolean, still_there boolean, n_rows bigint")


@register("tightened_types", "SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, l_tax FROM lineitem")
def q_tightened_types(m: Models):
    """A float column of whole numbers becomes bigint, another stays."""
    return S.tighten_types(m.table("lineitem").select("l_orderkey", "l_quantity", "l_tax"), ["l_quantity", "l_tax"])


@register("external_catalog", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def q_external_catalog(m: Models):
    """A catalog table over partition folders; one of them lands after the
    table was made, and another session of the catalog reads it too."""
    path, name = scratch_path(m.spark, "external"), _name("external")
    orders = m.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    late = F.col("o_orderstatus") == "P"
    orders.filter(~late).write.partitionBy("o_orderstatus").parquet(path)
    R.external_catalog_table(m.spark, name, path, schema=orders.schema, partition_by=["o_orderstatus"])
    orders.filter(late).write.mode("append").partitionBy("o_orderstatus").parquet(path)
    R.refresh_external(m.spark, name)
    return m.spark.table(name)


@register("metadata_counts", """SELECT CAST(count(*) AS BIGINT) AS n_rows, min(l_orderkey) AS min_l_orderkey,
  max(l_orderkey) AS max_l_orderkey, min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice
FROM lineitem""")
def q_metadata_counts(m: Models):
    """A1 from file footers: rows, least and largest of two columns of lineitem."""
    return R.metadata_summary(m.spark, f"{m.sf_dir.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_extendedprice"])


@register("models_by_kind", O.sql("""SELECT service_type, year, CAST(total AS DOUBLE) AS total, CAST(n AS BIGINT) AS trips
FROM (SELECT service_type, year, sum(total_amount) AS total, count(*) AS n FROM fact_trips GROUP BY service_type, year)""",
                                  "fact_trips"))
def q_models_by_kind(m: Models):
    """Staging models go to the staging schema, the core model
    built from them to the target schema; the result reads both."""
    tag = uuid.uuid4().hex[:8]
    schemas = {"core": f"tm_core_{tag}", "staging": f"tm_staging_{tag}"}

    def model(df, name, kind):
        return W.materialize(df, name, "table", model_kind=kind, path=scratch_path(m.spark, name), schemas=schemas)

    green, yellow = model(m.stg_green, "stg_green", "staging"), model(m.stg_yellow, "stg_yellow", "staging")
    zones = model(m.dim_zones, "dim_zones", "core")
    model(M.fact_trips(green, yellow, zones), "fact_trips", "core")
    fact = m.spark.table(f"{schemas['core']}.fact_trips")
    return neutral(fact.groupBy("service_type", "year").agg(F.sum("total_amount").alias("total"), F.count(F.lit(1)).alias("trips")))
