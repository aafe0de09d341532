"""Sources and sinks round trips."""

import json

import pytest
import datetime as dt
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import __spark_entry__ as E
from tripmart.plans.inspect import plan_string
from tripmart.sinks import writers as W
from tripmart.sources import readers as R


def test_trip_csv_declared_schema(spark, tmp_path):
    p = tmp_path / "yellow_tripdata_2019-01.csv"
    header = ",".join(n for n, _ in R.YELLOW_CSV_COLUMNS)
    good = "1,2019-01-01 00:10:00,2019-01-01 00:20:00,1,2.5,1,N,10,20,1,9.123456789,0.5,0.5,1,0,0.3,11.8,0"
    extra = good + ",EXTRA"
    short = "1,2019-01-01 00:10:00,2019-01-01 00:20:00,1"
    bad = "2,not-a-time,2019-01-01 00:20:00,x,2.5,1,N,10,20,1,9.5,0.5,0.5,1,0,0.3,11.8,0"
    p.write_text("\n".join([header, good, extra, short]) + "\n")
    df = R.read_trips_csv(spark, str(p), "yellow", filename=True)
    rows = sorted(df.collect(), key=lambda r: r.fare_amount is None)       # rows are spread: any order
    assert len(rows) == 3 and df.columns == [n for n, _ in R.YELLOW_CSV_COLUMNS] + ["filename"]
    assert float(rows[0].trip_distance) == 2.5 and rows[1].VendorID == "1"
    assert str(rows[0].fare_amount) == str(rows[1].fare_amount) == "9.123456789" and rows[0].filename == p.name
    assert rows[2].passenger_count == 1 and rows[2].fare_amount is None
    p.write_text("\n".join([header, good, bad]) + "\n")
    with pytest.raises(Exception, match="bad value in column"):
        R.read_trips_csv(spark, str(p), "yellow").collect()
    told = R.read_trips_csv(spark, str(p), "yellow", on_bad="report").collect()
    assert sorted(r.bad_columns for r in told) == [[], ["tpep_pickup_datetime", "passenger_count"]]


def test_fhv_files_and_raw_names(spark, tmp_path):
    p = tmp_path / "fhv_tripdata_2019-01.csv"
    p.write_text(",".join(n for n, _ in R.FHV_CSV_COLUMNS) + "\nB001,2019-01-01 00:30:00,2019-01-01 02:51:55,,265,,B001\n")
    row = R.read_trips_csv(spark, str(p), "fhv").first()
    assert row.PUlocationID is None and row.DOlocationID == "265" and row.dispatching_base_num == "B001"
    dst = str(tmp_path / "pq")
    W.csv_to_parquet(spark, str(p), dst, "fhv")
    W.csv_to_parquet(spark, str(p), dst, "fhv")          # skipped when there
    assert spark.read.parquet(dst).count() == 1
    for service in ("yellow", "green"):
        names = R.raw_names(spark.createDataFrame([], R.ddl(R.CSV_COLUMNS[service]))).columns
        assert {"vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "imp_surcharge", "rate_code"} <= set(names)
        assert not [n for n in names if n.startswith(("tpep", "lpep"))]


def test_replacing_a_partitioned_table_leaves_only_the_new_dates(spark, tmp_path):
    import datetime as dt
    path = str(tmp_path / "t")
    two = spark.createDataFrame([(dt.datetime(2024, 1, d), d) for d in (1, 2)], "ts timestamp_ntz, v int")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    W.write_partitioned(two, path, "ts")
    W.write_partitioned(two.filter("v = 2"), path, "ts")
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_trips_target_table(spark, tmp_path):
    name = "tm_target_test"
    W.drop_table(spark, name)
    schema = W.trips_table_schema("green")
    assert schema.fieldNames()[:3] == ["unique_row_id", "filename", "VendorID"]
    schema["VendorID"].metadata = {"comment": "the vendor's code \\ it's quoted"}
    W.ensure_table(spark, name, schema, partition_by=["pickup_date"], path=str(tmp_path / "tt"))
    got = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert got["VendorID"] == "the vendor's code \\ it's quoted"
    W.drop_table(spark, name)


def test_model_schemas(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("TRIPMART_TARGET_SCHEMA", "tm_core_test")
    monkeypatch.setenv("TRIPMART_STAGING_SCHEMA", "tm_stage_test")
    df = spark.createDataFrame([(1,)], "a int")
    for kind, schema in (("core", "tm_core_test"), ("staging", "tm_stage_test")):
        W.materialize(df, "m", "table", model_kind=kind, path=str(tmp_path / kind))
        assert spark.table(f"{schema}.m").count() == 1
        W.drop_table(spark, f"{schema}.m")
        spark.sql(f"DROP DATABASE {schema}")


def test_gzip_csv(spark, tmp_path):
    import gzip
    p = tmp_path / "green.csv.gz"
    header = ",".join(n for n, _ in R.GREEN_CSV_COLUMNS)
    line = ",".join(["2", "2019-10-01 00:00:00", "2019-10-01 00:05:00", "N", "1", "7", "8", "1", "1.2"]
                    + ["1.0"] * 8 + ["1", "1", "0"])
    with gzip.open(p, "wt") as f:
        f.write(header + "\n" + line + "\n")
    df = R.read_trips_csv(spark, str(p), "green", repartition=2)
    assert df.count() == 1 and df.first().payment_type == 1


def test_json_records_and_pages(spark, tmp_path):
    doc = {"products": [{"brand": "A", "price": 10}, {"price": 5}, {"brand": "B", "price": 2.5}]}
    (tmp_path / "p.json").write_text(json.dumps(doc))
    recs = R.read_json_records(spark, str(tmp_path / "p.json"), "products")
    assert recs.count() == 3
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "1.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    (pages / "2.json").write_text("[]")
    df = R.read_json_pages(spark, str(pages), "a int")
    assert sorted(r.a for r in df.collect()) == [1, 2]


def test_seed_and_external_table(spark, tmp_path):
    seed = tmp_path / "zones.csv"
    seed.write_text("locationid,borough,zone,service_zone\n1,EWR,Newark Airport,EWR\n2,Queens,Jamaica Bay,Boro Zone\n")
    z = R.read_seed(spark, str(seed))
    assert z.schema["locationid"].dataType.simpleString() == "bigint" and z.count() == 2
    W.write_parquet(z, str(tmp_path / "ext" / "part1"), 1)
    ext = R.external_table(spark, "zones_ext", str(tmp_path / "ext" / "*"))
    assert spark.sql("SELECT count(*) AS n FROM zones_ext").first().n == 2 and ext.count() == 2
    assert R.describe_schema(z)[0] == ("locationid", "bigint")


def test_write_partitioned_prunes(spark, tmp_path, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    path = str(tmp_path / "ev")
    col = W.write_partitioned(ev, path, "ts", cluster_by=["user_id"])
    q = spark.read.parquet(path).filter(F.col(col) == F.lit("2024-01-05").cast("date"))
    plan = plan_string(q)
    assert "PartitionFilters: [isnotnull(ts_date" in plan
    assert q.count() == ev.filter(F.to_date("ts") == F.lit("2024-01-05").cast("date")).count()


def test_export_overwrite_semantics(spark, tmp_path):
    df = spark.createDataFrame([(2019, 1), (2020, 2)], "year int, v int")
    path = str(tmp_path / "x")
    W.export_data(df, path, partition_by=["year"])
    with pytest.raises(AnalysisException):
        W.export_data(df, path)
    W.export_data(spark.createDataFrame([(2020, 9)], "year int, v int"), path, overwrite=True,
                  partition_by=["year"])
    got = sorted((r.year, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(2019, 1), (2020, 9)]          # 2019 left in place


def test_tables_and_views(spark, tmp_path):
    from pyspark.sql import types as T
    name = "tm_ensure_test"
    W.drop_table(spark, name)
    schema = T.StructType([T.StructField("id", T.LongType(), metadata={"comment": "row id"}),
                           T.StructField("d", T.DateType())])
    W.ensure_table(spark, name, schema, path=str(tmp_path / "tbl"))
    W.ensure_table(spark, name, schema, path=str(tmp_path / "tbl"))       # no error the second time
    W.write_table(spark.createDataFrame([(1, None)], schema), name, "append")
    assert spark.table(name).count() == 1
    v = W.materialize(spark.createDataFrame([(1,)], "a int"), "tm_view", "view")
    assert spark.sql("SELECT * FROM tm_view").count() == 1 and v.count() == 1
    W.write_json(spark.table(name), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    W.drop_table(spark, name)


def test_models_of_staged_batches(spark, sf_small, monkeypatch):
    staged = []
    stage = W.stage

    def counted(df, name, path=None):
        t = stage(df, name, path)
        staged.append((name, {r.service_type: r["count"] for r in t.groupBy("service_type").count().collect()}))
        return t

    monkeypatch.setattr(W, "stage", counted)
    n = {r.service_type: r["count"] for r in
         E.queries()["materialized_trips"](spark, sf_small).groupBy("service_type").count().collect()}
    # one stage table; the second batch replaced the first
    assert len({name for name, _ in staged}) == 1
    assert [rows for _, rows in staged] == [{"Green": n["Green"]}, {"Yellow": n["Yellow"]}]


def test_load_overwrite_and_persist(spark, tmp_path):
    src = tmp_path / "src"
    W.write_parquet(spark.createDataFrame([(1,), (2,)], "a int"), str(src / "p1"), 1)
    name = "tm_load_overwrite"
    W.drop_table(spark, name)
    assert W.load_overwrite(spark, name, str(src / "*")).count() == 2
    assert W.load_overwrite(spark, name, str(src / "*")).count() == 2     # replaced, not appended
    W.drop_table(spark, name)
    p = W.persist_table(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "persisted"))
    assert "Scan parquet" in p._jdf.queryExecution().executedPlan().toString() or p.count() == 1


def test_scratch_root_reads_session_setting(spark):
    from tripmart.session import scratch_path, scratch_root
    root = scratch_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_spread_only_when_too_few_splits(spark):
    one = spark.range(1000).coalesce(1)
    spread_out = R.spread(one, ["id"], min_partitions=4)
    assert spread_out.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in spread_out.collect()) == list(range(1000))
    many = spark.range(1000).repartition(6)
    assert R.spread(many, ["id"], min_partitions=4) is many          # left alone: no extra shuffle


def test_gzip_csv_is_spread(spark, tmp_path):
    import gzip
    p = tmp_path / "yellow.csv.gz"
    header = ",".join(n for n, _ in R.YELLOW_CSV_COLUMNS)
    row = "1,2019-01-01 00:10:00,2019-01-01 00:20:00,1,2.5,1,N,10,20,1,9.5,0.5,0.5,1,0,0.3,11.8,0"
    with gzip.open(p, "wt") as f:
        f.write(header + "\n" + "\n".join([row] * 500) + "\n")
    df = R.read_trips_csv(spark, str(p), "yellow")
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert df.count() == 500


def test_scale_conf_sizes_partitions():
    from tripmart.session import scale_conf
    small = scale_conf(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"            # at least 3 tasks per core
    big = scale_conf(100 * 1024 ** 4, 8000)
    assert big["spark.sql.shuffle.partitions"] == "200000"          # 100 TB / 256 MB, capped
    assert big["spark.sql.sources.parallelPartitionDiscovery.parallelism"] == "10000"


def test_replacing_leaves_no_gap_and_a_failed_write_nothing(spark, tmp_path):
    name, path = "replaced_table", str(tmp_path / "replaced")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    W.replace_table(spark.range(5), name, path)
    running = spark.table(name)
    bad = spark.range(50).select(F.when(F.col("id") == 49, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        W.replace_table(bad, name, path)
    assert spark.table(name).count() == 5
    W.replace_table(spark.range(7), name, path)
    assert spark.table(name).count() == 7 and running.count() == 5          # an older reader keeps its files
    W.replace_table(spark.table(name).select((F.col("id") * 2).alias("id")), name, path)      # from its own rows
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(0, 14, 2))
    W.replace_table(spark.range(3).select("id", F.lit("x").alias("more")), name, path)        # other columns
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 3
    assert W.remove_versions(spark, name, path) >= 3 and spark.table(name).count() == 3
    W.write_table(spark.table(name).limit(1), name, "append")
    assert spark.table(name).count() == 4


def test_managed_tables_are_replaced_too(spark):
    name = "replaced_managed"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for n in (3, 8):
        W.stage(spark.range(n), name)
        assert spark.table(name).count() == n
    W.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_catalog_table_over_files(spark, tmp_path):
    name, path = "external_events", str(tmp_path / "ext")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("part"))
    rows.filter("part = 0").write.partitionBy("part").parquet(path)
    assert R.external_catalog_table(spark, name, path, schema=rows.schema, partition_by=["part"]).count() == 5
    rows.filter("part = 1").write.mode("append").partitionBy("part").parquet(path)
    R.refresh_external(spark, name)
    other = spark.newSession()                                # the catalog is shared, temp views are not
    assert other.table(name).count() == 10 and other.table(name).filter("part = 1").count() == 5
    W.drop_table(spark, name)
    assert spark.read.parquet(path).count() == 10             # the files stay
    csv = str(tmp_path / "csv")
    spark.range(4).write.option("header", True).csv(csv)
    spark.sql("DROP TABLE IF EXISTS external_csv")
    assert R.external_catalog_table(spark, "external_csv", csv, "csv", "id bigint", options={"header": "true"}).count() == 4


def test_counts_from_footers(spark, sf_small):
    out = R.metadata_summary(spark, f"{sf_small}/lineitem.parquet", ["l_orderkey"])
    plan = plan_string(out)
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey)]" in plan
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    want = li.agg(F.count("*"), F.min("l_orderkey"), F.max("l_orderkey")).first()
    assert tuple(out.first()) == tuple(want)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_partitioned_write_reads_its_input_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 5)) for i in range(300)], "id int, ts timestamp_ntz")
    W.write_partitioned(df.mapInArrow(seen, df.schema), str(tmp_path / "p"), "ts", ["id"], "day")
    assert reads.value == 300
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == 300 and back.select("day").distinct().count() == 5
