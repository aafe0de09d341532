"""Insert-only merge and monthly ingest."""

import datetime as dt

from pyspark.sql import functions as F

from tripmart.operators import merge as MG
from tripmart.plans.inspect import plan_string

SCHEMA = "unique_row_id string, pickup_datetime timestamp_ntz, v int"


def rows(*specs):
    return [(k, dt.datetime(2024, 1, d, 12), v) for k, d, v in specs]


def test_merge_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "t")
    src = spark.createDataFrame(rows(("a", 1, 1), ("b", 2, 2)), SCHEMA)
    MG.append_new(spark, src, path)
    MG.append_new(spark, src, path)
    assert spark.read.parquet(path).count() == 2


def test_merge_adds_only_new_and_keeps_batch_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    MG.append_new(spark, spark.createDataFrame(rows(("a", 1, 1), ("b", 2, 2)), SCHEMA), path)
    batch = spark.createDataFrame(rows(("b", 2, 99), ("c", 3, 3), ("c", 3, 3)), SCHEMA)
    MG.append_new(spark, batch, path)
    got = sorted((r.unique_row_id, r.v) for r in spark.read.parquet(path).collect())
    # b keeps the target's row; both c rows go in
    assert got == [("a", 1), ("b", 2), ("c", 3), ("c", 3)]


def test_merge_prunes_target_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    MG.append_new(spark, spark.createDataFrame(rows(*[(str(d), d, d) for d in range(1, 20)]), SCHEMA), path)
    existing = spark.read.parquet(path).filter(
        (F.col("pickup_date") >= F.lit("2024-01-03").cast("date")) & (F.col("pickup_date") <= F.lit("2024-01-04").cast("date")))
    assert "PartitionFilters: [isnotnull(pickup_date" in plan_string(existing)


def test_new_rows_dataframe_form(spark):
    t = spark.createDataFrame(rows(("a", 1, 1)), SCHEMA)
    s = spark.createDataFrame(rows(("a", 1, 5), ("z", 1, 2)), SCHEMA)
    merged = MG.merge_insert_new(s, t)
    assert sorted((r.unique_row_id, r.v) for r in merged.collect()) == [("a", 1), ("z", 2)]


def test_ingest_month_tags_file_and_hashes(spark, tmp_path, sf_small):
    from tripmart.plans.catalog import Models
    m = Models(spark, sf_small)
    path = str(tmp_path / "y")
    yellow = m.raw_yellow
    for _ in range(2):
        MG.ingest_month(spark, MG.month_slice(yellow, 1997, 12), path,
                        MG.month_file_name("yellow", 1997, 12), variant="bytes")
    t = spark.read.parquet(path)
    assert t.count() == MG.month_slice(yellow, 1997, 12).count()
    assert {r.filename for r in t.select("filename").distinct().collect()} == {"yellow_tripdata_1997-12.csv"}
    assert t.select(F.length("unique_row_id").alias("n")).distinct().first().n == 16


def test_key_that_moves_date_is_not_inserted_again(spark, tmp_path):
    path = str(tmp_path / "t")
    MG.append_new(spark, spark.createDataFrame(rows(("a", 1, 1)), SCHEMA), path)
    MG.append_new(spark, spark.createDataFrame(rows(("a", 9, 2), ("b", 9, 3)), SCHEMA), path)
    got = sorted((r.unique_row_id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1), ("b", 3)]


def test_empty_first_batch_then_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    MG.append_new(spark, spark.createDataFrame([], SCHEMA), path)
    MG.append_new(spark, spark.createDataFrame(rows(("a", 1, 1)), SCHEMA), path)
    MG.append_new(spark, spark.createDataFrame([], SCHEMA), path)
    MG.append_new(spark, spark.createDataFrame(rows(("a", 1, 1)), SCHEMA), path, key_holds_date=True)
    assert [(r.unique_row_id, r.v) for r in spark.read.parquet(path).collect()] == [("a", 1)]


def test_hot_date_is_split_and_rows_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(MG, "ROWS_PER_FILE", 10)
    path = str(tmp_path / "t")
    MG.append_new(spark, spark.createDataFrame(rows(*[(str(i), 1, i) for i in range(100)], ("x", 2, 0)), SCHEMA), path)
    assert spark.read.parquet(path).count() == 101
    files = spark.read.parquet(path).filter("pickup_date = DATE'2024-01-01'").inputFiles()
    assert len(files) > 1


def test_files_at_once_equal_files_in_turn(spark, tmp_path):
    schema = SCHEMA.replace("unique_row_id string, ", "") + ", filename string"
    base = {c: "1" for c in MG.ROW_ID_TEXT_FIELDS if c != "pickup_datetime"}

    def month(name, *days):
        d = spark.createDataFrame([(dt.datetime(2024, 1, x), x, name) for x in days], schema)
        return d.select("*", *[F.lit(v).alias(k) for k, v in base.items()])
    parts = [month("f1", 1, 2, 2), month("f2", 2, 3, 3)]
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    for p in parts:
        MG.ingest_files(spark, p, one)
    MG.ingest_files(spark, parts[0].unionByName(parts[1]), many)
    a, b = (sorted(map(tuple, spark.read.parquet(p).select("filename", "v").collect())) for p in (one, many))
    assert a == b == [("f1", 1), ("f1", 2), ("f1", 2), ("f2", 3), ("f2", 3)]


def test_landed_raw_tables_equal_the_fixture_plans(spark, sf_small):
    from tripmart.plans.catalog import Models
    landed, plain = Models(spark, sf_small), Models(spark, sf_small, materialize_inputs=False)
    for name in ("trips_raw", "fhv_raw"):
        a, b = getattr(landed, name), getattr(plain, name)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bucketed_target_is_not_moved(spark, tmp_path):
    name = "bucketed_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = spark.createDataFrame([], "unique_row_id string, v int").schema
    for _ in range(2):
        MG.ensure_bucketed(spark, name, schema, 4, path=str(tmp_path / "t"))
    first = spark.createDataFrame([(f"k{i}", i) for i in range(500)], schema)
    later = spark.createDataFrame([(f"k{i}", -i) for i in range(400, 700)] + [("k650", 7), (None, 1)], schema)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for batch in (first, later, first):
            MG.append_bucketed(spark, batch, name, 4)
        got = sorted((str(r.unique_row_id), r.v) for r in spark.table(name).collect())
        want = [(f"k{i}", i) for i in range(500)] + [(f"k{i}", -i) for i in range(500, 700)] + [("k650", 7), ("None", 1)]
        assert got == sorted(want)
        add = MG.new_bucketed_rows(spark, later, name, 4)
        plan = plan_string(add)
        # one exchange, of the batch; the table's buckets meet it as they lie
        assert plan.split("\n\n(1)")[0].count(" Exchange (") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_batch_is_read_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    rows = [("a.csv", i, dt.datetime(2024, 1, 1 + i % 3)) for i in range(60)] + [("b.csv", i, dt.datetime(2024, 1, 1 + i % 3)) for i in range(50, 70)]
    files = spark.createDataFrame(rows, "filename string, unique_row_id long, pickup_datetime timestamp_ntz")
    counted = files.mapInArrow(seen, files.schema)
    for _ in range(2):
        MG.append_new(spark, counted, str(tmp_path / "t"), first_by="filename", key_holds_date=True)
    assert reads.value == 2 * len(rows)
    got = spark.read.parquet(str(tmp_path / "t")).groupBy("filename").count().collect()
    assert {r.filename: r["count"] for r in got} == {"a.csv": 60, "b.csv": 10}
