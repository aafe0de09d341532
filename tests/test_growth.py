"""Steps whose memory, shuffle or file count must follow the table."""

import datetime as dt
import glob
import os
from decimal import Decimal

from pyspark.sql import functions as F

from tripmart.operators import merge as MG
from tripmart.plans import catalog
from tripmart.session import scratch_root, small_tasks
from tripmart.sinks import writers as W
from tripmart.sources import readers as R

SMOKE = "/root/testdata/sf0.001"


def _folders(spark, name):
    return set(glob.glob(f"{scratch_root(spark).removeprefix('file://')}/{name}-*"))


def test_small_tasks_follow_the_rows_and_give_the_settings_back(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.maxConcurrentOutputFileWriters"]
    old = [spark.conf.get(k) for k in keys]
    with small_tasks(spark, 216_000_000, folders=8):
        assert int(spark.conf.get(keys[0])) >= 540
        assert spark.conf.get(keys[2]) == "8"
    assert [spark.conf.get(k) for k in keys] == old


def test_landed_trips_keep_every_row(spark):
    m = catalog.Models(spark, SMOKE)
    plain = catalog.Models(spark, SMOKE, materialize_inputs=False).trips_raw
    assert m.trips_raw.exceptAll(plain).isEmpty() and plain.exceptAll(m.trips_raw).isEmpty()


def _rows(spark, rows):
    return spark.createDataFrame(rows, "unique_row_id string, filename string, t string").select(
        "unique_row_id", "filename", F.col("t").cast("timestamp_ntz").alias("pickup_datetime"))


def test_stored_batch_is_not_written_again(spark, tmp_path):
    path = str(tmp_path / "target")
    old = _rows(spark, [("a", "f1", "2020-01-01 10:00:00"), ("b", "f1", "2020-01-02 10:00:00"), (None, "f1", None)])
    new = _rows(spark, [("b", "f2", "2020-01-02 10:00:00"), ("c", "f2", "2020-01-02 11:00:00"), ("c", "f2", "2020-01-02 11:00:00"),
                        ("d", "f2", "2020-03-01 10:00:00"), (None, "f2", None), ("e", "f2", None)])
    before = _folders(spark, "merge_batch")
    for batch in (old, new, new.filter(F.col("unique_row_id").isNotNull())):
        MG.append_new(spark, batch, path, key_holds_date=True, stored=True)
    assert _folders(spark, "merge_batch") == before
    got = sorted((r.unique_row_id or "", r.filename) for r in spark.read.parquet(path).collect())
    assert got == [("", "f1"), ("", "f2"), ("a", "f1"), ("b", "f1"), ("c", "f2"), ("c", "f2"), ("d", "f2"), ("e", "f2")]


def test_first_file_needs_no_shuffle_of_the_rows(spark, tmp_path):
    rows = [("a", "f1"), ("a", "f1"), ("a", "f2"), ("b", "f2"), ("b", "f2"), (None, "f1"), (None, "f2"), ("c", "f3")]
    path = str(tmp_path / "batch")
    spark.createDataFrame(rows, "k string, f string").write.parquet(path)
    out = MG.first_file_rows(spark.read.parquet(path), "k", "f")
    got = sorted(((r.k or "", r.f) for r in out.collect()))
    assert got == [("", "f1"), ("", "f2"), ("a", "f1"), ("a", "f1"), ("b", "f2"), ("b", "f2"), ("c", "f3")]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "HashAggregate" not in plan and "SortAggregate" not in plan


def test_buckets_follow_the_rows():
    assert MG.bucket_count(1000) == 8
    assert MG.bucket_count(216_000_000) == 540


def test_documents_need_no_folder_each(spark):
    before = _folders(spark, "json_records")
    q = catalog.load()[0]["json_records"]
    assert q(spark, SMOKE).count() == spark.read.parquet(f"{SMOKE}/events.parquet").count()
    (place,) = _folders(spark, "json_records") - before
    assert not [d for d in os.listdir(place) if os.path.isdir(os.path.join(place, d))]


TRIP = "vendor_id string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, fare_amount decimal(18,2)"


def _trips(spark, n=400):
    """Trips of 80 days in any order, some that come twice, one without a time."""
    at = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i * 7 % 80, seconds=i) for i in range(n)]
    rows = [(str(i % 5), t, t, Decimal(i)) for i, t in enumerate(at)] + [("9", at[3], at[3], Decimal(3))] * 2
    return spark.createDataFrame([*rows, ("7", None, None, Decimal(1))], TRIP)


def _target(spark, path):
    t = spark.read.parquet(path).select("vendor_id", "pickup_datetime", F.col("fare_amount").cast("int"), "filename")
    return sorted(map(str, t.collect()))


def test_month_files_are_gzipped_and_hold_few_dates(spark, tmp_path):
    landing = str(tmp_path / "landing")
    W.write_month_files(_trips(spark), landing, "yellow", MG.month_file("yellow"))
    files = glob.glob(f"{landing}/filename=*/part-*")
    assert all(f.endswith(".csv.gz") for f in files)
    names = {f.rsplit("/", 2)[1].removeprefix("filename=") for f in files}
    assert names == {"__HIVE_DEFAULT_PARTITION__", *(f"yellow_tripdata_2024-{m:02d}.csv" for m in (1, 2, 3))}
    read = R.read_trips_csv(spark, landing, "yellow").withColumn("_file", F.input_file_name())
    assert read.count() == 403 and read.columns[:-2] == [c for c, _ in R.YELLOW_CSV_COLUMNS]
    pieces = read.select(F.to_date("tpep_pickup_datetime"), "_file").distinct().count()
    assert pieces <= 81 + spark.sparkContext.defaultParallelism


def test_month_files_load_without_a_copy(spark, tmp_path):
    landing, target, plain = (str(tmp_path / x) for x in ("landing", "target", "plain"))
    W.write_month_files(_trips(spark).filter("pickup_datetime IS NOT NULL"), landing, "yellow", MG.month_file("yellow"))
    files = R.raw_names(R.read_trips_csv(spark, landing, "yellow"))
    before = [_folders(spark, x) for x in ("merge_batch", "repeated_keys")]
    MG.ingest_files(spark, files, target, stored=True)
    MG.ingest_files(spark, files.filter("filename = 'yellow_tripdata_2024-02.csv'"), target, stored=True)
    assert [_folders(spark, x) for x in ("merge_batch", "repeated_keys")] == before
    MG.ingest_files(spark, files, plain)
    assert _target(spark, target) == _target(spark, plain) and len(_target(spark, target)) == 402


def test_files_that_share_dates_load_as_in_turn(spark, tmp_path):
    whole, turn = str(tmp_path / "whole"), str(tmp_path / "turn")
    trips = _trips(spark, 60).withColumns({c: F.lit("1") for c in MG.ROW_ID_TEXT_FIELDS if c not in ("vendor_id", "pickup_datetime", "dropoff_datetime", "fare_amount")})
    early = trips.filter("pickup_datetime < '2024-02-03'").withColumn("filename", F.lit("a.csv"))
    late = trips.filter("pickup_datetime >= '2024-02-01' OR fare_amount = 3").withColumn("filename", F.lit("b.csv"))
    for undated in (False, True):
        parts = [early, late.unionByName(trips.filter("pickup_datetime IS NULL").withColumn("filename", F.lit("c.csv"))) if undated else late]
        batch = str(tmp_path / f"batch{undated}")
        parts[0].unionByName(parts[1]).write.parquet(batch)
        MG.ingest_files(spark, spark.read.parquet(batch), f"{whole}{undated}", stored=True)
        for p in parts:
            MG.ingest_files(spark, p, f"{turn}{undated}")
        assert _target(spark, f"{whole}{undated}") == _target(spark, f"{turn}{undated}")
        assert len(_target(spark, f"{whole}{undated}")) == 62 + undated


def test_dates_that_lie_apart_are_dealt(spark, tmp_path):
    batch, target = str(tmp_path / "batch"), str(tmp_path / "target")
    rows = [(str(i), dt.datetime(2024, 1, 1 + i % 5, 3, i % 60), "a.csv") for i in range(400)]
    spark.createDataFrame(rows, "unique_row_id string, pickup_datetime timestamp_ntz, filename string").repartition(16).write.parquet(batch)
    MG.append_new(spark, spark.read.parquet(batch), target, key_holds_date=True, first_by="filename", stored=True)
    t = spark.read.parquet(target)
    assert t.count() == 400 and len(t.inputFiles()) == 5


def test_shuffle_files_go_with_their_write(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key)
    with small_tasks(spark, 10):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == old
