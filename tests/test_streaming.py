"""availableNow file stream with insert-only merge."""

import datetime as dt

from tripmart.streaming import ingest as ST

SCHEMA = "event_id bigint, ts timestamp_ntz, value double"


def test_available_now_once_then_incremental(spark, tmp_path):
    landing, target, ckpt = (str(tmp_path / n) for n in ("landing", "target", "ckpt"))
    day1 = [(i, dt.datetime(2024, 1, 1 + i % 3, 1), float(i)) for i in range(30)]
    spark.createDataFrame(day1, SCHEMA).write.parquet(landing + "/drop=1")
    ST.ingest_available(spark, landing + "/drop=1", SCHEMA, target, ckpt, key="event_id", ts_col="ts")
    assert spark.read.parquet(target).count() == 30
    # second run: no new files, nothing added
    ST.ingest_available(spark, landing + "/drop=1", SCHEMA, target, ckpt, key="event_id", ts_col="ts")
    assert spark.read.parquet(target).count() == 30
    # a new file with one overlapping id and one new id
    spark.createDataFrame([(5, dt.datetime(2024, 1, 3, 1), 5.0), (100, dt.datetime(2024, 1, 4), 1.0)],
                          SCHEMA).write.mode("append").parquet(landing + "/drop=1")
    ST.ingest_available(spark, landing + "/drop=1", SCHEMA, target, ckpt, key="event_id", ts_col="ts")
    assert spark.read.parquet(target).count() == 31


def test_same_result_for_one_and_many_files_per_batch(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for k, ids in enumerate([(1, 2, 2), (2, 3), (3, 4, 4)]):
        rows = [(i, dt.datetime(2024, 1, 1 + i), float(10 * k + i)) for i in ids]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{landing}/tmp{k}")
    import glob
    import os
    import shutil
    drop = f"{landing}/drop"
    os.makedirs(drop)
    for k in range(3):
        f = glob.glob(f"{landing}/tmp{k}/part-*.parquet")[0]
        shutil.copy(f, f"{drop}/f{k}.parquet")
        os.utime(f"{drop}/f{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    got = []
    for n in (1, 100):
        target, ckpt = str(tmp_path / f"t{n}"), str(tmp_path / f"c{n}")
        ST.ingest_available(spark, drop, SCHEMA, target, ckpt, key="event_id", ts_col="ts", files_per_batch=n)
        got.append(sorted((r.event_id, r.value) for r in spark.read.parquet(target).collect()))
    assert got[0] == got[1] == [(1, 1.0), (2, 2.0), (2, 2.0), (3, 13.0), (4, 24.0), (4, 24.0)]


def test_bad_rows_go_to_quarantine_once(spark, tmp_path):
    from pyspark.sql import types as T

    from tripmart.sources import readers as R
    schema = T.StructType.fromDDL(SCHEMA)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    landing, target, bad, ckpt = (str(tmp_path / n) for n in ("landing", "target", "bad", "ckpt"))
    spark.createDataFrame([("1", "2024-01-01 00:00:00", "1.5"), ("2", "2024-01-01 00:00:00", "oops"), ("x", "never", "2")],
                          texts).coalesce(1).write.csv(landing)

    def run(place):
        return ST.ingest_available(spark, landing, texts, target, place, key="event_id", ts_col="ts", fmt="csv",
                                   prepare=lambda df: R.typed(df, schema, "report"), quarantine=bad)

    run(ckpt)
    for again in (ckpt, str(tmp_path / "lost")):              # nothing new, then the batch replayed from the start
        run(again)
        assert [(r.event_id, r.value) for r in spark.read.parquet(target).collect()] == [(1, 1.5)]
        assert sorted(r.bad_columns for r in spark.read.parquet(bad).collect()) == [["event_id", "ts"], ["value"]]
