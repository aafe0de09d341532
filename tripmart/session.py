"""Session settings and the shared scratch folder.

Everything here is plain SparkSession configuration: UTC session time zone
(batch timestamps stay TIMESTAMP_NTZ), ANSI on (Spark's default), AQE with
partition coalescing and skew-join splitting, and no web UI.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tripmart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster leave ``master`` unset and let spark-submit decide;
    tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a given input size and cluster.

    Scan splits and shuffle partitions aim at ``target_partition_bytes``
    (about 256 MB: fits an executor core's memory with room to sort and spill), but never
    fewer than 3 tasks per core. AQE then coalesces small shuffle partitions
    and splits skewed ones (a partition 5x the median and over 1 GB).
    At 100 TB on 1000 executors x 8 cores this gives ~400k initial shuffle
    partitions, capped at 200k (AQE coalesces them to the real size).
    """
    parts = max(3 * total_cores, input_bytes // target_partition_bytes)
    parts = int(min(parts, 200_000))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        # partition discovery: one listing task per ~directory group, not up
        # to 10,000 tasks for a table with a few thousand date folders
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(min(10_000, 2 * total_cores)),
    }


def folder_bytes(path: str) -> int:
    """Size of a local folder's files (bench sizing; clusters pass a number)."""
    total = 0
    for root, _, files in os.walk(path):
        for f in files:
            total += os.path.getsize(os.path.join(root, f))
    return total


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL options the library relies on (all of them can be changed
    on a running session; write modes are given per write, not here)."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and k != "spark.sql.ansi.enabled":
            spark.conf.set(k, v)
    # listing a table of many date folders: a few tasks a core, not one a folder
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(min(10_000, 2 * cores(spark))))


ROWS_PER_TASK = 400_000
TASK_BYTES = 16 * 1024 * 1024
# Shuffle files go as their query ends; by themselves they stay until the driver collects its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, new: dict[str, str]):
    """Runtime settings for what runs inside; the old ones come back."""
    old = {k: spark.conf.get(k) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def small_tasks(spark: SparkSession, rows: int, folders: int = 0, scans: bool = False):
    """For writes of ``rows`` wide rows: a shuffle inside gets at least a
    partition for each ``ROWS_PER_TASK`` rows, and AQE merges them only up to
    ``TASK_BYTES``, so that a task sorts in memory at any size of the table
    (64 MB of shuffled rows are 1 GB in two sorts, which spilled). ``folders``
    is the number of partition folders that a task may keep open: up to it,
    rows go to their folders without a sort. With ``scans`` a task that reads
    files gets ``TASK_BYTES`` of them too. Shuffle files go with their write.
    Code over 8,000 bytes, which the JVM would interpret, is left in smaller
    pieces. The old settings come back."""
    new = {"spark.sql.shuffle.partitions": str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))),
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
           "spark.sql.codegen.hugeMethodLimit": "8000", **SHUFFLES_GO}
    if folders:
        new["spark.sql.maxConcurrentOutputFileWriters"] = str(folders)
    if scans:
        new["spark.sql.files.maxPartitionBytes"] = str(TASK_BYTES)
    return settings(spark, new)


def _sc(spark: SparkSession):
    """The SparkContext, or None on a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _sc(spark)
    master = sc.master if sc is not None else (spark.conf.get("spark.master", "") or "")
    return master.startswith("local")


def cores(spark: SparkSession, default: int = 8) -> int:
    sc = _sc(spark)
    return sc.defaultParallelism if sc is not None else default


_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and checkpoints.

    It is the folder the cluster names in ``spark.checkpoint.dir``. Only when
    that is unset and Spark runs in local mode (tests, bench) do we create a
    folder of our own; on a cluster an unset value is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = _sc(spark)
    app = sc.applicationId if sc is not None else str(id(spark))
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_SCRATCH.get(app)
    if not d and sc is not None:
        d = sc.getCheckpointDir()          # set through the context, not the conf
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tripmart-")
    if sc is not None and not sc.getCheckpointDir():
        try:
            sc.setCheckpointDir(d)
        except Exception:  # noqa: BLE001
            pass
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the scratch root (never reused)."""
    root = scratch_root(spark)
    sub = f"{name}-{uuid.uuid4().hex[:12]}"
    if "://" in root:
        return f"{root}/{sub}"
    return os.path.join(root, sub)
