"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (runtime partition coalescing,
# skew-join splitting, broadcast conversion from measured sizes), UTC session time
# and no web UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where a later operator then needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "actuaria",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is only set when given, so that ``spark-submit`` on a cluster keeps
    its own master. ``shuffle_partitions`` should be sized so that one shuffle
    partition holds a few hundred MB at the target scale; AQE coalesces them at
    small scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(
    largest_shuffle_bytes: int,
    partition_bytes: int = 256 * 1024**2,
    min_partitions: int = 200,
) -> dict[str, str]:
    """Settings that keep each shuffle partition near ``partition_bytes``.

    ``largest_shuffle_bytes`` is the expected size of the biggest exchange (here the
    claims ⋈ policies join). Example: 18 TB of shuffled rows -> ~72,000 partitions of
    256 MB. Scan splits use the same size, and adaptive execution coalesces the small
    shuffles of the aggregated marts and splits skewed partitions above ~4x the target.
    """
    partitions = max(min_partitions, -(-largest_shuffle_bytes // partition_bytes))
    size = f"{partition_bytes // 1024**2}m"
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * partition_bytes // 1024**2}m",
    }


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a shared file system path); a
    machine-local temporary folder would be lost with its executor. Only a local
    session (tests, bench) without the setting gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a shared folder "
                "(HDFS/S3/ABFS) before running on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="actuaria-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def clear_scratch(spark: SparkSession, older_than_seconds: float) -> list[str]:
    """Remove written intermediate tables that were last changed longer ago; return their names.

    They are the inputs of lazy frames, so the age should exceed that of any job that may still read
    one. A job that runs for good (a service, a notebook) calls this from time to time.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    gone = []
    for status in fs.listStatus(folder):
        if time.time() - status.getModificationTime() / 1000 > older_than_seconds:
            fs.delete(status.getPath(), True)
            gone.append(status.getPath().getName())
    return sorted(gone)


# Each execution's shuffle files go when it ends, not when the driver's JVM happens to collect its plan
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_users: dict[int, tuple[int, str | None]] = {}  # session -> (blocks inside, setting before the first)
_users_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within this block the shuffle files of a query are removed as soon as it has ended.

    For runs that write table after table: else the shuffles of every write stay on the executors'
    disks beside those of the next. A frame that is run twice makes its shuffles again, so the session's own
    setting comes back after the last of the blocks that are open at the same time.
    """
    session = spark._jsparkSession.hashCode()
    with _users_lock:
        inside, before = _users.get(session, (0, None))
        if not inside:
            before = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _users[session] = inside + 1, before
    try:
        yield
    finally:
        with _users_lock:
            inside, before = _users.pop(session)
            if inside > 1:
                _users[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage before a DataFrame is read several times (each later read is a
    columnar scan of the written table, not a recomputation) and survives the loss
    of executors, unlike cached blocks or a local checkpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
