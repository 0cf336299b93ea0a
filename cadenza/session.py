"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cadenza") -> SparkSession:
    """Return the active session or build one tuned for this library.

    On a cluster the launcher supplies master, memory and partition counts;
    locally (tests, bench) we default to ``local[*]`` with few partitions.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if master is None or master.startswith("local"):
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", os.environ.get("CADENZA_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM: not ``local-cluster``, whose executors share no folder by default."""
    try:
        return spark.conf.get("spark.master", "").split("[")[0] == "local"
    except Exception:
        return False


def _local_scratch(spark: SparkSession) -> str:
    """Scratch folder for local runs only; a cluster must name a shared one."""
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share "
                           "(the cleaned rows, voted tracks and id tables are written there)")
    return tempfile.mkdtemp(prefix="cadenza-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Make sure reliable checkpoints have a home.

    The cluster names a shared folder in ``spark.checkpoint.dir``; Spark reads
    it at start-up.  Only when nothing is configured and the session is local
    (tests, bench) do we fall back to a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint dir
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or _local_scratch(spark)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    base = ensure_checkpoint_dir(spark) or spark.conf.get("spark.checkpoint.dir", None) or _local_scratch(spark)
    return f"{base.rstrip('/')}/cadenza-{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, most: int, rows: int = 512):
    """In what runs inside the block, rows go to Python workers in batches of
    about ``most`` bytes and leave Parquet readers ``rows`` at once, unless the
    session has bounds of its own.  For wide rows: long texts or arrays."""
    bounds = {"spark.sql.execution.arrow.maxBytesPerBatch": most, "spark.sql.parquet.columnarReaderBatchSize": rows}
    bounds = {key: n for key, n in bounds.items() if spark.conf.get(key, None) is None}
    for key, n in bounds.items():
        spark.conf.set(key, str(n))
    try:
        yield
    finally:
        for key in bounds:
            spark.conf.unset(key)


def checkpoint(df, label: str = "stage", options: dict | None = None):
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    read it back (eager).

    Cuts lineage so a lost executor re-reads the written files instead of
    recomputing upstream shuffles; the columnar copy is cheaper to write and
    read than serialized rows and keeps column pruning and filter pushdown
    for every reader.  Never a local checkpoint.  ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return spark.read.parquet(path)


#: paths of the innermost scope that the calling context is in
_SCOPE: ContextVar[list[str] | None] = ContextVar("cadenza_scope", default=None)


def delete_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete folders through the cluster's file system (any Hadoop URI)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # Spark Connect: the server owns the storage
        return 0
    n = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        n += bool(hp.getFileSystem(conf).delete(hp, True))
    return n


@contextmanager
def stage_scope(spark: SparkSession):
    """Stage tables written inside the block, by this context or copies of
    it, are deleted when it ends; those of other threads stay.

    Use it around a job whose results are written elsewhere (the load job);
    DataFrames that still read a stage must not be used after the block.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        delete_paths(spark, paths)
