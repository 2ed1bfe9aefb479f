"""Session construction and cluster-shared checkpoint location."""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every layer relies on.  AQE stays on (turning it off cost +137%
# wall time in the reference's own experiment); skew-join splitting is on so a
# hot key does not pin one reducer; the session time zone is pinned so that
# date parts of TIMESTAMP columns do not depend on the machine.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The cleaning predicates sit on derived columns that later projections
    # re-alias many times; constraint propagation enumerates predicate x
    # alias combinations and can spend minutes (or the heap) planning.
    "spark.sql.constraintPropagation.enabled": "false",
}

# Runtime SQL settings a query needs whatever session it runs in.
QUERY_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.constraintPropagation.enabled": "false",
}


def apply_query_conf(spark: SparkSession) -> None:
    """Set :data:`QUERY_CONF` on a session we did not build (runtime SQL
    settings only; nothing that needs a restart)."""
    for k, v in QUERY_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "meterwise", extra: dict | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """Return the active session, or build one with :data:`BASE_CONF`.

    On a cluster the launcher owns master/memory; pass ``master`` only for
    local runs and tests.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we only ever read that
    value.  When it is unset (local tests) a fallback is chosen and written
    back to the session so every later call agrees.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not fallback and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = fallback or tempfile.mkdtemp(prefix="meterwise-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh subfolder of the shared checkpoint directory."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def input_bytes(spark: SparkSession, paths) -> int:
    """Total bytes under ``paths`` from file-system metadata (no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += fs.getContentSummary(hp).getLength()
    return total


def written_size(spark: SparkSession, paths) -> tuple[int, int]:
    """Bytes and data files under ``paths`` (folders one run wrote)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    size = files = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            found = fs.getContentSummary(hp)
            size, files = size + found.getLength(), files + found.getFileCount()
    return size, files


def size_shuffles(spark: SparkSession, paths, target_bytes: int = 256 << 20,
                  expansion: float = 3.0) -> int:
    """Set ``spark.sql.shuffle.partitions`` for a job reading ``paths``.

    AQE coalesces small shuffle partitions but does not split large ones
    (outside skew handling), so the *initial* count must fit the biggest
    shuffle of the job: compressed Parquet bytes x ``expansion`` (rows are
    wider in the shuffle than in columnar files) / ``target_bytes``, never
    below the cluster's default parallelism.  Oversizing is cheap with AQE.
    """
    n = math.ceil(input_bytes(spark, paths) * expansion / target_bytes)
    n = max(n, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def keeps_shuffle_setting(fn):
    """Decorator for layer jobs that call :func:`size_shuffles`: the caller's
    ``spark.sql.shuffle.partitions`` is restored when the job returns, so
    the sizing of one job does not leak into the session."""
    import functools

    @functools.wraps(fn)
    def run(spark: SparkSession, *args, **kwargs):
        key = "spark.sql.shuffle.partitions"
        before = spark.conf.get(key)
        try:
            return fn(spark, *args, **kwargs)
        finally:
            spark.conf.set(key, before)
    return run


# A write task sorts the rows it got by output partition before it writes them, so its
# memory follows the Parquet split it read, or the part of a rebalance it was given:
# 13 to 14 bytes of rows a byte of trips.  A task whose rows belong to a few partitions
# keeps that many files open and does not sort at all; rows of further partitions are sorted.
WRITE_CONF = {
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}


def bounded_writes(fn):
    """Decorator for jobs that write partitioned layers: :data:`WRITE_CONF` holds
    while the job runs, the caller's settings afterwards."""
    import functools

    @functools.wraps(fn)
    def run(spark: SparkSession, *args, **kwargs):
        before = {k: spark.conf.get(k, None) for k in WRITE_CONF}
        for k, v in WRITE_CONF.items():
            spark.conf.set(k, v)
        try:
            return fn(spark, *args, **kwargs)
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return run
