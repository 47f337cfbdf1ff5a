"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins at run time (a small side
# measured after its shuffle becomes a broadcast, skewed partitions are split),
# timestamps are interpreted without a zone, and the UI server stays off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Bounded driver-side history of finished queries, jobs and stages (kept
    # for the UI / status store even when the UI is off).
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
}


# Suggested settings for a large cluster (read by ``get_session`` when the
# master is not local and the cluster has not set them): large scan splits and a
# broadcast bound that AQE checks against the measured size of a side. The number
# of shuffle partitions is no constant: see ``size_partitions``.
CLUSTER_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fieldmart", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local runs: the driver JVM is the only executor.
        conf.setdefault("spark.driver.memory", os.environ.get("FIELDMART_DRIVER_MEMORY", "16g"))
    else:
        existing = SparkSession.getActiveSession()
        current = existing.sparkContext.getConf() if existing else None
        for k, v in CLUSTER_CONF.items():
            if current is None or not current.contains(k):
                conf.setdefault(k, v)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (a
    temporary folder is made only when nothing is set, i.e. in local tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return root or ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder. On a cluster a missing setting is
    an error, because a driver-local folder is not shared with the executors. A
    local master (tests, bench) without one gets the folder that
    ``FIELDMART_SHARED`` names, or a new temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = os.environ.get("FIELDMART_SHARED") or tempfile.mkdtemp(prefix="fieldmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "fieldmart", *parts])


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Rows that one task sorts or adds up at most, where an operator deals them by a range.
ROWS_A_TASK = 500_000


def row_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows: those of any shuffle, and more of them where a task
    would hold over ``ROWS_A_TASK`` rows, so that its memory doesn't grow with the input."""
    return max(default_parallelism(spark), -(-rows // ROWS_A_TASK))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes under the paths, asked of their own file systems."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return total


def size_partitions(spark: SparkSession, paths: list[str], bytes_each: int = 64 * 1024 * 1024, least: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` so that a shuffle of the whole input
    gives about ``bytes_each`` of (compressed) input to a task; AQE merges what
    turns out smaller. Range shuffles use the same number."""
    n = max(least or spark.sparkContext.defaultParallelism, -(-input_bytes(spark, paths) // bytes_each))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


_once: dict[tuple, str] = {}


def materialize_once(spark: SparkSession, name: str, source: str, build):
    """The table ``build()`` written once per application and ``source`` folder;
    later callers read the same files."""
    import uuid

    key = (spark.sparkContext.applicationId, name, source)
    if key not in _once:
        path = scratch_path(spark, "tables", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")
        build().write.mode("overwrite").parquet(path)
        _once[key] = path
    return spark.read.parquet(_once[key])


def materialize(df, name: str):
    """Write ``df`` once as a parquet table under the shared checkpoint
    folder and read it back. Cuts the lineage (a lost executor re-reads the
    table instead of recomputing upstream joins) and lets several branches of
    a later plan scan it with column pruning instead of recomputing it."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, "tables", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release_materialized(spark: SparkSession) -> None:
    """Delete the tables this application wrote with :func:`materialize`
    (one folder per application id) through the cluster's file system."""
    for key in [k for k in _once if k[0] == spark.sparkContext.applicationId]:
        del _once[key]
    path = scratch_path(spark, "tables", spark.sparkContext.applicationId)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
