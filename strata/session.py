"""Session set-up and shared scratch locations.

The library never hard-codes a storage location: intermediate tables and checkpoints go under
the cluster's ``spark.checkpoint.dir`` (a shared folder every executor can reach). Only when a
session has none set (local tests) do we create one under the machine's temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone: feeds carry offsets and the test tables are
# timestamp_ntz, so dates are only well defined with a pinned session zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


# Settings for a large cluster (e.g. 1000 executors reading ~100 TB). AQE sizes shuffle
# partitions from measured map output (start high, coalesce to ~256 MB), splits skewed join
# partitions and skewed rebalance partitions; scans split files at 256 MB. Checkpoints and
# intermediate tables go to the shared folder the cluster names in spark.checkpoint.dir.
CLUSTER_DEFAULTS = {
    **SESSION_DEFAULTS,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_cluster_session(app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Session for a cluster (master and checkpoint folder come from the submit configuration)."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**CLUSTER_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not (spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's object store)")
    configure(spark)
    return spark


def build_session(master: str = "local[*]", app_name: str = "strata", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Create (or get) a session for local runs and tests."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session; set one only where it is unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext: use the configured folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder for this session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_generated_subdir(current) else current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")  # one machine, as in tests
    sc.setCheckpointDir(configured)
    return configured


def _is_generated_subdir(path: str) -> bool:
    # SparkContext.setCheckpointDir appends a random UUID folder to the given directory.
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root for one run's tables."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/strata-{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can inspect a local folder (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def materialized(df, name: str):
    """Write a frame once to a fresh folder under the shared checkpoint root; the frame read back and the
    folder. Cuts lineage (a lost executor recomputes from the files, not from the sources) and gives
    the planner the real size of the data."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df, name: str):
    """The frame of :func:`materialized`; its folder lasts as long as the checkpoint folder."""
    return materialized(df, name)[0]


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`materialized` made, through the file system of its path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
