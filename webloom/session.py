"""Session helpers: building a session, table access and checkpoint location."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Tables of the input directory, one parquet file (or directory) each.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "webloom") -> SparkSession:
    """A session configured the way the library expects (AQE on, UTC,
    Arrow batches sized for whole web pages, no UI).  Heap sizes and, unless given,
    the number of shuffle partitions are left to the session's own settings."""
    b = SparkSession.builder.appName(app)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if os.environ.get("WEBLOOM_DRIVER_MEMORY"):
        b = b.config("spark.driver.memory", os.environ["WEBLOOM_DRIVER_MEMORY"])
    if master:
        b = b.master(master)
    return (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast only what an executed stage measured, never by an estimate
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # pages reach tens of KB; keep one Arrow batch well under a few MB
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table.  Column pruning and filters reach the scan."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    On a cluster the shared location comes from ``spark.checkpoint.dir``.
    Only a session on one machine (tests) falls back, to a folder in the
    warehouse; a cluster session without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        sc.setCheckpointDir(f"{warehouse}/webloom-scratch-{uuid.uuid4().hex[:12]}")
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "reliable checkpoint location on a cluster")


_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the reliable checkpoint location (shared on a
    cluster) for intermediate tables and stream state."""
    root = ensure_checkpoint_dir(spark)
    _SCRATCH.append(f"{root.rstrip('/')}/webloom-{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process has written and return
    how many there were.  Call it once results are stored: DataFrames that
    still read those tables are lost."""
    from .sources.store import forget_tables
    forget_tables(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _SCRATCH:
        at = path(_SCRATCH.pop())
        gone += bool(at.getFileSystem(conf).delete(at, True))
    return gone
