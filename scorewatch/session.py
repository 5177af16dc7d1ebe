"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_root: str | None = None


def session_builder(app_name: str = "scorewatch") -> SparkSession.Builder:
    """Settings the operators rely on; sizing is left to the cluster's own configuration.

    AQE re-plans joins from measured sizes and splits skewed join partitions; UTC keeps day
    boundaries the same on every executor. Ranked quotas are cut before the shuffle up to large
    sizes. Stream state lives in RocksDB, off the heap, and session windows of one reviewer merge
    before the shuffle.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "100000")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    )


def local_session(cores: int | str = "*", app_name: str = "scorewatch") -> SparkSession:
    """Single-JVM session for tests and the bench."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        session_builder(app_name)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    Taken under ``spark.checkpoint.dir``, which a cluster sets to shared storage. Only a local
    master may fall back to a temporary folder of this machine.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="scorewatch-")
        root = _local_root
    return f"{root.rstrip('/')}/scorewatch/{purpose}-{uuid.uuid4().hex}"
