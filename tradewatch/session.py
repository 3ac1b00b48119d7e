"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Runtime settings every job relies on; all can be set on a running session.
RUNTIME_CONF = {
    # Event times are UTC throughout; windows, dates and hours are UTC calendar buckets.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Some joins and windows turn few bytes into much work; keep them on all cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join may keep the cut of its sides by fewer columns than it compares.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ROCKSDB_CONF = {
    "changelogCheckpointing.enabled": "true",
    "boundedMemoryUsage": "true",
    "maxMemoryUsageMB": "256",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state off the heap; wanted once window state outgrows executor memory.

    The stores of a process share a bounded amount of memory. Without a bound each partition of state
    has write buffers of its own, of up to 128 MB.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    for key, value in ROCKSDB_CONF.items():
        spark.conf.set(f"spark.sql.streaming.stateStore.rocksdb.{key}", value)


def build_session(
    app_name: str = "tradewatch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session. On a cluster leave master and partitions to spark-submit and AQE."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


@lru_cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tradewatch-")


def working_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach, below the cluster's spark.checkpoint.dir.

    Without that setting a local session falls back to a temporary folder; a cluster session
    is refused, as a folder on one machine cannot hold the data of others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
