"""Topic scans. They need Spark's Kafka connector on the classpath."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The topics of the platform.
TOPICS = ("orders", "trades", "market-data-stocks", "market-data-crypto", "alerts")


def _messages(reader, servers: str, topics: Sequence[str]) -> DataFrame:
    scan = reader.format("kafka").option("kafka.bootstrap.servers", servers)
    return (
        scan.option("subscribe", ",".join(topics))
        .load()
        .select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("broker_time"),
        )
    )


def topic_stream(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = TOPICS,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Messages as they arrive, from the earliest offset on unless a checkpoint says otherwise."""
    reader = spark.readStream.option("startingOffsets", starting)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return _messages(reader, servers, topics)


def topic_since(
    spark: SparkSession, servers: str, topics: Sequence[str], since: datetime
) -> DataFrame:
    """Messages the broker received from a time on; the broker seeks, nothing earlier is read."""
    millis = str(int(since.timestamp() * 1000))
    reader = spark.read.option("startingTimestamp", millis).option(
        "startingOffsetsByTimestampStrategy", "latest"
    )
    return _messages(reader, servers, topics)
