"""Lake sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from tradewatch.sources.lake import CSV_TIMESTAMP


def bronze_rows(messages: DataFrame, landed_at: Column | None = None) -> DataFrame:
    """Verbatim messages with the folders they land in, named after the landing time."""
    at = F.current_timestamp() if landed_at is None else landed_at
    return messages.select(
        "value",
        "topic",
        F.date_format(at, "yyyy-MM-dd").alias("date"),
        F.date_format(at, "HH").alias("hour"),
    )


def write_bronze(rows: DataFrame, root: str) -> None:
    """Append raw lines, compressed: JSON repeats its field names in every line."""
    rows.write.mode("append").partitionBy("topic", "date", "hour").text(root, compression="gzip")


def _by_date(rows: DataFrame) -> DataFrameWriter:
    """Rows of a date are spread over as many tasks as their size asks for: adaptive execution
    splits a large date and merges small ones, so neither giant nor tiny files appear."""
    return rows.hint("rebalance", "date").write.partitionBy("date")


def append_dated(rows: DataFrame, root: str) -> None:
    _by_date(rows).mode("append").parquet(root)


def overwrite_dates(rows: DataFrame, root: str) -> None:
    """Replace exactly the dates present in the rows; without rows nothing is touched."""
    _by_date(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def write_version(rows: DataFrame, root: str, version: int, *by: str) -> None:
    """Write the rows of a batch under its number; a repeated batch replaces its own rows."""
    (
        rows.withColumn("version", F.lit(version).cast("long"))
        .write.partitionBy("version", *by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )


def replace_dated(rows: DataFrame, root: str) -> None:
    """Replace the whole table, dates that no longer occur included."""
    _by_date(rows).mode("overwrite").option("partitionOverwriteMode", "static").parquet(root)


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header, compressed; a missing field is empty."""
    rows.write.mode("overwrite").csv(
        path, compression="gzip", header=True, nullValue="", emptyValue="", timestampFormat=CSV_TIMESTAMP
    )
