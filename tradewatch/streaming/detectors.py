"""The detectors on a stream of orders.

The operators are the batch ones. A watermark on the order time closes windows; results are
final and appended once. Alerts may leave as rows or as messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tradewatch.functions.times import seconds
from tradewatch.operators.alerts import conform
from tradewatch.operators.spoofing import spoofing_alerts
from tradewatch.operators.wash import wash_alerts
from tradewatch.params import SpoofingParams, WashParams


def watermarked(orders: DataFrame, delay_sec: int) -> DataFrame:
    return orders.withWatermark("event_time", seconds(delay_sec))


def spoofing_stream(
    orders: DataFrame,
    params: SpoofingParams = SpoofingParams(),
    detected_at: Column | None = None,
) -> DataFrame:
    return conform(spoofing_alerts(watermarked(orders, params.watermark_sec), params, detected_at))


def wash_stream(
    orders: DataFrame, params: WashParams = WashParams(), detected_at: Column | None = None
) -> DataFrame:
    """Both sides carry the window as their only event-time column.

    Spark keeps a buy or sell in join state until its window closes, as the window is part of
    the join key, and allows the aggregation on the same window to follow.
    """
    return conform(wash_alerts(watermarked(orders, params.watermark_sec), params, detected_at))


def parquet_writer(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append rows to Parquet files, each exactly once across restarts."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the query's state operators dropped behind the watermark, over its recent batches.

    An aggregation counts a row once for each window that it is late for.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
