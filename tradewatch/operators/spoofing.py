"""Spoofing: many orders of one trader in one symbol, nearly all of them cancelled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.numbers import ratio
from tradewatch.functions.times import seconds
from tradewatch.operators.selection import select_rows
from tradewatch.params import SpoofingParams


BLOCK_PANES = 16  # panes whose windows are summed together
MOST_PANES = 48  # in a block and the windows that begin in it


def cancel_windows(orders: DataFrame, params: SpoofingParams = SpoofingParams()) -> DataFrame:
    """Cancel count and rate per trader, symbol and sliding window.

    Orders still open count neither as cancelled nor as completed, and a window of open orders
    alone cannot alert, so they leave before the windows are expanded. On a table whose windows are a
    few whole slides long, orders are folded into panes of one slide; on a stream, or with other
    windows, each order goes to every window that holds it. The sums fold within each task ahead of the
    single shuffle, so a dominant trader costs no more than any other.
    """
    completed = select_rows(orders, F.col("status").isin("CANCELLED", "FILLED"))
    panes, rest = divmod(params.window_sec, params.slide_sec)
    short = rest == 0 and panes + BLOCK_PANES <= MOST_PANES
    sums = _windows_of_panes if short and not orders.isStreaming else _windows_of_orders
    return sums(completed, params).withColumn(
        "cancel_rate", ratio(F.col("cancel_count"), F.col("total_orders"))
    )


def _windows_of_orders(completed: DataFrame, params: SpoofingParams) -> DataFrame:
    window = F.window("event_time", seconds(params.window_sec), seconds(params.slide_sec))
    return completed.groupBy("trader_id", "symbol", window.alias("window")).agg(
        F.count_if(F.col("status") == "CANCELLED").alias("cancel_count"),
        F.count(F.lit(1)).alias("total_orders"),
    )


def _windows_of_panes(completed: DataFrame, params: SpoofingParams) -> DataFrame:
    """Counts per pane as columns of one row per trader, symbol and block of panes.

    A block takes the windows that begin in it, hence also the panes of the next block that they reach
    into: an order of those, three in sixteen panes by default, counts in two blocks, any other in one.
    """
    slide = params.slide_sec
    reach = params.window_sec // slide - 1
    pane = F.floor(F.unix_seconds("event_time") / slide)
    block = lambda n: F.floor(n / BLOCK_PANES)
    placed = (
        completed.where(F.col("event_time").isNotNull())
        .select("trader_id", "symbol", pane.alias("pane"), (F.col("status") == "CANCELLED").alias("cancelled"))
        .withColumn("block", F.explode(F.sequence(block(F.col("pane") - reach), block(F.col("pane")))))
    )
    place = F.col("pane") - F.col("block") * BLOCK_PANES
    panes = range(BLOCK_PANES + reach)
    counts = [F.count_if((place == k) & F.col("cancelled")).alias(f"c{k}") for k in panes]
    counts += [F.count_if(place == k).alias(f"n{k}") for k in panes]
    blocks = placed.groupBy("trader_id", "symbol", "block").agg(*counts)

    def window(k: int) -> Column:
        start = (F.col("block") * BLOCK_PANES + k) * slide
        total = lambda letter: sum((F.col(f"{letter}{k + i}") for i in range(1, reach + 1)), F.col(f"{letter}{k}"))
        return F.struct(
            F.struct(
                F.timestamp_seconds(start).alias("start"),
                F.timestamp_seconds(start + params.window_sec).alias("end"),
            ).alias("window"),
            total("c").alias("cancel_count"),
            total("n").alias("total_orders"),
        )

    windows = F.array(*[window(k) for k in range(BLOCK_PANES)])
    return blocks.select("trader_id", "symbol", F.inline(windows)).where(F.col("total_orders") > 0)


def spoofing_alerts(
    orders: DataFrame,
    params: SpoofingParams = SpoofingParams(),
    detected_at: Column | None = None,
) -> DataFrame:
    """One alert per window above both thresholds; overlapping windows alert separately."""
    return (
        cancel_windows(orders, params)
        .where(
            (F.col("cancel_count") > params.min_cancel_count)
            & (F.col("cancel_rate") > params.min_cancel_rate)
        )
        .select(
            F.lit("SPOOFING").alias("alert_type"),
            "trader_id",
            "symbol",
            "cancel_count",
            "total_orders",
            "cancel_rate",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
        .withColumn(
            "detected_at",
            F.date_trunc("second", F.current_timestamp()) if detected_at is None else detected_at,
        )
    )
