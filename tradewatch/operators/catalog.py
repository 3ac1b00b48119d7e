"""Catalog flavour of the cleaned and aggregate tables, built from exported snapshots.

Its cleaning rules differ from the lake's (other status words, other keys), so it stays apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.dedup import keep_first
from tradewatch.functions.numbers import ratio
from tradewatch.functions.traders import per_involved_trader

ALERT_KEY = ["alert_type", "trader_id", "symbol", "window_start", "window_end"]
FIRED_COLUMNS = ["symbol", "alert_type", "cancel_rate", "cancel_count", "detected_at"]


def _clean_alerts(bronze: DataFrame) -> DataFrame:
    return (
        bronze.withColumn("match_count", F.col("match_count").cast("int"))
        .withColumn("alert_type", F.lower("alert_type"))
        .withColumn("symbol", F.upper("symbol"))
    )


def silver_alerts(bronze: DataFrame, by_pair: bool = False) -> DataFrame:
    """One alert per type, trader, symbol and window.

    NULL traders count as equal, so wash alerts of one symbol and window collapse to the pair
    that sorts first; by_pair adds the pair to the key and keeps them all.
    """
    pair = ["trader_id_1", "trader_id_2"]
    key = ALERT_KEY + pair if by_pair else ALERT_KEY
    return keep_first(_clean_alerts(bronze), key, [F.col(name) for name in pair])


def silver_alerts_sql(bronze: DataFrame) -> DataFrame:
    """Alerts whose key tuple occurs in the table's own keys.

    Every row finds itself unless its key holds a NULL, which never compares equal. The semi
    join therefore comes down to a NOT NULL filter and needs no shuffle; it drops wash alerts.
    """
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in ALERT_KEY])
    return _clean_alerts(bronze.where(complete))


def _lower_upper(df: DataFrame) -> DataFrame:
    lowered = [name for name in ("side", "status", "trader_type") if name in df.columns]
    for name in lowered:
        df = df.withColumn(name, F.lower(name))
    return df.withColumn("symbol", F.upper("symbol"))


def silver_orders_catalog(bronze: DataFrame) -> DataFrame:
    """One row per order and status; the earliest row survives."""
    return keep_first(_lower_upper(bronze), ["order_id", "status"], [F.col("timestamp")])


def silver_trades_catalog(legs: DataFrame) -> DataFrame:
    """One leg per trade, the buy leg where there is one."""
    return keep_first(
        _lower_upper(legs), ["trade_id"], [F.when(F.col("side") == "buy", 0).otherwise(1)]
    )


def silver_orders_distinct(bronze: DataFrame) -> DataFrame:
    return _lower_upper(bronze).distinct()


def silver_trades_distinct(legs: DataFrame) -> DataFrame:
    return _lower_upper(legs).distinct()


def flagged_traders(alerts: DataFrame) -> DataFrame:
    """One row per alert and trader involved, from a single scan."""
    return per_involved_trader(alerts, *FIRED_COLUMNS)


def trader_risk_summary(alerts: DataFrame) -> DataFrame:
    """Alert history per trader.

    Counting two distinct columns at once would multiply every row. The rows are first folded
    per trader, symbol and type; what is left per trader is bounded by the symbols traded, so
    small sets count the rest in one more step.
    """
    folded = (
        flagged_traders(alerts)
        .groupBy("trader_id", "symbol", "alert_type")
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.sum("cancel_rate").alias("rate_sum"),
            F.count("cancel_rate").alias("rates"),
            F.max("cancel_count").alias("max_cancels"),
            F.min("detected_at").alias("first_at"),
            F.max("detected_at").alias("latest_at"),
        )
    )
    return folded.groupBy("trader_id").agg(
        F.sum("alerts").alias("total_alerts"),
        F.size(F.collect_set("symbol")).cast("bigint").alias("distinct_symbols_flagged"),
        F.size(F.collect_set("alert_type")).cast("bigint").alias("distinct_alert_types"),
        ratio(F.sum("rate_sum"), F.sum("rates")).alias("avg_cancel_rate"),
        F.max("max_cancels").alias("max_cancel_count_in_window"),
        F.min("first_at").alias("first_alert_at"),
        F.max("latest_at").alias("latest_alert_at"),
    )


def asset_alert_activity(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("symbol", "alert_type").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.avg("cancel_rate").alias("avg_cancel_rate"),
        F.min("detected_at").alias("first_detected"),
        F.max("detected_at").alias("latest_detected"),
    )


def daily_alert_metrics(alerts: DataFrame) -> DataFrame:
    """Alert volume per day and type; a wash alert counts under its first trader.

    Traders may be many and are counted as a distinct aggregate; symbols are few, a set does.
    """
    folded = (
        alerts.groupBy(
            F.to_date("detected_at").alias("alert_date"),
            "alert_type",
            F.coalesce("trader_id", "trader_id_1").alias("trader"),
            "symbol",
        )
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.sum("cancel_rate").alias("rate_sum"),
            F.count("cancel_rate").alias("rates"),
        )
    )
    return folded.groupBy("alert_date", "alert_type").agg(
        F.sum("alerts").alias("total_alerts"),
        F.count_distinct("trader").alias("unique_traders"),
        F.size(F.collect_set("symbol")).cast("bigint").alias("unique_symbols"),
        ratio(F.sum("rate_sum"), F.sum("rates")).alias("avg_cancel_rate"),
    )


def alert_null_audit(alerts: DataFrame) -> DataFrame:
    """How often each trader column is filled, per alert type."""
    return alerts.groupBy("alert_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("trader_id").alias("has_trader_id"),
        F.count("trader_id_1").alias("has_trader_id_1"),
        F.count("trader_id_2").alias("has_trader_id_2"),
    )
