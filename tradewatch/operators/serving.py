"""Analyst views over alerts and daily activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.functions import display, severity
from tradewatch.functions.traders import ID_COLUMNS, alert_number, alert_traders, per_involved_trader, per_role
from tradewatch.operators.alerts import conform
from tradewatch.params import ServingParams

ALL = "ALL"
FEED_COLUMNS = (
    "detected_at", "alert_type", "severity", "symbol", "trader_id", "trader_id_1", "trader_id_2",
    "cancel_rate", "cancel_count", "total_orders", "match_count", "avg_price_diff_pct",
)


def _counted(alerts: DataFrame) -> DataFrame:
    """Every declared column of alerts, or of their digest."""
    return conform(alerts, *[name for name in ("alert_count", "traders") if name in alerts.columns])


def with_severity(alerts: DataFrame) -> DataFrame:
    return conform(alerts).withColumn(
        "severity", severity.severity(F.col("alert_type"), F.col("cancel_rate"))
    )


def _newest(alerts: DataFrame, limit: int | None) -> DataFrame:
    """The newest rows in a total order: each task keeps its own top rows before they meet.

    Without a limit all rows, in no order.
    """
    if limit is None:
        return alerts
    return alerts.orderBy(
        F.desc("detected_at"), "alert_type", "symbol", *ID_COLUMNS, "window_start"
    ).limit(limit)


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """Headline row: alerts, alerts by type, distinct traders."""
    def number(*kinds: str) -> Column:
        wanted = F.when(F.col("alert_type").isin(*kinds), F.col("number")) if kinds else F.col("number")
        return F.coalesce(F.sum(wanted), F.lit(0).cast("bigint"))

    return per_role(_counted(alerts), "alert_type").agg(
        number().alias("total_alerts"),
        number("SPOOFING").alias("spoofing_alerts"),
        number("WASH_TRADING").alias("wash_alerts"),
        F.count_distinct("trader").alias("unique_traders"),
    )


def filter_alerts(
    alerts: DataFrame, alert_type: str = ALL, level: str = ALL, symbol: str = ALL
) -> DataFrame:
    """Graded alerts that meet every chosen filter."""
    graded = with_severity(alerts)
    for name, wanted in (("alert_type", alert_type), ("severity", level), ("symbol", symbol)):
        if wanted != ALL:
            graded = graded.where(F.col(name) == wanted)
    return graded


def alert_feed(
    alerts: DataFrame,
    alert_type: str = ALL,
    level: str = ALL,
    symbol: str = ALL,
    params: ServingParams = ServingParams(),
) -> DataFrame:
    matching = filter_alerts(alerts, alert_type, level, symbol)
    return _newest(matching, params.feed_limit).select(*FEED_COLUMNS)


def formatted(alerts: DataFrame) -> DataFrame:
    """Clock time and percentages as shown to the analyst."""
    return (
        alerts.withColumn("detected_at", display.clock(F.col("detected_at")))
        .withColumn("cancel_rate", display.percent(F.col("cancel_rate")))
        .withColumn("avg_price_diff_pct", display.percent_points(F.col("avg_price_diff_pct")))
    )


def high_risk_traders(alerts: DataFrame, params: ServingParams = ServingParams()) -> DataFrame:
    """Traders with most alerts.

    A trader's rate is the mean of the means of their roles. Only the spoofing role has a rate,
    so one aggregation gives it directly.
    """
    known = conform(alerts)
    spoofing = F.col("alert_type") == "SPOOFING"
    wash = F.col("alert_type") == "WASH_TRADING"
    ids = F.when(spoofing, F.array("trader_id")).when(wash, F.array("trader_id_1", "trader_id_2"))
    ranking = (
        known.select(
            F.explode(ids).alias("trader_id"),
            "alert_type",
            "detected_at",
            F.when(spoofing, F.col("cancel_rate")).alias("rate"),
        )
        .where(F.col("trader_id").isNotNull())
        .groupBy("trader_id")
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            F.concat_ws(" + ", F.array_sort(F.collect_set("alert_type"))).alias("alert_types"),
            F.avg("rate").alias("avg_cancel_rate"),
            F.max("detected_at").alias("latest_alert"),
        )
    )
    if params.top_traders is None:
        return ranking
    return ranking.orderBy(F.desc("alert_count"), "trader_id").limit(params.top_traders)


def high_risk_traders_formatted(
    alerts: DataFrame, params: ServingParams = ServingParams()
) -> DataFrame:
    return (
        high_risk_traders(alerts, params)
        .withColumn("avg_cancel_rate", display.percent(F.col("avg_cancel_rate")))
        .withColumn("latest_alert", display.clock(F.col("latest_alert")))
    )


def asset_risk_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per symbol and type; rows without either are left out."""
    known = alerts.where(F.col("symbol").isNotNull() & F.col("alert_type").isNotNull())
    return known.groupBy("symbol", "alert_type").agg(F.sum(alert_number(alerts)).alias("alert_count"))


def alert_hourly_volume(alerts: DataFrame) -> DataFrame:
    """Alerts per hour of day and type."""
    known = alerts.where(F.col("detected_at").isNotNull() & F.col("alert_type").isNotNull())
    return known.groupBy(F.hour("detected_at").alias("hour"), "alert_type").agg(
        F.sum(alert_number(alerts)).alias("alert_count")
    )


def alert_filter_options(alerts: DataFrame) -> DataFrame:
    """Values on offer in the type, symbol and trader selectors, from one pass."""

    def option(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("selector"), value.alias("value"))

    known = _counted(alerts)
    options = F.concat(
        F.array(option("alert_type", F.col("alert_type")), option("symbol", F.col("symbol"))),
        F.transform(alert_traders(known), lambda trader: option("trader", trader)),
    )
    return (
        known.select(F.inline(options))
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("selector", "value")
    )


def trader_alert_drilldown(
    alerts: DataFrame, trader_id: str, params: ServingParams = ServingParams()
) -> DataFrame:
    """Newest alerts that name the trader in any role."""
    graded = with_severity(alerts)
    named = (
        (F.col("trader_id") == trader_id)
        | (F.col("trader_id_1") == trader_id)
        | (F.col("trader_id_2") == trader_id)
    )
    return _newest(graded.where(named), params.drilldown_limit)


def trader_activity_lookup(alerts: DataFrame, activity: DataFrame) -> DataFrame:
    """Daily activity of every alerted trader; traders without any keep one row of NULLs."""
    return per_involved_trader(conform(alerts)).distinct().join(activity, "trader_id", "left")


def activity_cards(activity: DataFrame) -> DataFrame:
    """Daily activity as shown on a trader's cards."""
    return activity.select(
        "trader_id",
        "date",
        "symbol",
        display.grouped(F.col("total_orders")).alias("orders"),
        display.grouped(F.col("total_cancels")).alias("cancels"),
        display.percent(F.col("cancel_rate")).alias("cancel_rate"),
        display.grouped(F.col("total_trades")).alias("trades"),
        display.fixed(F.col("avg_order_size"), 1).alias("avg_order_size"),
        display.fixed(F.col("avg_time_to_cancel"), 0, "s").alias("avg_time_to_cancel"),
    )


def ranked_risk(summary: DataFrame) -> DataFrame:
    """The trader risk table as displayed, most alerts first."""
    return summary.orderBy(F.desc("total_alerts"), "trader_id")


def ranked_assets(activity: DataFrame) -> DataFrame:
    """The asset activity table as displayed, most alerts first."""
    return activity.orderBy(F.desc("alert_count"), "symbol", "alert_type")


def newest_days(metrics: DataFrame) -> DataFrame:
    """The daily metrics table as displayed, newest day first."""
    return metrics.orderBy(F.desc("alert_date"), "alert_type")
