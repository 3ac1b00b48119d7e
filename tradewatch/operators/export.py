"""Samples and leg expansion for the exported snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.functions.traders import ID_COLUMNS, trader_type_from_id
from tradewatch.params import ExportParams


def _newest_of_type(alerts: DataFrame, alert_type: str, limit: int | None) -> DataFrame:
    own = alerts.where(F.col("alert_type") == alert_type)
    if limit is None:
        return own
    return (
        own.orderBy(F.desc("detected_at"), F.desc("window_start"), "symbol", *ID_COLUMNS)
        .limit(limit)
    )


def balanced_alert_sample(alerts: DataFrame, params: ExportParams = ExportParams()) -> DataFrame:
    """Half the limit of each alert type, newest first.

    Two top-k reports: each task passes on its own newest rows only, and with alerts straight
    from the detectors each report runs just the detector it needs.
    """
    half = None if params.alert_limit is None else params.alert_limit // 2
    columns = schemas.ALERT_CSV.fieldNames()
    spoofing = _newest_of_type(alerts, "SPOOFING", half)
    wash = _newest_of_type(alerts, "WASH_TRADING", half)
    return spoofing.unionByName(wash).select(*columns)


def latest_orders_sample(orders: DataFrame, params: ExportParams = ExportParams()) -> DataFrame:
    """Newest order events, every status included."""
    if params.order_limit is not None:
        newest = orders.orderBy(F.desc("timestamp"), F.desc("order_id"), "status")
        orders = newest.limit(params.order_limit)
    return orders.select(*schemas.ORDER_CSV.fieldNames())


def _leg(side: str, trader: Column, place: int) -> Column:
    return F.struct(
        trader.alias("trader_id"),
        trader_type_from_id(trader).alias("trader_type"),
        F.lit(side).alias("side"),
        F.lit(place).alias("_place"),
    )


def _legs(trades: DataFrame) -> DataFrame:
    both = F.array(_leg("buy", F.col("buy_trader_id"), 0), _leg("sell", F.col("sell_trader_id"), 1))
    return trades.select("*", F.inline(both)).withColumn("order_id", F.lit(""))


def trade_legs(trades: DataFrame) -> DataFrame:
    """A buy row and a sell row per trade; legs carry no order id."""
    return _legs(trades).select(*schemas.LEG_CSV.fieldNames())


NEWEST_TRADE = ("timestamp", "trade_id", "price", "quantity", "buy_trader_id", "sell_trader_id")


def latest_trade_legs_sample(trades: DataFrame, params: ExportParams = ExportParams()) -> DataFrame:
    """Legs of the newest trades up to a row limit, which may fall between two legs of a trade.

    Only half as many trades as legs are needed, so the cut is made on trades first.
    """
    if params.leg_limit is None:
        return trade_legs(trades)
    newest = [F.desc(name) for name in NEWEST_TRADE]
    trades = trades.orderBy(*newest).limit((params.leg_limit + 1) // 2)
    return (
        _legs(trades)
        .orderBy(*newest, "_place")
        .limit(params.leg_limit)
        .select(*schemas.LEG_CSV.fieldNames())
    )
