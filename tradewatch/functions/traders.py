"""Expressions over trader identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKET = "market"
ID_COLUMNS = ("trader_id", "trader_id_1", "trader_id_2")


def trader_type_from_id(trader_id: Column) -> Column:
    """Type read off the id text; an empty or anonymous id is the market itself."""
    return (
        F.when(trader_id.isNull() | trader_id.isin("", MARKET), MARKET)
        .when(trader_id.contains("spoofer"), "spoofer")
        .when(trader_id.contains("wash"), "wash_trader")
        .otherwise("normal")
    )


def per_involved_trader(alerts: DataFrame, *columns: str) -> DataFrame:
    """One row per alert and trader named in it, from a single pass over the alerts."""
    ids = F.array(*[F.col(name) for name in ID_COLUMNS])
    return alerts.select(
        F.explode(ids).alias("trader_id"), *[F.col(name) for name in columns]
    ).where(F.col("trader_id").isNotNull())


def is_digest(alerts: DataFrame) -> bool:
    """Whether rows stand for several alerts, by `alert_count`, of the traders in `traders`."""
    return "alert_count" in alerts.columns


def alert_number(alerts: DataFrame) -> Column:
    """Number of alerts in a row."""
    return F.col("alert_count") if is_digest(alerts) else F.lit(1).cast("bigint")


def alert_traders(alerts: DataFrame) -> Column:
    """Traders in a row's roles, filled or not."""
    return F.col("traders") if is_digest(alerts) else F.array(*[F.col(name) for name in ID_COLUMNS])


def per_role(alerts: DataFrame, *columns: str) -> DataFrame:
    """One row per alert and trader role, filled or not; `first` marks one row of each alert.

    Alerts and their distinct traders can so be counted in one aggregation: `number` is that of the alerts
    in the marked row and 0 in the others.
    """
    number = alert_number(alerts).alias("number")
    rows = alerts.select(
        F.posexplode(alert_traders(alerts)).alias("place", "trader"), number, *[F.col(name) for name in columns]
    )
    first = F.col("place") == 0
    return rows.withColumns({"first": first, "number": F.when(first, F.col("number")).otherwise(0)})
