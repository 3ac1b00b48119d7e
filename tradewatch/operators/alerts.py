"""The alert feed: both detectors in one shape, as rows and as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.operators.spoofing import spoofing_alerts
from tradewatch.operators.wash import wash_alerts, wash_digest, wash_first_pairs
from tradewatch.params import SpoofingParams, WashParams


def conform(alerts: DataFrame, *more: str) -> DataFrame:
    """Every declared alert column in order; a column the input lacks is NULL. `more` stay behind them."""
    present = set(alerts.columns)
    return alerts.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.ALERT
        ],
        *more,
    )


def all_alerts(
    orders: DataFrame,
    spoofing: SpoofingParams = SpoofingParams(),
    wash: WashParams = WashParams(),
    detected_at: Column | None = None,
) -> DataFrame:
    return conform(spoofing_alerts(orders, spoofing, detected_at)).unionByName(
        conform(wash_alerts(orders, wash, detected_at))
    )


def alert_digest(
    orders: DataFrame,
    spoofing: SpoofingParams = SpoofingParams(),
    wash: WashParams = WashParams(),
    detected_at: Column | None = None,
) -> DataFrame:
    """Alerts of a table for counting: wash alerts folded where they arise, spoofing alerts one by one.

    `alert_count` is the number of alerts of one type, symbol and window in a row, `traders` names all their
    traders, and the other columns are those of the alert whose pair sorts first.
    """
    alone = {"alert_count": F.lit(1).cast("bigint"), "traders": F.array("trader_id")}
    return (
        conform(spoofing_alerts(orders, spoofing, detected_at))
        .withColumns(alone)
        .unionByName(conform(wash_digest(orders, wash, detected_at), *alone))
    )


def first_alerts(
    orders: DataFrame,
    spoofing: SpoofingParams = SpoofingParams(),
    wash: WashParams = WashParams(),
    detected_at: Column | None = None,
) -> DataFrame:
    """All spoofing alerts of a table, and of the wash alerts at least the first pair of each symbol and window."""
    return conform(spoofing_alerts(orders, spoofing, detected_at)).unionByName(
        conform(wash_first_pairs(orders, wash, detected_at))
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    """One JSON message per alert, keyed by symbol; absent columns are left out of the text."""
    return alerts.select(
        F.lit("alerts").alias("topic"),
        F.col("symbol").alias("key"),
        F.to_json(F.struct("*")).alias("value"),
    )


def alerts_since(alerts: DataFrame, day: Column) -> DataFrame:
    """Alerts detected from the start of the given day on."""
    return alerts.where(F.col("detected_at") >= F.date_trunc("day", day))
