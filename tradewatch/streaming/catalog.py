"""Catalog rebuild: snapshots to raw, cleaned and aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewatch import schemas
from tradewatch.operators import catalog
from tradewatch.sinks.lake import write_csv
from tradewatch.sinks.tables import create_layers, layer_name, replace_table
from tradewatch.sources.lake import read_csv

SNAPSHOTS = {"alerts": schemas.ALERT_CSV, "orders": schemas.ORDER_CSV, "trades": schemas.LEG_CSV}


def write_snapshots(folder: str, **frames: DataFrame) -> None:
    for name, frame in frames.items():
        write_csv(frame, f"{folder}/{name}")


def rebuild_catalog(
    spark: SparkSession,
    snapshot_folder: str,
    prefix: str = "",
    location: str | None = None,
    table_format: str = "parquet",
) -> dict[str, DataFrame]:
    """Replace every table of the three layers from CSV snapshots and return them by name."""
    create_layers(spark, prefix, location)

    def replace(layer: str, name: str, df: DataFrame) -> DataFrame:
        return replace_table(df, f"{layer_name(layer, prefix)}.{name}", table_format)

    bronze = {
        name: replace("bronze", name, read_csv(spark, f"{snapshot_folder}/{name}", schema))
        for name, schema in SNAPSHOTS.items()
    }
    alerts = replace("silver", "alerts", catalog.silver_alerts(bronze["alerts"]))
    orders = replace("silver", "orders", catalog.silver_orders_catalog(bronze["orders"]))
    trades = replace("silver", "trades", catalog.silver_trades_catalog(bronze["trades"]))
    gold = {
        name: replace("gold", name, build(alerts))
        for name, build in (
            ("trader_risk_summary", catalog.trader_risk_summary),
            ("asset_alert_activity", catalog.asset_alert_activity),
            ("daily_alert_metrics", catalog.daily_alert_metrics),
        )
    }
    return {
        **{f"bronze.{name}": df for name, df in bronze.items()},
        "silver.alerts": alerts,
        "silver.orders": orders,
        "silver.trades": trades,
        **{f"gold.{name}": df for name, df in gold.items()},
    }
