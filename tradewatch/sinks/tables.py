"""Catalog tables in three layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The layers and what they hold.
LAYERS = {
    "bronze": "Raw snapshots",
    "silver": "Cleaned and deduplicated tables",
    "gold": "Aggregate tables",
}


def layer_name(layer: str, prefix: str = "") -> str:
    return f"{prefix}{layer}"


def create_layers(spark: SparkSession, prefix: str = "", location: str | None = None) -> None:
    """Create the layer schemas where they do not exist yet."""
    for layer, comment in LAYERS.items():
        place = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS {layer_name(layer, prefix)} COMMENT '{comment}'{place}"
        )


def drop_layers(spark: SparkSession, prefix: str = "") -> None:
    """Drop the layer schemas with all their tables."""
    for layer in LAYERS:
        spark.sql(f"DROP SCHEMA IF EXISTS {layer_name(layer, prefix)} CASCADE")


def replace_table(df: DataFrame, name: str, table_format: str = "parquet") -> DataFrame:
    """Overwrite a managed table and return it as a scan."""
    df.write.format(table_format).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
