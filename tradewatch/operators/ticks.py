"""Market ticks: flattening, routing, last price and orders against the last price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch import schemas

BLOCK = 2016  # buckets that are sequenced together: a week of five minutes
CRYPTO_PREFIX = "BINANCE:"
CRYPTO_TOPIC = "market-data-crypto"
STOCK_TOPIC = "market-data-stocks"


def flatten_ticks(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """One row per print of every trade message; other messages and empty ones leave nothing."""
    # Parsed in a generator so that the filter below does not parse each message again.
    parsed = messages.select(F.inline(F.array(F.from_json("value", schemas.TICK_MESSAGE))))
    tick = F.col("tick")
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return (
        parsed.where(F.col("type") == "trade")
        .select(F.explode("data").alias("tick"))
        .select(
            F.lit("market_tick").alias("event_type"),
            tick["s"].alias("symbol"),
            tick["p"].alias("price"),
            tick["v"].alias("volume"),
            tick["t"].alias("timestamp_ms"),
            iso_from_millis(tick["t"]).alias("timestamp_iso"),
            F.coalesce(tick["c"], F.array().cast("array<string>")).alias("conditions"),
            (now if ingested_at is None else ingested_at).alias("ingested_at"),
        )
    )


def iso_from_millis(millis: Column) -> Column:
    """ISO text with offset; the fraction is left out on a whole second."""
    ts = F.timestamp_millis(millis)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(millis % 1000 == 0, whole).otherwise(fraction)


def route_ticks(ticks: DataFrame) -> DataFrame:
    """The topic each tick is published to."""
    crypto = F.col("symbol").startswith(CRYPTO_PREFIX)
    return ticks.withColumn("topic", F.when(crypto, CRYPTO_TOPIC).otherwise(STOCK_TOPIC))


def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks with a symbol and a price other than zero."""
    return ticks.where((F.col("symbol") != "") & (F.col("price") != 0))


def latest_tick_per_symbol(ticks: DataFrame) -> DataFrame:
    """Last price of each symbol; the higher price wins at equal times.

    Two maxima of plain numbers are hash aggregates; the maximum of a struct would sort all ticks.
    """
    valid = valid_ticks(ticks)
    last = valid.groupBy("symbol").agg(F.max("timestamp_ms").alias("timestamp_ms"))
    at_last = valid.join(last.withColumnRenamed("timestamp_ms", "last_ms"), "symbol")
    return (
        at_last.where(F.col("timestamp_ms").eqNullSafe(F.col("last_ms")))
        .groupBy("symbol", "timestamp_ms")
        .agg(F.max("price").alias("price"))
    )


def order_vs_last_tick(orders: DataFrame, ticks: DataFrame, bucket_ms: int = 300_000) -> DataFrame:
    """Each order with the latest tick of its symbol at or before it.

    A window over whole symbols would put a busy symbol into one task. Both inputs are cut into
    time buckets, and each bucket starts from the last tick of the buckets before it. Those
    opening ticks come from one row per symbol and bucket, sequenced week by week, so the only
    sequence over a symbol's whole history has a row per week.
    """
    bucket = F.floor(F.col("at_ms") / F.lit(bucket_ms)).alias("bucket")
    timed_ticks = valid_ticks(ticks).where(F.col("timestamp_ms").isNotNull())
    tick_rows = timed_ticks.select(
        "symbol", F.col("timestamp_ms").alias("at_ms"), F.struct("timestamp_ms", "price").alias("tick")
    )
    order_rows = orders.select(
        "symbol", F.unix_millis("event_time").alias("at_ms"), F.struct(*orders.columns).alias("placed")
    )
    opening = _opening_ticks(
        tick_rows.select("symbol", bucket, "tick"), order_rows.select("symbol", bucket)
    )
    rows = (
        tick_rows.select("symbol", bucket, "at_ms", "tick")
        .unionByName(opening, allowMissingColumns=True)
        .unionByName(order_rows.select("symbol", bucket, "at_ms", "placed"), allowMissingColumns=True)
    )
    # An opening row has no time and sorts first; at equal times ticks come before orders.
    in_order = (
        Window.partitionBy("symbol", "bucket")
        .orderBy(F.col("at_ms").asc_nulls_first(), F.col("tick").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("last", F.last("tick", ignorenulls=True).over(in_order))
        .where(F.col("placed").isNotNull())
        .select(
            "placed.*",
            F.col("last.timestamp_ms").alias("tick_ms"),
            F.col("last.price").alias("last_price"),
        )
    )


def _opening_ticks(ticks: DataFrame, orders: DataFrame) -> DataFrame:
    """Per symbol and bucket in use, the last tick of the earlier buckets.

    In two levels: blocks of BLOCK buckets within a symbol, then buckets within a block, so that no
    task holds the buckets of a symbol's whole history.
    """
    buckets = (
        ticks.unionByName(orders, allowMissingColumns=True)
        .groupBy("symbol", "bucket")
        .agg(F.max("tick").alias("closing"))
        .withColumn("block", F.floor(F.col("bucket") / F.lit(BLOCK)))
    )
    blocks = buckets.groupBy("symbol", "block").agg(F.max("closing").alias("closing"))
    opening = blocks.select("symbol", "block", _before("block", "symbol").alias("opening"))
    within = buckets.withColumn("tick", _before("bucket", "symbol", "block"))
    return (
        within.join(opening, ["symbol", "block"])
        .select("symbol", "bucket", F.coalesce("tick", "opening").alias("tick"))
        .where(F.col("tick").isNotNull())
    )


def _before(order: str, *keys: str) -> Column:
    """The closing tick of the nearest earlier row that has one."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.last("closing", ignorenulls=True).over(earlier)
