"""Feeds derived from the given tables.

Each derivation is row-local wherever it can be, so it runs unchanged on a stream of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.functions import times

# The traded symbols.
STOCKS = ("AAPL", "TSLA", "JPM", "MSFT", "GOOGL")
CRYPTO = ("BINANCE:BTCUSDT", "BINANCE:ETHUSDT", "BINANCE:XRPUSDT")
SYMBOLS = STOCKS + CRYPTO

EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream takes a folder or a pattern; the braces let the table be either file or folder.
    return spark.readStream.schema(EVENTS_DDL).parquet(f"{sf_dir}/{{events.parquet}}")


def symbol_at(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), (index + 1).cast("int"))


def trader_role(number: Column) -> Column:
    kind = number % 10
    return F.when(kind == 0, "spoofer").when(kind.isin(1, 2), "wash_trader").otherwise("normal")


def trader_name(number: Column) -> Column:
    kind = number % 10
    prefix = F.when(kind == 0, "spoofer_").when(kind.isin(1, 2), "wash_").otherwise("normal_")
    return F.concat(prefix, F.lpad(number.cast("string"), 5, "0"))


def order_feed(events: DataFrame) -> DataFrame:
    """A NEW order per event, followed by its cancel or fill where it has one."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    role = F.col("trader_type")
    normal = role == "normal"
    drift = (event_id * 37) % 101 - 50
    base = (
        events.withColumn("trader_type", trader_role(user_id))
        .withColumn(
            "_sidx",
            F.when(normal, (event_id * 31 + user_id) % 8).otherwise(F.expr("(user_id div 10) % 8")),
        )
        .withColumn("_placed", F.date_trunc("second", F.col("ts").cast("timestamp")))
    )
    terminal = (
        F.when(role == "spoofer", F.when(event_id % 10 != 3, "CANCELLED").otherwise("FILLED"))
        .when(role == "wash_trader", "FILLED")
        .when(F.col("event_type") == "error", "CANCELLED")
        .when(F.col("event_type") == "signup", F.lit(None))
        .otherwise("FILLED")
    )
    delay = (
        F.when(role == "spoofer", 1 + event_id % 3)
        .when(role == "wash_trader", F.lit(1))
        .otherwise(10 + event_id % 110)
    )
    done_at = F.timestamp_seconds(F.unix_seconds("_placed") + delay)
    lifecycle = F.array(
        F.struct(F.lit("NEW").alias("status"), F.col("_placed").alias("event_time")),
        F.struct(terminal.alias("status"), done_at.alias("event_time")),
    )
    return (
        base.select(
            event_id.cast("string").alias("order_id"),
            trader_name(user_id).alias("trader_id"),
            "trader_type",
            symbol_at(F.col("_sidx")).alias("symbol"),
            F.when(event_id % 2 == 0, "buy").otherwise("sell").alias("side"),
            (((F.col("_sidx") + 1) * (drift + 10000)).cast("double") / F.lit(100.0)).alias("price"),
            F.when(role == "spoofer", 2000 + event_id % 500)
            .when(role == "wash_trader", 300 + event_id % 40)
            .otherwise(50 + event_id % 400)
            .cast("int")
            .alias("quantity"),
            F.inline(lifecycle).alias("status", "event_time"),
        )
        .where(F.col("status").isNotNull())
    )


def raw_order_feed(events: DataFrame) -> DataFrame:
    """The order feed as JSON messages with planted repeats, broken lines and bad fields.

    Bad fields are text for numbers, numbers too large for any whole type, and times without a date.
    """
    number = F.col("order_id").cast("bigint")
    terminal = F.col("status") != "NEW"
    stamp = (
        F.when(number % 103 == 0, "garbage")
        .when(number % 137 == 0, "12:30")
        .otherwise(times.iso_micros(F.col("event_time")))
    )

    def message(price: Column, quantity: Column) -> Column:
        return F.to_json(
            F.struct(
                F.lit("order").alias("event_type"), "order_id", "trader_id", "trader_type",
                "symbol", "side", price.alias("price"), quantity.alias("quantity"), "status",
                stamp.alias("timestamp"),
            )
        )

    price, quantity = F.col("price"), F.col("quantity")
    text = (
        F.when(number % 107 == 0, message(F.lit("notnum"), quantity))
        .when(number % 109 == 0, message(price, F.lit("abc")))
        .when(number % 113 == 0, message(price, F.concat(quantity.cast("string"), F.lit(".9"))))
        .when(number % 127 == 0, message(price, F.lit("1e30")))
        .when(number % 131 == 0, message(F.lit("1e300"), quantity))
        .otherwise(message(price, quantity))
    )
    lines = F.array(
        text,
        F.when((number % 97 == 0) & terminal, text),
        F.when((number % 101 == 0) & ~terminal, F.lit("{bad json")),
    )
    messages = order_feed(events).select(
        F.lit("orders").alias("topic"), F.explode(lines).alias("value")
    )
    return messages.where(F.col("value").isNotNull())


def tick_feed(events: DataFrame) -> DataFrame:
    """One tick per view or click."""
    return events.where(F.col("event_type").isin("view", "click")).select(
        symbol_at((F.col("event_id") * 31 + F.col("user_id")) % 8).alias("s"),
        F.col("value").alias("p"),
        (F.col("event_id") % 1000).cast("double").alias("v"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("t"),
        F.when(F.col("event_id") % 5 != 0, F.array((F.col("event_id") % 4).cast("string"))).alias("c"),
    )


def market_ticks(events: DataFrame) -> DataFrame:
    """The same ticks under their normalised names."""
    return tick_feed(events).select(
        F.col("s").alias("symbol"), F.col("p").alias("price"), F.col("v").alias("volume"),
        F.col("t").alias("timestamp_ms"),
    )


def tick_messages(events: DataFrame) -> DataFrame:
    """A message per tick, holding up to two more prints after it; every seventh is a ping."""
    prints = F.transform(
        F.sequence(F.lit(0), (F.col("n") % 3).cast("int")),
        lambda k: F.struct(
            F.col("s").alias("s"),
            (F.col("p") + k).alias("p"),
            F.col("v").alias("v"),
            (F.col("t") + k).alias("t"),
            F.col("c").alias("c"),
        ),
    )
    kind = F.when(F.col("n") % 7 == 0, "ping").otherwise("trade")
    return (
        tick_feed(events)
        .withColumn("n", F.col("v").cast("bigint"))
        .select(F.to_json(F.struct(kind.alias("type"), prints.alias("data"))).alias("value"))
    )


def trade_feed(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One trade per order line. Trade ids repeat, as line numbers do within an order."""
    seller = F.when(F.col("l_suppkey") % 10 == 9, "market").otherwise(trader_name(F.col("l_suppkey")))
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.lit("trade").alias("event_type"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("trade_id"),
        trader_name(F.col("o_custkey")).alias("buy_trader_id"),
        seller.alias("sell_trader_id"),
        symbol_at(F.col("l_partkey") % 8).alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("timestamp"),
    )


def trader_profiles(customer: DataFrame) -> DataFrame:
    balance = F.col("c_acctbal")
    return customer.select(
        trader_name(F.col("c_custkey")).alias("trader_id"),
        F.col("c_name").alias("trader_name"),
        F.lower("c_mktsegment").alias("trader_type"),
        F.when(balance < 0, "elevated").otherwise("normal").alias("risk_rating"),
    )
