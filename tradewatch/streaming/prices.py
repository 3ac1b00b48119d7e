"""Orders of a stream with the last price of their symbol.

An order waits until the ticks have passed its time. What waits, and the last price of each symbol
before the watermark, is the state between batches; a batch reads that and its own rows, whatever came
before. The as-of join is the batch one, in time buckets, so a symbol with a third of all ticks is
spread over tasks; state keyed by symbol would put it into one.

The watermark is the earlier of the latest order and the latest tick, less a delay. Rows behind the
watermark of the batch before are late: they are kept aside and change no result. Orders without a time
have no price and leave at once. Orders still waiting when the input ends stay silent.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tradewatch.operators.ticks import latest_tick_per_symbol, order_vs_last_tick, valid_ticks
from tradewatch.sinks.lake import write_version
from tradewatch.sources import lake as source
from tradewatch.streaming.lake import Lake

SLOTS = 2  # a batch reads the state of the one before and writes beside it


class Heard(NamedTuple):
    """Latest times of both inputs, in milliseconds."""

    order_ms: int | None = None
    tick_ms: int | None = None

    def later(self, other: Heard) -> Heard:
        return Heard(*[max((x for x in pair if x is not None), default=None) for pair in zip(self, other)])

    def watermark(self, delay_ms: int) -> int | None:
        return None if None in self else min(self) - delay_ms


HEARD = T.StructType([T.StructField(name, T.LongType()) for name in Heard._fields])


def _behind(mark: int | None) -> Column:
    return F.coalesce(F.col("at_ms") < F.lit(mark).cast("long"), F.lit(False))


def _write_slot(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Replace the state of the batch before the last one; files do not gather."""
    numbered = rows.withColumn("version", F.lit(batch_id).cast("long"))
    numbered.write.mode("overwrite").parquet(f"{folder}/slot={batch_id % SLOTS}")


def _read_slot(spark: SparkSession, folder: str, schema: T.StructType, batch_id: int) -> DataFrame:
    rows = source.read_versions(spark, f"{folder}/slot={batch_id % SLOTS}", schema)
    return rows.where(F.col("version") == batch_id).drop("version")


def priced_orders_writer(
    spark: SparkSession,
    orders: DataFrame,
    ticks: DataFrame,
    lake: Lake,
    delay_sec: int,
    bucket_ms: int = 300_000,
) -> DataStreamWriter:
    """`order_vs_last_tick` on streams of orders and ticks; a repeated batch writes the same again."""
    delay_ms = delay_sec * 1000
    order_rows = orders.select(
        "symbol", F.unix_millis("event_time").alias("at_ms"), F.struct(*orders.columns).alias("placed")
    )
    tick_rows = (
        valid_ticks(ticks)
        .where(F.col("timestamp_ms").isNotNull())
        .select("symbol", F.col("timestamp_ms").alias("at_ms"), F.struct("timestamp_ms", "price").alias("tick"))
    )
    both = order_rows.unionByName(tick_rows, allowMissingColumns=True)
    is_order, is_tick = F.col("placed").isNotNull(), F.col("tick").isNotNull()

    def folder(name: str) -> str:
        return lake.folder("prices", name)

    def cycle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        row = _read_slot(spark, folder("heard"), HEARD, batch_id - 1).first()
        known = Heard(*row) if row else Heard()
        latest = [F.max(F.when(which, F.col("at_ms"))) for which in (is_order, is_tick)]
        heard = known.later(Heard(*batch.agg(*latest).first()))

        late = _behind(known.watermark(delay_ms))
        write_version(batch.where(late & is_order).select("placed.*"), folder("late_orders"), batch_id)
        write_version(batch.where(late & is_tick).select("symbol", "tick.*"), folder("late_ticks"), batch_id)

        waiting = _read_slot(spark, folder("waiting"), both.schema, batch_id - 1)
        rows = batch.where(~late).unionByName(waiting)
        passed = F.col("at_ms").isNull() | _behind(heard.watermark(delay_ms))
        ready = rows.where(passed)
        quotes = ready.where(is_tick).select("symbol", "tick.*")
        priced = order_vs_last_tick(ready.where(is_order).select("placed.*"), quotes, bucket_ms)
        write_version(priced, folder("orders"), batch_id)

        last = latest_tick_per_symbol(quotes).select(
            "symbol", F.col("timestamp_ms").alias("at_ms"), F.struct("timestamp_ms", "price").alias("tick")
        )
        kept = rows.where(~passed).unionByName(last, allowMissingColumns=True)
        _write_slot(kept, folder("waiting"), batch_id)
        _write_slot(spark.createDataFrame([heard], HEARD), folder("heard"), batch_id)
        batch.unpersist()

    return (
        both.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", lake.checkpoint("prices"))
        .outputMode("append")
    )


def priced_orders(spark: SparkSession, lake: Lake, orders: T.StructType) -> DataFrame:
    """The orders priced so far; orders: their schema without a price."""
    added = [T.StructField("tick_ms", T.LongType()), T.StructField("last_price", T.DoubleType())]
    schema = T.StructType([*orders.fields, *added])
    return source.read_versions(spark, lake.folder("prices", "orders"), schema).drop("version")


def late_orders(spark: SparkSession, lake: Lake, orders: T.StructType) -> DataFrame:
    """Orders that came behind the watermark and got no price."""
    return source.read_versions(spark, lake.folder("prices", "late_orders"), orders).drop("version")
