"""From raw JSON messages to typed rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch import schemas
from tradewatch.functions import times


def _as_text(schema: T.StructType) -> T.StructType:
    """The same fields with scalars as text, so that 12.5 and "12.5" are read alike."""
    return T.StructType(
        [
            f if isinstance(f.dataType, T.ArrayType) else T.StructField(f.name, T.StringType())
            for f in schema
        ]
    )


def _fields(raw: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """The message's fields as text columns.

    The parse sits in a generator, so it runs once per message; as a plain expression it would
    be repeated by every filter and projection that is pushed down onto it.
    """
    message = F.from_json("value", _as_text(schema), {"mode": "PERMISSIVE"})
    return raw.select(*keep, F.inline(F.array(message)))


def _readable(schema: T.StructType) -> Column:
    """False for text that is not a JSON object; one bad field does not make it unreadable."""
    return reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in schema.fieldNames()])


def _typed(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.ArrayType)):
        return F.col(field.name)
    return F.col(field.name).try_cast(field.dataType).alias(field.name)


def parse_messages(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of every readable message; unreadable ones are skipped, bad fields are NULL."""
    return _fields(raw, schema).where(_readable(schema)).select(*[_typed(f) for f in schema])


def with_event_time(orders: DataFrame) -> DataFrame:
    return orders.withColumn("event_time", times.event_time(F.col("timestamp")))


def parse_orders(raw: DataFrame) -> DataFrame:
    """Order events with their event time, as the detectors read them."""
    return with_event_time(parse_messages(raw, schemas.ORDER))


def parse_alerts(raw: DataFrame) -> DataFrame:
    return parse_messages(raw, schemas.ALERT)


def malformed_orders(raw: DataFrame) -> DataFrame:
    """Messages the detectors cannot use, with the reason; the quarantine side of parse_orders."""
    reason = F.when(~_readable(schemas.ORDER), "unparsable message").when(
        times.event_time(F.col("timestamp")).isNull(), "unparsable event time"
    )
    return (
        _fields(raw, schemas.ORDER, *raw.columns)
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select(*raw.columns, "reason")
    )


def discovered_fields(raw: DataFrame) -> DataFrame:
    """field and lines: the names that the messages carry, and in how many lines each has a value.

    Names are folded in each task before they are shuffled; lines that are no JSON object have none.
    """
    pairs = F.explode(F.from_json("value", "map<string,string>")).alias("field", "text")
    return (
        raw.select(pairs)
        .where(F.col("text").isNotNull())
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def schema_report(raw: DataFrame, schema: T.StructType, required: Iterable[str]) -> DataFrame:
    """field, problem (missing or new) and lines of a batch whose fields differ from the declared ones.

    A required field is missing if no line has a value for it; a batch without any readable line lacks
    them all.
    """
    spark = raw.sparkSession
    declared = [(f.name, f.name in set(required)) for f in schema]
    known = spark.createDataFrame(declared, "field string, required boolean")
    joined = known.join(discovered_fields(raw), "field", "full")
    problem = F.when(F.col("required").isNull(), "new").when(
        F.col("required") & F.col("lines").isNull(), "missing"
    )
    return joined.select(
        "field", problem.alias("problem"), F.coalesce("lines", F.lit(0)).alias("lines")
    ).where(F.col("problem").isNotNull())
