"""Landing of raw messages and the incremental cleaning and aggregation cycle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tradewatch import schemas
from tradewatch.functions.dedup import keep_latest
from tradewatch.operators import cases, distinct_sets, lake_gold, lake_silver
from tradewatch.session import use_rocksdb_state
from tradewatch.sinks.lake import append_dated, bronze_rows, overwrite_dates, write_version
from tradewatch.sources import lake as source
from tradewatch.sources.messages import malformed_orders, parse_alerts, parse_messages, schema_report
from tradewatch.streaming.detectors import run_available
from tradewatch.streaming.order_state import order_changes

SILVER_ORDER = T.StructType(
    [
        *[
            T.StructField(f.name, {"price": T.DoubleType(), "quantity": T.LongType()}.get(f.name, f.dataType))
            for f in schemas.RAW_ORDER
        ],
        T.StructField("event_at", T.TimestampType()),
        T.StructField("placed_at", T.TimestampType()),
        T.StructField("cancelled_at", T.TimestampType()),
        T.StructField("time_to_cancel_seconds", T.DoubleType()),
        # The cycle that wrote the row, and whether it still holds the order.
        T.StructField("version", T.LongType()),
        T.StructField("live", T.BooleanType()),
    ]
)
# As the table holds it, partitioned by date and version.
SETTLED = T.StructType([*SILVER_ORDER.fields, T.StructField("date", T.StringType())])
SILVER_TRADE = T.StructType(
    [
        T.StructField(f.name, {"price": T.DoubleType(), "quantity": T.LongType()}.get(f.name, f.dataType))
        for f in schemas.RAW_TRADE
    ]
    + [T.StructField("event_at", T.TimestampType())]
)


@dataclass(frozen=True)
class Lake:
    """Folders of one lake below a root that all executors share."""

    root: str
    #: Of the order tables: which complete settlement of the raw lines they belong to.
    generation: int = 0

    def folder(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self.folder("bronze")

    @property
    def checked(self) -> str:
        """Order lines behind the schema guard."""
        return self.folder("checked", "orders")

    def of_orders(self, name: str) -> str:
        """The name of an order table or job in this generation."""
        return f"{name}_g{self.generation}" if self.generation else name

    def silver(self, topic: str) -> str:
        return self.folder("silver", self.of_orders(topic) if topic == "orders" else topic)

    def parts(self, table: str) -> str:
        """Signed parts of an aggregate by date and cycle."""
        return self.folder("parts", self.of_orders(table))

    def folds(self, table: str) -> str:
        """Sums of all parts of a date up to a cycle."""
        return self.folder("folds", self.of_orders(table))

    def gold(self, table: str) -> str:
        return self.folder("gold", table)

    def checkpoint(self, job: str) -> str:
        return self.folder("_checkpoints", job)


def landing_writer(messages: DataFrame, lake: Lake, landed_at: Column | None = None) -> DataStreamWriter:
    """Raw messages to text files per topic, date and hour of landing."""
    return (
        bronze_rows(messages, landed_at)
        .writeStream.format("text")
        .option("path", lake.bronze)
        .option("checkpointLocation", lake.checkpoint("landing"))
        .partitionBy("topic", "date", "hour")
        .outputMode("append")
    )


def current_orders(spark: SparkSession, lake: Lake, dates: list[str] | None = None) -> DataFrame:
    """The settled orders: one row per order, under the date of its latest event.

    Every cycle writes the orders it changed under their date and its number; the row of the last cycle
    counts. An order that moved to another date leaves a row there that is not live. Once many cycles
    have written to a date its rows are merged beside them, and readers see either them or the merged.
    """
    rows = _unfolded(spark, lake.silver("orders"), lake.folds("settled"), SETTLED, dates)
    if rows is None:
        rows = spark.createDataFrame([], SETTLED)
    return _latest_rows(rows).drop("live", "version")


def _latest_rows(rows: DataFrame) -> DataFrame:
    """Of each order on a date the row of the last cycle, unless it ended there."""
    return keep_latest(rows, ["date", "order_id"], [F.col("version")]).where("live").select(*SETTLED.fieldNames())


def current_trades(spark: SparkSession, lake: Lake) -> DataFrame:
    """The latest event of every trade over all cycles."""
    rows = source.read_dated(spark, lake.silver("trades"), SILVER_TRADE)
    return lake_silver.merge_silver_trades(rows)


SCHEMA_PROBLEM = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("problem", T.StringType()),
        T.StructField("lines", T.LongType()),
    ]
)


def schema_guard_writer(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> DataStreamWriter:
    """Compare the fields of each batch of order lines with the declared ones.

    A batch in which a required field has no value at all is skipped: its lines go to a quarantine
    table. Lines of other batches go on to the guarded order cycle. Missing and new fields are reported
    by batch. A batch without lines is let through.
    """

    def cycle(lines: DataFrame, batch_id: int) -> None:
        lines = lines.persist()
        report = schema_report(lines, schemas.RAW_ORDER, lake_silver.ORDER_COLUMNS)
        write_version(report, lake.folder("guard", "report"), batch_id)
        found = source.read_versions(spark, lake.folder("guard", "report"), SCHEMA_PROBLEM)
        missing = found.where((F.col("version") == batch_id) & (F.col("problem") == "missing"))
        kept = missing.isEmpty() or lines.isEmpty()
        folder = lake.checked if kept else lake.folder("quarantine", "skipped")
        write_version(lines, folder, batch_id)
        lines.unpersist()

    return (
        source.bronze_stream(spark, lake.bronze, "orders", max_files)
        .writeStream.foreachBatch(cycle)
        .option("checkpointLocation", lake.checkpoint("guard"))
        .outputMode("append")
    )


FIRST_HOUR = T.StructType([T.StructField("date", T.StringType()), T.StructField("hour", T.StringType())])


def landed_since(spark: SparkSession, lake: Lake, job: str, hours: int) -> Column:
    """Condition on the landing folders: not before the hour that lay so many hours before a job's first run.

    The hour is kept, so that a run after a long pause leaves nothing out.
    """
    folder = lake.folder("first_hours", job)
    kept = source.read_versions(spark, folder, FIRST_HOUR).first()
    if kept is None:
        at = F.current_timestamp() - F.make_interval(hours=F.lit(hours))
        first = spark.range(1).select(
            F.date_format(at, "yyyy-MM-dd").alias("date"), F.date_format(at, "HH").alias("hour")
        )
        write_version(first, folder, 0)
        kept = source.read_versions(spark, folder, FIRST_HOUR).first()
    date, hour = F.col("date"), F.col("hour")
    return (date > kept["date"]) | ((date == kept["date"]) & (hour >= kept["hour"]))


def order_cycle_writer(
    spark: SparkSession,
    lake: Lake,
    max_files: int | None = None,
    guarded: bool = False,
    lookback_hours: int | None = None,
) -> DataStreamWriter:
    """Settle the orders of newly landed lines and renew the aggregates of the dates they touch.

    What is known of an order lies in the stream's state, so a cycle reads its new lines and the parts
    of the dates they touch, never the settled table. The aggregates change by the difference between
    an order's new and old row. Neither depends on how lines fall into cycles, and a repeated cycle
    writes the same rows of the same version again. max_files splits a large backlog into several
    cycles. The state needs the RocksDB provider, which this switches on for the session. guarded: read
    only lines that the schema guard has let through. lookback_hours: of what landed before the first
    run only the last hours; none for all.
    """
    use_rocksdb_state(spark)
    if guarded:
        new_lines = source.checked_stream(spark, lake.checked, max_files)
    else:
        new_lines = source.bronze_stream(spark, lake.bronze, "orders", max_files)
    if lookback_hours is not None:
        new_lines = new_lines.where(landed_since(spark, lake, lake.of_orders("orders"), lookback_hours))

    def cycle(changes: DataFrame, batch_id: int) -> None:
        changes = changes.persist()
        _write_by_date(_settled_rows(changes), lake.silver("orders"), batch_id)
        dates = _write_parts(changes, lake, batch_id)
        changes.unpersist()
        refresh_order_gold(spark, lake, dates)
        if batch_id % FOLD_EVERY == FOLD_EVERY - 1:
            fold_parts(spark, lake, dates, batch_id)

    return (
        order_changes(parse_messages(new_lines, schemas.RAW_ORDER))
        .writeStream.foreachBatch(cycle)
        .option("checkpointLocation", lake.checkpoint(lake.of_orders("orders")))
        .outputMode("update")
    )


def _settled_rows(changes: DataFrame) -> DataFrame:
    """New rows of the changed orders, and an end for the rows they leave behind on other dates."""
    moved = F.col("old.date") != F.col("new.date")
    ended = F.when(moved, F.struct(F.col("old").alias("row"), F.lit(False).alias("live")))
    both = F.array(F.struct(F.col("new").alias("row"), F.lit(True).alias("live")), ended)
    return (
        changes.select("order_id", F.explode(both).alias("one"))
        .where(F.col("one").isNotNull())
        .select("order_id", "one.row.*", "one.live")
    )


class Aggregate(NamedTuple):
    """An aggregate of the orders: its parts, the sum of parts, and the column no row lacks."""

    parts: Callable[[DataFrame], DataFrame]
    added: Callable[[DataFrame], DataFrame]
    key: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]


AGGREGATES = {
    "trader_daily_activity": Aggregate(
        lake_gold.activity_parts,
        lake_gold.activity_of_parts,
        "trader_id",
        ("date", "trader_id", "symbol"),
        lake_gold.ACTIVITY_PARTS,
    ),
    "asset_hourly_summary": Aggregate(
        lake_gold.hourly_parts,
        lake_gold.hourly_of_parts,
        "symbol",
        ("date", "hour", "symbol"),
        lake_gold.HOURLY_PARTS,
    ),
}
FOLD_EVERY = 16  # cycles after which the dates of a cycle are looked at
FOLD_AFTER = 32  # parts of a date that are folded into one


def _write_by_date(parts: DataFrame, root: str, batch_id: int) -> None:
    """Write under date and version; a repeated cycle replaces its own."""
    (
        parts.withColumn("version", F.lit(batch_id))
        .hint("rebalance", "date")
        .write.partitionBy("date", "version")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )


def _write_parts(changes: DataFrame, lake: Lake, batch_id: int) -> list[str]:
    """Write the signed parts of the changed orders under date and version; return the dates."""
    taken = F.when(F.col("old").isNotNull(), F.struct(F.col("old").alias("row"), F.lit(-1).alias("sign")))
    both = F.array(F.struct(F.col("new").alias("row"), F.lit(1).alias("sign")), taken)
    signed = (
        changes.select(F.explode(both).alias("one"))
        .where(F.col("one").isNotNull())
        .select("one.row.*", "one.sign")
    )
    for name, aggregate in AGGREGATES.items():
        _write_by_date(aggregate.parts(signed), lake.parts(name), batch_id)
    # A few calendar days, however many rows.
    return sorted(row["date"] for row in signed.select("date").distinct().collect())


def trade_cycle_writer(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> DataStreamWriter:
    """Clean newly landed trades and append them; current_trades merges repeats across cycles."""

    def cycle(lines: DataFrame, batch_id: int) -> None:
        trades = lake_silver.silver_trades(
            parse_messages(lines, schemas.RAW_TRADE), keep_event_time=True
        )
        append_dated(trades, lake.silver("trades"))

    return (
        source.bronze_stream(spark, lake.bronze, "trades", max_files)
        .writeStream.foreachBatch(cycle)
        .option("checkpointLocation", lake.checkpoint("trades"))
        .outputMode("update")
    )


def alert_cycle_writer(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> DataStreamWriter:
    """Renew the alert summary of every landing date that got new lines."""

    def cycle(lines: DataFrame, batch_id: int) -> None:
        # A few landing dates per cycle.
        for row in lines.select("date").distinct().collect():
            refresh_alert_gold(spark, lake, row["date"])

    return (
        source.bronze_stream(spark, lake.bronze, "alerts", max_files)
        .writeStream.foreachBatch(cycle)
        .option("checkpointLocation", lake.checkpoint("alerts"))
        .outputMode("update")
    )


TRADER_NUMBER = T.StructType(
    [
        T.StructField("trader", T.StringType()),
        T.StructField("lane", T.IntegerType()),
        T.StructField("number", T.LongType()),
    ]
)
ALERT_COUNT = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("alerts", T.LongType()),
    ]
)
TRADER_SET = T.StructType(
    [*ALERT_COUNT.fields[:2], T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType())]
)


def alert_sets_writer(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> DataStreamWriter:
    """Add the alerts of newly landed lines to the counts and trader sets per date and type.

    Sets of a cycle are merged with those of others when they are read, so a cycle touches no earlier
    one; it reads the table of trader numbers only. A repeated cycle replaces what it wrote.
    """

    def cycle(lines: DataFrame, batch_id: int) -> None:
        alerts = parse_alerts(lines).persist()
        known = source.read_versions(spark, lake.folder("sets", "numbers"), TRADER_NUMBER, batch_id)
        fresh = distinct_sets.new_numbers(distinct_sets.involved_traders(alerts), known)
        write_version(fresh, lake.folder("sets", "numbers"), batch_id)
        numbers = source.read_versions(spark, lake.folder("sets", "numbers"), TRADER_NUMBER, batch_id + 1)
        write_version(distinct_sets.trader_sets(alerts, numbers), lake.folder("sets", "traders"), batch_id)
        write_version(distinct_sets.alert_counts(alerts), lake.folder("sets", "counts"), batch_id)
        alerts.unpersist()

    return (
        source.bronze_stream(spark, lake.bronze, "alerts", max_files)
        .writeStream.foreachBatch(cycle)
        .option("checkpointLocation", lake.checkpoint("alert_sets"))
        .outputMode("update")
    )


def alert_key_figures(
    spark: SparkSession, lake: Lake, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Alerts and distinct traders per type, and of all types, of a range of dates."""
    counts = source.read_versions(spark, lake.folder("sets", "counts"), ALERT_COUNT)
    sets = source.read_versions(spark, lake.folder("sets", "traders"), TRADER_SET)
    return distinct_sets.key_figures(counts, sets, first, last)


def case_table_writer(alerts: DataFrame, lake: Lake) -> DataStreamWriter:
    """A case for every alert of a stream, in the case table; a repeated batch replaces its own rows."""

    def cycle(batch: DataFrame, batch_id: int) -> None:
        write_version(cases.alert_case_rows(batch), lake.folder("cases", "detections"), batch_id)

    return (
        alerts.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", lake.checkpoint("cases"))
        .outputMode("append")
    )


def write_reviews(reviews: DataFrame, lake: Lake, version: int) -> None:
    """Record reviews of cases; version: a number of their own for each batch of them."""
    rows = reviews.select(*schemas.CASE_REVIEW.fieldNames())
    write_version(rows, lake.folder("cases", "reviews"), version)


def read_cases(spark: SparkSession, lake: Lake) -> DataFrame:
    """The state of every case."""
    detections = source.read_versions(spark, lake.folder("cases", "detections"), schemas.ALERT_CASE)
    reviews = source.read_versions(spark, lake.folder("cases", "reviews"), schemas.CASE_REVIEW)
    return cases.current_cases(detections, reviews)


def late_orders_writer(
    spark: SparkSession, orders: DataFrame, lake: Lake, delay_sec: int
) -> DataStreamWriter:
    """Keep the orders that come behind the watermark, which the detectors drop without a word.

    As in a query with that delay, the watermark of a batch is the latest time of all earlier batches
    less the delay. The latest time of each batch is kept with its number, so a repeated batch finds
    the same orders late. Orders in time are counted beside them.
    """
    marks = T.StructType(
        [
            T.StructField("latest", T.TimestampType()),
            T.StructField("on_time", T.LongType()),
            T.StructField("late", T.LongType()),
        ]
    )

    def cycle(batch: DataFrame, batch_id: int) -> None:
        known = source.read_versions(spark, lake.folder("late", "marks"), marks, batch_id)
        latest = known.agg(F.max("latest")).first()[0]
        bound = F.lit(latest).cast("timestamp") - F.make_interval(secs=F.lit(delay_sec))
        behind = F.coalesce(F.col("event_time") < bound, F.lit(False))
        write_version(batch.where(behind), lake.folder("late", "rows"), batch_id)
        mark = batch.agg(
            F.max("event_time").alias("latest"),
            F.count_if(~behind).alias("on_time"),
            F.count_if(behind).alias("late"),
        )
        write_version(mark, lake.folder("late", "marks"), batch_id)

    return (
        orders.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", lake.checkpoint("late"))
        .outputMode("append")
    )


def late_orders(spark: SparkSession, lake: Lake, schema: T.StructType) -> DataFrame:
    return source.read_versions(spark, lake.folder("late", "rows"), schema).drop("version")


def quarantine_writer(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> DataStreamWriter:
    """Order lines that no job can use, with the reason, to a side table, each once."""
    lines = source.bronze_stream(spark, lake.bronze, "orders", max_files)
    return (
        malformed_orders(lines)
        .writeStream.format("parquet")
        .option("path", lake.folder("quarantine", "orders"))
        .option("checkpointLocation", lake.checkpoint("quarantine"))
        .outputMode("append")
    )


def read_gold(spark: SparkSession, lake: Lake, table: str, schema: T.StructType) -> DataFrame:
    """An aggregate table of the orders, without the marks of dates that lost all rows."""
    rows = source.read_dated(spark, lake.gold(lake.of_orders(table)), schema)
    return rows.where(F.col(AGGREGATES[table].key).isNotNull())


def _unfolded(
    spark: SparkSession, parts_root: str, folds_root: str, schema: T.StructType, dates: list[str] | None
) -> DataFrame | None:
    """The latest fold of each date and the parts of later cycles."""
    parts = source.read_parts(spark, parts_root, schema, dates)
    folds = source.read_parts(spark, folds_root, schema, dates)
    if parts is None or folds is None:
        return parts
    # A row per calendar day. As a plain condition on the folders' names, folded parts are not read.
    last = folds.groupBy("date").agg(F.max("version").alias("upto")).collect()
    numbers = [F.lit(value) for row in last for value in (row["date"], row["upto"])]
    upto = F.try_element_at(F.create_map(*numbers), F.col("date"))
    version = F.col("version")
    return folds.where(version == upto).unionByName(parts.where(version > F.coalesce(upto, F.lit(-1))))


def _parts_of(spark: SparkSession, lake: Lake, name: str, dates: list[str]) -> DataFrame | None:
    none = spark.createDataFrame([], T.StructType([*SETTLED.fields, T.StructField("sign", T.IntegerType())]))
    schema = AGGREGATES[name].parts(none).schema.add("version", T.LongType())
    return _unfolded(spark, lake.parts(name), lake.folds(name), schema, dates)


def _fold(
    parts: DataFrame | None, root: str, upto: int, merge: Callable[[DataFrame], DataFrame]
) -> None:
    """Merge the parts of the dates that have gathered FOLD_AFTER of them into one."""
    if parts is None:
        return
    many = parts.groupBy("date").agg(F.count_distinct("version").alias("n"))
    # A few calendar days.
    full = [row["date"] for row in many.where(F.col("n") >= FOLD_AFTER).collect()]
    if full:
        _write_by_date(merge(parts.where(F.col("date").isin(full))), root, upto)


def fold_parts(spark: SparkSession, lake: Lake, dates: list[str], upto: int) -> None:
    """Fold the parts and the settled orders of those dates, up to a cycle, where many have gathered.

    A fold is written beside the parts under a number of its own and replaces nothing, so readers see
    either the parts or their sum; what it covers is no longer read. Of settled orders it keeps the
    last row of each and none that ended, in larger files.
    """
    if not dates:
        return
    for name, aggregate in AGGREGATES.items():

        def added(parts: DataFrame, aggregate: Aggregate = aggregate) -> DataFrame:
            sums = [F.try_sum(part).cast(parts.schema[part].dataType).alias(part) for part in aggregate.sums]
            return parts.groupBy(*aggregate.keys).agg(*sums)

        _fold(_parts_of(spark, lake, name, dates), lake.folds(name), upto, added)
    settled = _unfolded(spark, lake.silver("orders"), lake.folds("settled"), SETTLED, dates)
    _fold(settled, lake.folds("settled"), upto, _latest_rows)


def refresh_order_gold(spark: SparkSession, lake: Lake, dates: list[str]) -> None:
    """Renew the order aggregates of some dates from the parts of those dates."""
    if not dates:
        return
    days = spark.createDataFrame([(date,) for date in dates], "date string")
    for name, aggregate in AGGREGATES.items():
        parts = _parts_of(spark, lake, name, dates)
        # Only dates present are replaced, so every date gets a row; the keyless ones are marks.
        rows = days if parts is None else aggregate.added(parts).unionByName(days, allowMissingColumns=True)
        if parts is not None:
            overwrite_dates(rows, lake.gold(lake.of_orders(name)))


def refresh_alert_gold(spark: SparkSession, lake: Lake, date: str) -> None:
    """Alert summary of one landing date, straight from the raw alerts."""
    alerts = parse_alerts(source.read_bronze(spark, lake.bronze, "alerts", date))
    summary = lake_gold.alert_summary(alerts).withColumn("date", F.lit(date))
    overwrite_dates(summary, lake.gold("alert_summary"))


def rebuild_orders(spark: SparkSession, lake: Lake, max_files: int | None = None) -> Lake:
    """Settle all raw lines anew, as the next generation of the order tables, and return that lake.

    For a changed cleaning rule, or a lost checkpoint. The tables of the present generation stay as they
    are; readers and the cycle go on with the returned lake once it is complete. An interrupted rebuild
    goes on where it stopped when it is run again.
    """
    anew = replace(lake, generation=lake.generation + 1)
    run_available(order_cycle_writer(spark, anew, max_files))
    return anew
