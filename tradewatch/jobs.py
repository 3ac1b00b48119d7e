"""Command-line jobs.

python -m tradewatch.jobs spoofing --servers HOST:PORT --checkpoint DIR
python -m tradewatch.jobs landing --servers HOST:PORT --lake DIR
python -m tradewatch.jobs orders --lake DIR

Detectors and landing read topics, or with --folder text files of JSON lines. They run until
stopped, or with --once over what is there. Thresholds come from the environment (see params).
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tradewatch import schemas
from tradewatch.operators import export
from tradewatch.operators.alerts import alert_messages, alerts_since
from tradewatch.operators.ticks import CRYPTO_TOPIC, STOCK_TOPIC
from tradewatch.params import ExportParams, LakeParams, SpoofingParams, WashParams
from tradewatch.session import build_session, use_rocksdb_state
from tradewatch.sinks.lake import write_csv
from tradewatch.sinks.messages import case_writer, topic_writer
from tradewatch.sources import kafka
from tradewatch.sources.lake import bronze_stream, read_bronze
from tradewatch.sources.messages import parse_alerts, parse_messages, parse_orders
from tradewatch.streaming import catalog, detectors, lake, places, prices


def _source(spark: SparkSession, args: argparse.Namespace, topics: Sequence[str]) -> DataFrame:
    if args.servers:
        return kafka.topic_stream(spark, args.servers, topics)
    if len(topics) > 1:
        raise SystemExit("a folder holds the lines of one topic: name it with --topics")
    lines = spark.readStream.text(args.folder)
    return lines.withColumn("topic", F.lit(topics[0]))


def _alert_writer(alerts: DataFrame, args: argparse.Namespace) -> DataStreamWriter:
    messages = alert_messages(alerts)
    if args.servers:
        return topic_writer(messages, args.servers, args.checkpoint)
    return (
        messages.select("value")
        .writeStream.format("text")
        .option("path", args.out)
        .option("checkpointLocation", args.checkpoint)
        .outputMode("append")
    )


def _run(writer: DataStreamWriter, args: argparse.Namespace, every_sec: int | None = None) -> None:
    if args.once:
        detectors.run_available(writer)
        return
    if every_sec:
        writer = writer.trigger(processingTime=f"{every_sec} seconds")
    writer.start().awaitTermination()


def spoofing(spark: SparkSession, args: argparse.Namespace) -> None:
    orders = parse_orders(_source(spark, args, ["orders"]))
    _run(_alert_writer(detectors.spoofing_stream(orders, SpoofingParams.from_env()), args), args)


def wash(spark: SparkSession, args: argparse.Namespace) -> None:
    orders = parse_orders(_source(spark, args, ["orders"]))
    _run(_alert_writer(detectors.wash_stream(orders, WashParams.from_env()), args), args)


def landing(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = _source(spark, args, args.topics.split(","))
    writer = lake.landing_writer(messages, lake.Lake(args.lake))
    _run(writer, args, LakeParams.from_env().landing_sec)


def orders(spark: SparkSession, args: argparse.Namespace) -> None:
    params = LakeParams.from_env()
    target = lake.Lake(args.lake, args.generation)
    writer = lake.order_cycle_writer(spark, target, args.max_files, lookback_hours=params.lookback_hours)
    _run(writer, args, params.cycle_sec)


def order_index(spark: SparkSession, args: argparse.Namespace) -> None:
    """The index of settled orders by id; run it after the orders job."""
    writer = places.places_writer(spark, lake.Lake(args.lake, args.generation), args.max_files)
    _run(writer, args, LakeParams.from_env().cycle_sec)


def trades(spark: SparkSession, args: argparse.Namespace) -> None:
    writer = lake.trade_cycle_writer(spark, lake.Lake(args.lake), args.max_files)
    _run(writer, args, LakeParams.from_env().cycle_sec)


def priced_orders(spark: SparkSession, args: argparse.Namespace) -> None:
    """Landed orders with the last landed tick before each."""
    target = lake.Lake(args.lake)

    def topic(name: str) -> DataFrame:
        return bronze_stream(spark, target.bronze, name, args.max_files)

    stocks, crypto = (parse_messages(topic(name), schemas.MARKET_TICK) for name in (STOCK_TOPIC, CRYPTO_TOPIC))
    delay_sec = SpoofingParams.from_env().watermark_sec
    writer = prices.priced_orders_writer(
        spark, parse_orders(topic("orders")), stocks.unionByName(crypto), target, delay_sec
    )
    _run(writer, args, LakeParams.from_env().cycle_sec)


def alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    writer = lake.alert_cycle_writer(spark, lake.Lake(args.lake), args.max_files)
    _run(writer, args, LakeParams.from_env().cycle_sec)


def quarantine(spark: SparkSession, args: argparse.Namespace) -> None:
    writer = lake.quarantine_writer(spark, lake.Lake(args.lake), args.max_files)
    _run(writer, args, LakeParams.from_env().cycle_sec)


def alert_gold(spark: SparkSession, args: argparse.Namespace) -> None:
    lake.refresh_alert_gold(spark, lake.Lake(args.lake), args.date)


def rebuild(spark: SparkSession, args: argparse.Namespace) -> None:
    """Settle all raw lines anew beside the present order tables and name the new generation."""
    anew = lake.rebuild_orders(spark, lake.Lake(args.lake, args.generation), args.max_files)
    print(f"order tables rebuilt; go on with --generation {anew.generation}")


def case_store(spark: SparkSession, args: argparse.Namespace) -> None:
    """A case in the database at --url for every alert of the stream."""
    alerts = parse_alerts(_source(spark, args, ["alerts"]))
    _run(case_writer(alerts, args.url, args.checkpoint), args)


def recent_alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    """The alerts that the broker received since --date, as CSV."""
    since = datetime.fromisoformat(args.date).replace(tzinfo=timezone.utc)
    alerts = parse_alerts(kafka.topic_since(spark, args.servers, ["alerts"], since))
    found = alerts_since(alerts, F.lit(args.date).cast("timestamp"))
    write_csv(found.select(*schemas.ALERT_CSV.fieldNames()), args.out)


def snapshots(spark: SparkSession, args: argparse.Namespace) -> None:
    """Alerts, orders and trade legs of the raw lake as CSV; with --limit the newest of each."""
    bronze = lake.Lake(args.lake).bronze

    params = ExportParams(args.limit, args.limit, args.limit)

    def topic(name: str) -> DataFrame:
        return read_bronze(spark, bronze, name)

    catalog.write_snapshots(
        args.out,
        alerts=export.balanced_alert_sample(parse_alerts(topic("alerts")), params),
        orders=export.latest_orders_sample(parse_messages(topic("orders"), schemas.ORDER), params),
        trades=export.latest_trade_legs_sample(parse_messages(topic("trades"), schemas.TRADE), params),
    )


def rebuild_catalog(spark: SparkSession, args: argparse.Namespace) -> None:
    catalog.rebuild_catalog(spark, args.folder, args.prefix, args.location, args.format)


JOBS = {
    "spoofing": spoofing,
    "wash": wash,
    "landing": landing,
    "orders": orders,
    "order-index": order_index,
    "trades": trades,
    "priced-orders": priced_orders,
    "alerts": alerts,
    "quarantine": quarantine,
    "alert-gold": alert_gold,
    "rebuild": rebuild,
    "case-store": case_store,
    "recent-alerts": recent_alerts,
    "snapshots": snapshots,
    "catalog": rebuild_catalog,
}


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradewatch.jobs")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topics", default=",".join(kafka.TOPICS), help="topics to land")
    parser.add_argument("--folder", help="input folder instead of topics")
    parser.add_argument("--out", help="output folder")
    parser.add_argument("--checkpoint", help="checkpoint folder of a detector")
    parser.add_argument("--lake", help="root folder of the lake")
    parser.add_argument("--generation", type=int, default=0, help="of the order tables, by rebuilds")
    parser.add_argument("--max-files", type=int, help="raw files per cycle")
    parser.add_argument("--url", help="JDBC address of the case store")
    parser.add_argument("--limit", type=int, help="rows per snapshot")
    parser.add_argument("--date", help="landing date, yyyy-MM-dd")
    parser.add_argument("--prefix", default="", help="prefix of the layer schemas")
    parser.add_argument("--location", help="folder of the layer schemas")
    parser.add_argument("--format", default="parquet", help="table format")
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments(argv)
    if spark is None:
        spark = build_session(f"tradewatch-{args.job}")
        use_rocksdb_state(spark)
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
