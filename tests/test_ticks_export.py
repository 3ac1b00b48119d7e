import json
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.functions.traders import trader_type_from_id
from tradewatch.operators import export, ticks
from tradewatch.params import ExportParams

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def test_flatten_and_route(spark):
    messages = [
        {"type": "trade", "data": [{"s": "AAPL", "p": 1.5, "v": 2, "t": 1704067200000, "c": ["1"]},
                                   {"s": "BINANCE:BTCUSDT", "p": 2.5, "v": 1, "t": 1704067200123}]},
        {"type": "ping"}, {"type": "trade", "data": []}, {"type": "news", "data": [{"s": "X"}]},
    ]
    raw = spark.createDataFrame([(json.dumps(m),) for m in messages] + [("{bad",)], "value string")
    rows = ticks.route_ticks(ticks.flatten_ticks(raw)).orderBy("price").collect()
    assert [(r.symbol, r.topic, r.conditions) for r in rows] == [
        ("AAPL", "market-data-stocks", ["1"]), ("BINANCE:BTCUSDT", "market-data-crypto", []),
    ]
    assert [r.timestamp_iso for r in rows] == [
        "2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00.123000+00:00",
    ]
    assert set(schemas.MARKET_TICK.fieldNames()) <= set(rows[0].asDict())


def test_latest_tick_skips_empty_ticks(spark):
    rows = [("A", 1.0, 10), ("A", 2.0, 20), ("A", 0.0, 30), ("A", None, 40), ("", 5.0, 50), (None, 5.0, 60)]
    df = spark.createDataFrame(rows, "symbol string, price double, timestamp_ms bigint")
    assert [tuple(r) for r in ticks.latest_tick_per_symbol(df).collect()] == [("A", 20, 2.0)]


def test_orders_meet_the_last_tick_across_buckets(spark):
    rng = random.Random(3)
    # One symbol holds most rows; long gaps leave whole buckets without ticks.
    symbols = ["HOT"] * 8 + ["A", "B"]
    quotes = [(rng.choice(symbols), float(i + 1), rng.choice([0, 50_000]) + rng.randrange(9_000)) for i in range(300)]
    orders = [(f"o{i}", rng.choice(symbols), EPOCH + timedelta(milliseconds=rng.randrange(70) * 1000)) for i in range(300)]
    tick_df = spark.createDataFrame(quotes, "symbol string, price double, timestamp_ms bigint")
    order_df = spark.createDataFrame(orders, "order_id string, symbol string, event_time timestamp")

    def expected(symbol, at_ms):
        known = [(t, p) for s, p, t in quotes if s == symbol and t <= at_ms]
        return max(known) if known else (None, None)

    for bucket_ms in (1_000, 7_000, 10**9):
        rows = ticks.order_vs_last_tick(order_df, tick_df, bucket_ms).collect()
        found = {r.order_id: (r.tick_ms, r.last_price) for r in rows}
        assert len(rows) == len(orders)
        for order_id, symbol, at in orders:
            assert found[order_id] == expected(symbol, (at - EPOCH) // timedelta(milliseconds=1))


def test_trader_type_from_id(spark):
    ids = ["spoofer_001", "wash_001a", "x9", "", "market", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    found = [r[0] for r in df.select(trader_type_from_id(F.col("id"))).collect()]
    assert found == ["spoofer", "wash_trader", "normal", "market", "market", "market"]


def trades(spark, count):
    rows = [(str(i), "a", "market", "S", 1.0 + i, i, f"2024-01-01T00:00:{i:02d}+00:00") for i in range(count)]
    ddl = "trade_id string, buy_trader_id string, sell_trader_id string, symbol string, price double, quantity int, timestamp string"
    return spark.createDataFrame(rows, ddl)


def test_legs(spark):
    rows = export.trade_legs(trades(spark, 1)).collect()
    assert [(r.side, r.trader_id, r.trader_type, r.order_id) for r in rows] == [
        ("buy", "a", "normal", ""), ("sell", "market", "market", ""),
    ]


def test_leg_limit_may_cut_a_trade_in_two(spark):
    rows = export.latest_trade_legs_sample(trades(spark, 9), ExportParams(leg_limit=5)).collect()
    assert sorted((r.trade_id, r.side) for r in rows) == [
        ("6", "buy"), ("7", "buy"), ("7", "sell"), ("8", "buy"), ("8", "sell"),
    ]


def test_balanced_sample_takes_the_newest_of_each_type(spark):
    rows = []
    for kind, count in (("SPOOFING", 6), ("WASH_TRADING", 1)):
        for i in range(count):
            at = datetime(2024, 1, 1, 0, i)
            row = {"alert_type": kind, "symbol": "S", "window_start": at, "detected_at": at}
            rows.append(tuple(row.get(f.name) for f in schemas.ALERT))
    alerts = spark.createDataFrame(rows, schemas.ALERT)
    found = export.balanced_alert_sample(alerts, ExportParams(alert_limit=4)).collect()
    assert sorted((r.alert_type, r.detected_at.minute) for r in found) == [
        ("SPOOFING", 4), ("SPOOFING", 5), ("WASH_TRADING", 0),
    ]
