import math
import random

import pytest
from pyspark.sql import functions as F

from tradewatch.operators import lake_gold, lake_silver
from tradewatch.sinks.lake import bronze_rows, write_bronze
from tradewatch.sources.lake import read_bronze

RAW_DDL = (
    "order_id string, trader_id string, trader_type string, symbol string, side string, "
    "price string, quantity string, status string, timestamp string"
)


@pytest.fixture
def raw(spark):
    def build(*events):
        rows = []
        for event in events:
            row = {
                "order_id": "o1", "trader_id": "t1", "trader_type": "Normal", "symbol": "AAPL",
                "side": "buy", "price": "10.005", "quantity": "5", "status": "NEW",
                "timestamp": "2024-01-01T10:00:00+00:00", **event,
            }
            rows.append(tuple(row.values()))
        return spark.createDataFrame(rows, RAW_DDL)

    return build


def test_missing_column_is_refused(raw):
    with pytest.raises(lake_silver.MissingColumns, match="status"):
        lake_silver.silver_orders(raw({}).drop("status"))


def test_numbers_beyond_any_whole_type_count_as_bad_text(raw):
    rows = raw({"quantity": "1e30", "price": "1e300"}, {"order_id": "o2"}, {"order_id": "o3", "timestamp": "12:30"})
    silver = lake_silver.silver_orders(rows)
    found = {r.order_id: (r.price, r.quantity) for r in silver.collect()}
    assert found == {"o1": (None, 0), "o2": (10.01, 5)}
    (hour,) = lake_gold.asset_hourly_summary(silver).collect()
    assert (hour.avg_price, hour.total_volume, hour.total_orders) == (10.01, 5, 2)


def test_sums_beyond_a_long_are_null(raw):
    rows = raw(*[{"order_id": str(i), "quantity": "9e18"} for i in range(3)])
    (hour,) = lake_gold.asset_hourly_summary(lake_silver.silver_orders(rows)).collect()
    assert hour.total_volume is None and hour.total_orders == 3


def test_quantity_coercion(raw):
    rows = raw(*[{"order_id": str(i), "quantity": q} for i, q in enumerate(["abc", "7.9", None, "12"])])
    found = {r.order_id: r.quantity for r in lake_silver.silver_orders(rows).collect()}
    assert found == {"0": 0, "1": 7, "2": 0, "3": 12}


def test_price_rounds_half_to_even_by_scale(raw):
    rows = raw(*[{"order_id": str(i), "price": p} for i, p in enumerate(["1.125", "1.135", "x", "1e2"])])
    found = {r.order_id: r.price for r in lake_silver.silver_orders(rows).collect()}
    assert found == {"0": 1.12, "1": round(round(113.5) / 100, 2), "2": None, "3": 100.0}


def test_status_and_type_words(raw):
    words = ["NEW", "CANCELLED", "FILLED", "REJECTED", None]
    rows = raw(*[{"order_id": str(i), "status": s} for i, s in enumerate(words)])
    found = {r.order_id: (r.status, r.trader_type) for r in lake_silver.silver_orders(rows).collect()}
    expected = ["placed", "cancelled", "filled", "rejected", None]
    assert found == {str(i): (s, "normal") for i, s in enumerate(expected)}


def test_latest_event_and_time_to_cancel(raw):
    rows = raw({}, {"status": "CANCELLED", "timestamp": "2024-01-01T10:00:03.500+00:00"})
    (row,) = lake_silver.silver_orders(rows).collect()
    assert (row.status, row.time_to_cancel_seconds) == ("cancelled", 3.5)
    assert (row.timestamp, row.date) == ("2024-01-01T10:00:03Z", "2024-01-01")


def test_cancel_before_placement_counts_zero(raw):
    rows = raw({}, {"status": "CANCELLED", "timestamp": "2024-01-01T09:59:00+00:00"})
    (row,) = lake_silver.silver_orders(rows).collect()
    assert (row.status, row.time_to_cancel_seconds) == ("placed", 0.0)


def test_end_of_life_wins_equal_times(raw):
    (row,) = lake_silver.silver_orders(raw({"status": "FILLED"}, {})).collect()
    assert row.status == "filled" and row.time_to_cancel_seconds is None


def test_offset_is_applied_to_clean_time(raw):
    (row,) = lake_silver.silver_orders(raw({"timestamp": "2024-01-01T23:30:00-05:00"})).collect()
    assert (row.timestamp, row.date) == ("2024-01-02T04:30:00Z", "2024-01-02")


def test_unusable_rows_are_dropped(raw):
    rows = raw({"timestamp": "garbage"}, {"order_id": None})
    assert lake_silver.silver_orders(rows).collect() == []


def test_merge_is_the_same_as_one_batch_and_repeats_change_nothing(raw, spark):
    rng = random.Random(5)
    events = [
        {
            "order_id": f"o{rng.randrange(30)}", "status": rng.choice(["NEW", "CANCELLED", "FILLED"]),
            "timestamp": f"2024-01-01T10:{rng.randrange(60):02d}:{rng.randrange(60):02d}+00:00",
        }
        for _ in range(200)
    ]
    whole = lake_silver.silver_orders(raw(*events), keep_lifecycle=True)
    parts = [
        lake_silver.silver_orders(raw(*part), keep_lifecycle=True)
        for part in (events[:70], events[70:150], events[70:150], events[150:])
    ]
    appended = parts[0]
    for part in parts[1:]:
        appended = appended.unionByName(part)
    merged = lake_silver.merge_silver_orders(appended).select(*whole.columns)
    assert sorted(merged.collect(), key=str) == sorted(whole.collect(), key=str)


def test_hot_order_id_folds_before_the_shuffle(raw):
    rows = raw({"status": "NEW"}).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("n")
    silver = lake_silver.silver_orders(rows.unionByName(raw({"order_id": "o2"})))
    assert silver.count() == 2
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_trades_keep_the_latest(spark):
    ddl = "trade_id string, buy_trader_id string, sell_trader_id string, symbol string, price double, quantity int, timestamp string"
    rows = [
        ("1", "a", "b", "S", 1.0, 1, "2024-01-01T10:00:00+00:00"),
        ("1", "a", "b", "S", 2.0, 2, "2024-01-01T11:00:00+00:00"),
        ("2", "a", "market", "S", 3.0, 3, "2024-01-01T09:00:00+00:00"),
    ]
    found = lake_silver.silver_trades(spark.createDataFrame(rows, ddl)).collect()
    assert sorted((r.trade_id, r.price, r.quantity) for r in found) == [("1", 2.0, 2), ("2", 3.0, 3)]


def test_daily_activity(raw):
    rows = raw(
        {"order_id": "1", "quantity": "10"},
        {"order_id": "1", "quantity": "10", "status": "CANCELLED", "timestamp": "2024-01-01T10:00:04+00:00"},
        {"order_id": "2", "quantity": "15", "status": "FILLED"},
        {"order_id": "3", "quantity": "15"},
        {"order_id": "4", "trader_id": None},
    )
    (row,) = lake_gold.trader_daily_activity(lake_silver.silver_orders(rows)).collect()
    assert (row.total_orders, row.total_cancels, row.total_trades) == (3, 1, 1)
    assert (row.avg_order_size, row.avg_time_to_cancel, row.cancel_rate) == (13.33, 4.0, 0.3333)


def test_hourly_summary(raw):
    rows = raw(
        {"order_id": "1", "price": "10.00"},
        {"order_id": "2", "price": "11.00", "status": "FILLED"},
        {"order_id": "3", "price": "9.00", "timestamp": "2024-01-01T11:00:00+00:00"},
    )
    found = {r.hour: r for r in lake_gold.asset_hourly_summary(lake_silver.silver_orders(rows)).collect()}
    assert (found[10].avg_price, found[10].price_volatility) == (10.5, round(math.sqrt(0.5), 4))
    assert (found[10].total_volume, found[10].total_orders, found[10].total_trades) == (10, 2, 1)
    assert found[11].price_volatility is None


def test_alert_summary_counts_an_alert_once(spark):
    ddl = "alert_type string, trader_id string, trader_id_1 string, trader_id_2 string, cancel_rate double"
    rows = [
        ("WASH_TRADING", None, "a", "b", None), ("WASH_TRADING", None, "a", "c", None),
        ("SPOOFING", "s", None, None, 0.9), ("SPOOFING", "s", None, None, 1.0),
        ("SPOOFING", None, None, None, None),
    ]
    found = {r.alert_type: r for r in lake_gold.alert_summary(spark.createDataFrame(rows, ddl)).collect()}
    assert tuple(found["WASH_TRADING"])[1:] == (2, 3, None)
    assert tuple(found["SPOOFING"])[1:] == (3, 1, 0.95)


def test_merged_trades_keep_one_row_per_trade(spark):
    ddl = "trade_id string, price double, quantity bigint, timestamp string, at string"
    at = "2024-01-01T10:00:00"
    rows = [("1", 1.0, 1, f"{at}Z", f"{at}.1"), ("1", 2.0, 2, f"{at}Z", f"{at}.9"), ("1", 1.0, 1, f"{at}Z", f"{at}.1")]
    timed = spark.createDataFrame(rows, ddl).withColumn("event_at", F.col("at").cast("timestamp"))
    (kept,) = lake_silver.merge_silver_trades(timed.drop("at")).collect()
    assert (kept.price, kept.quantity) == (2.0, 2)


def test_raw_lines_are_compressed_and_read_back(spark, tmp_path):
    lines = spark.range(2000).select(F.format_string('{"trade_id": "%d"}', "id").alias("value"), F.lit("trades").alias("topic"))
    write_bronze(bronze_rows(lines.coalesce(1)), str(tmp_path))
    (part,) = tmp_path.rglob("part-*")
    assert part.stat().st_size < 20_000
    assert read_bronze(spark, str(tmp_path), "trades").select("value").distinct().count() == 2000
