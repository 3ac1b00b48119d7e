import json
import os
import random
from pathlib import Path
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.operators import lake_gold, lake_silver
from tradewatch.operators.alerts import all_alerts, conform
from tradewatch.sinks.lake import append_dated, bronze_rows, overwrite_dates, write_bronze
from tradewatch.sources.lake import read_bronze, read_dated
from tradewatch.sources.messages import parse_messages, parse_orders
from tradewatch.streaming import detectors
from tradewatch.streaming import lake as lake_job
from tradewatch.streaming.lake import (
    Lake,
    landing_writer,
    alert_key_figures,
    alert_sets_writer,
    late_orders_writer,
    order_cycle_writer,
    schema_guard_writer,
    current_orders,
    quarantine_writer,
    read_gold,
    rebuild_orders,
    refresh_alert_gold,
    trade_cycle_writer,
)

START = datetime(2024, 1, 1, 21, 30, 0)
NUMBER = iter(range(10**9))


def order(trader, status, at, side="buy", **extra):
    row = {
        "event_type": "order", "order_id": f"o{next(NUMBER)}", "trader_id": trader,
        "trader_type": "normal", "symbol": "AAPL", "side": side, "price": 100.0, "quantity": 100,
        "status": status, "timestamp": (START + timedelta(seconds=at)).isoformat() + "+00:00",
    }
    return {**row, **extra}


class Feed:
    """A folder of JSON lines files, each read as one micro-batch in order of writing."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, folder, 0
        folder.mkdir()

    def add(self, *events):
        path = self.folder / f"part-{self.count:03d}.json"
        path.write_text("".join(json.dumps(e) + "\n" for e in events))
        stamp = 1_700_000_000 + self.count
        os.utime(path, (stamp, stamp))
        self.count += 1

    def stream(self):
        lines = self.spark.readStream.option("maxFilesPerTrigger", 1).text(str(self.folder))
        return parse_orders(lines)

    def batch(self):
        return parse_orders(self.spark.read.text(str(self.folder)))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def run(spark, rows, folder):
    detectors.run_available(
        detectors.parquet_writer(rows, str(folder / "rows"), str(folder / "checkpoint"))
    )
    return spark.read.schema(rows.schema).parquet(str(folder / "rows"))


def spoof_burst(at=0, count=12, trader="s"):
    return [order(trader, "CANCELLED", at + i) for i in range(count)]


def wash_burst(at=0):
    buys = [order("A", "FILLED", at + s, "buy") for s in (0, 10, 20)]
    return buys + [order("B", "FILLED", at + s + 1, "sell") for s in (0, 10, 20)]


def key(row):
    return str(row)


def test_stream_equals_batch(spark, feed, tmp_path):
    feed.add(*spoof_burst(10), *wash_burst(60))
    feed.add(*spoof_burst(400), *wash_burst(620))
    closing = order("z", "NEW", 7200)
    feed.add(closing)
    clock = F.col("window_end")
    streamed = run(spark, detectors.spoofing_stream(feed.stream(), detected_at=clock), tmp_path / "s")
    washed = run(spark, detectors.wash_stream(feed.stream(), detected_at=clock), tmp_path / "w")
    batch = all_alerts(feed.batch(), detected_at=clock)
    assert sorted(streamed.unionByName(washed).collect(), key=key) == sorted(batch.collect(), key=key)
    assert washed.count() == 2 and {r.match_count for r in washed.collect()} == {9}


def test_orders_that_do_not_qualify_advance_the_watermark(spark, feed, tmp_path):
    feed.add(*wash_burst(), *spoof_burst())
    feed.add(order("z", "NEW", 7200))
    assert run(spark, detectors.wash_stream(feed.stream()), tmp_path / "w").count() == 1
    assert run(spark, detectors.spoofing_stream(feed.stream()), tmp_path / "s").count() == 4


def test_open_windows_stay_silent(spark, feed, tmp_path):
    feed.add(*wash_burst(), *spoof_burst())
    assert run(spark, detectors.wash_stream(feed.stream()), tmp_path / "w").count() == 0


def test_late_orders_do_not_reopen_a_window(spark, feed, tmp_path):
    feed.add(*spoof_burst(count=1))
    feed.add(order("z", "NEW", 7200))
    feed.add(order("z", "NEW", 7201))
    feed.add(*spoof_burst(count=12))
    feed.add(*spoof_burst(7260, count=12))
    feed.add(order("z", "NEW", 14400))
    found = run(spark, detectors.spoofing_stream(feed.stream()), tmp_path / "s").collect()
    assert len(found) == 4
    assert min(r.window_start for r in found) > START + timedelta(seconds=7000)


def test_restart_emits_nothing_twice(spark, feed, tmp_path):
    feed.add(*spoof_burst())
    feed.add(order("z", "NEW", 7200))
    for expected in (4, 4):
        found = run(spark, detectors.spoofing_stream(feed.stream()), tmp_path / "s")
        assert found.count() == expected
    feed.add(*spoof_burst(10_000))
    feed.add(order("z", "NEW", 20_000))
    assert run(spark, detectors.spoofing_stream(feed.stream()), tmp_path / "s").count() == 8


def test_bad_messages_do_not_stop_the_stream(spark, feed, tmp_path):
    feed.add(*spoof_burst())
    (feed.folder / "part-900.json").write_text('{bad json\n{"timestamp":"garbage"}\n')
    feed.add(order("z", "NEW", 7200))
    assert run(spark, detectors.spoofing_stream(feed.stream()), tmp_path / "s").count() == 4


def messages(spark, topic, *events):
    rows = [(topic, json.dumps(e) if isinstance(e, dict) else e) for e in events]
    return spark.createDataFrame(rows, "topic string, value string")


def land(spark, lake, topic, *events):
    write_bronze(bronze_rows(messages(spark, topic, *events)), lake.bronze)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def gold(spark, lake, table, schema):
    return sorted(read_gold(spark, lake, table, schema).collect(), key=key)


def expected_activity(spark, lake):
    lines = read_bronze(spark, lake.bronze, "orders")
    return lake_gold.trader_daily_activity(
        lake_silver.silver_orders(parse_messages(lines, schemas.RAW_ORDER))
    )


def test_order_over_two_cycles_is_settled_in_gold(spark, lake):
    land(spark, lake, "orders", order("t", "NEW", 0, order_id="1"), order("t", "NEW", 0, order_id="2"))
    detectors.run_available(order_cycle_writer(spark, lake))
    land(spark, lake, "orders", order("t", "CANCELLED", 4, order_id="1"), "{bad")
    detectors.run_available(order_cycle_writer(spark, lake))
    wanted = expected_activity(spark, lake)
    (row,) = gold(spark, lake, "trader_daily_activity", wanted.schema)
    assert (row.total_orders, row.total_cancels, row.avg_time_to_cancel) == (2, 1, 4.0)
    assert row.asDict() == wanted.first().asDict()


MIDNIGHT = 9_000  # seconds from START to the next day


def history(seed):
    """Events of orders over two midnights, with fractions, repeats, late ones and bad lines."""
    rng = random.Random(seed)
    events = []
    for n in range(12):
        first = rng.choice([0, MIDNIGHT - 2, MIDNIGHT - 0.5, MIDNIGHT + 86_399.5])
        events.append(order("t", "NEW", first, order_id=str(n)))
        for status in rng.sample(["CANCELLED", "FILLED", "NEW"], rng.randint(0, 3)):
            events.append(order("t", status, first + rng.choice([0.1, 0.9, 4, 86_400]), order_id=str(n)))
    rng.shuffle(events)
    poison = [
        order("t", "NEW", 0, order_id="big", quantity="1e30", price="1e300"),
        order("t", "NEW", 0, order_id="clock", timestamp="12:30"),
    ]
    return [events[:9], ["{bad", "also bad"], events[9:14] + events[:2], poison, events[14:], poison[1:]]


@pytest.mark.parametrize("max_files", [1, 3, None])
def test_cycles_of_any_size_give_the_same_tables(spark, lake, max_files):
    for step, part in enumerate(history(4)):
        land(spark, lake, "orders", *part)
        if step in (1, 3, 5):
            detectors.run_available(order_cycle_writer(spark, lake, max_files))
    lines = parse_messages(read_bronze(spark, lake.bronze, "orders"), schemas.RAW_ORDER)
    orders = lake_silver.silver_orders(lines)
    for table, build in (
        ("trader_daily_activity", lake_gold.trader_daily_activity),
        ("asset_hourly_summary", lake_gold.asset_hourly_summary),
    ):
        wanted = build(orders)
        found = gold(spark, lake, table, wanted.schema)
        plain = lambda rows: sorted(str(sorted(r.asDict().items())) for r in rows)
        assert plain(found) == plain(wanted.collect())
    settled = current_orders(spark, lake).select(*orders.columns)
    assert sorted(map(str, settled.collect())) == sorted(map(str, orders.collect()))


def test_a_cycle_reads_nothing_of_the_settled_table(spark, lake):
    """Its cost follows the new lines: the table of earlier cycles need not even be readable."""
    parts = history(7)
    land(spark, lake, "orders", *parts[0])
    detectors.run_available(order_cycle_writer(spark, lake))
    for folder, _, files in list(os.walk(lake.silver("orders"))):
        for name in files:
            if name.startswith("part-"):
                with open(f"{folder}/{name}", "wb") as out:
                    out.write(b"no longer Parquet")
    for part in parts[2:]:
        land(spark, lake, "orders", *part)
        detectors.run_available(order_cycle_writer(spark, lake))
    wanted = expected_activity(spark, lake)
    found = gold(spark, lake, "trader_daily_activity", wanted.schema)
    plain = lambda rows: sorted(str(sorted(r.asDict().items())) for r in rows)
    assert plain(found) == plain(wanted.collect())


def test_parts_taken_back_leave_nothing(spark):
    ddl = "order_id string, date string, timestamp string, trader_id string, symbol string, status string, price double, quantity bigint, time_to_cancel_seconds double"
    rng = random.Random(3)
    rows = [
        (
            str(i), "2024-01-01", f"2024-01-01T{rng.randrange(3):02d}:00:00Z", rng.choice(["a", "b", None]), "S",
            rng.choice(["filled", "cancelled", None]), rng.choice([0.01, 19.99, 123_456.78, None, 9e15]),
            rng.choice([0, 7, 10**18]), rng.choice([None, 0.1, 86_400.000001]),
        )
        for i in range(60)
    ]
    orders = spark.createDataFrame(rows, ddl)
    gone = spark.createDataFrame([(*r[:-2], r[-2] * 3, 5.5) for r in rows[:40]], ddl)
    signed = orders.withColumn("sign", F.lit(1)).unionByName(gone.withColumn("sign", F.lit(1)))
    back = gone.withColumn("sign", F.lit(-1))
    for parts, added, whole in (
        (lake_gold.activity_parts, lake_gold.activity_of_parts, lake_gold.trader_daily_activity),
        (lake_gold.hourly_parts, lake_gold.hourly_of_parts, lake_gold.asset_hourly_summary),
    ):
        found = added(parts(signed).unionByName(parts(back))).collect()
        small = added(parts(orders.withColumn("sign", F.lit(1)))).collect()
        assert sorted(map(str, found)) == sorted(map(str, small))
        keys = [c for c in whole(orders).columns if c not in ("price_volatility", "avg_price", "total_volume")]
        pick = lambda rows: sorted(str([r[k] for k in keys]) for r in rows)
        assert pick(found) == pick(whole(orders).collect())


def test_repeated_cycle_changes_nothing(spark, lake):
    for part in history(5):
        land(spark, lake, "orders", *part)
    detectors.run_available(order_cycle_writer(spark, lake, 2))
    before = sorted(map(str, current_orders(spark, lake).collect()))
    # Without its last commit a stream runs the last batch again.
    commits = f"{lake.checkpoint('orders')}/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    os.rename(f"{commits}/{last}", f"{lake.root}/commit-{last}")
    os.rename(f"{commits}/.{last}.crc", f"{lake.root}/commit-{last}.crc")
    detectors.run_available(order_cycle_writer(spark, lake, 2))
    assert last in os.listdir(commits)
    assert sorted(map(str, current_orders(spark, lake).collect())) == before


def test_quarantine_keeps_each_bad_line_once(spark, lake):
    for part in history(6):
        land(spark, lake, "orders", *part)
        detectors.run_available(quarantine_writer(spark, lake))
    rows = spark.read.parquet(lake.folder("quarantine", "orders")).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in rows} == {"unparsable message": 2, "unparsable event time": 2}


def test_cycle_leaves_other_dates_alone(spark, lake):
    land(spark, lake, "orders", order("t", "NEW", 0))
    detectors.run_available(order_cycle_writer(spark, lake))
    folder = lake.gold("trader_daily_activity")
    before = sorted(os.listdir(f"{folder}/date=2024-01-01"))
    land(spark, lake, "orders", order("t", "NEW", 86_400))
    detectors.run_available(order_cycle_writer(spark, lake))
    assert sorted(os.listdir(f"{folder}/date=2024-01-01")) == before
    assert os.path.isdir(f"{folder}/date=2024-01-02")


def test_rebuild_settles_orders_over_dates(spark, lake):
    land(spark, lake, "orders", order("t", "NEW", 0, order_id="1"))
    detectors.run_available(order_cycle_writer(spark, lake))
    land(spark, lake, "orders", order("t", "CANCELLED", 86_400, order_id="1"))
    detectors.run_available(order_cycle_writer(spark, lake))
    rebuild_orders(spark, lake)
    wanted = expected_activity(spark, lake)
    (row,) = gold(spark, lake, "trader_daily_activity", wanted.schema)
    assert row.asDict() == wanted.first().asDict() and row.avg_time_to_cancel == 86_400.0


def test_trade_cycle_appends_clean_trades(spark, lake):
    trade = {"event_type": "trade", "trade_id": "1", "buy_trader_id": "a", "sell_trader_id": "b", "symbol": "S", "price": 1.005, "quantity": 3, "timestamp": "2024-01-01T10:00:00+00:00"}
    land(spark, lake, "trades", trade, trade, {**trade, "trade_id": None})
    detectors.run_available(trade_cycle_writer(spark, lake))
    assert spark.read.parquet(lake.silver("trades")).count() == 1


def test_alert_gold_of_a_date(spark, lake):
    alert = {"alert_type": "SPOOFING", "trader_id": "s", "symbol": "S", "cancel_rate": 0.9}
    land(spark, lake, "alerts", alert, alert, "{bad")
    (date,) = [r.date for r in read_bronze(spark, lake.bronze, "alerts").select("date").distinct().collect()]
    refresh_alert_gold(spark, lake, date)
    row = spark.read.parquet(lake.gold("alert_summary")).first()
    assert (row.total_alerts, row.unique_traders_flagged, row.avg_cancel_rate) == (2, 1, 0.9)


def test_landing_keeps_lines_verbatim_under_topic_date_and_hour(spark, lake, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text('{"a": 1}\n{bad\n')
    lines = spark.readStream.text(str(source)).withColumn("topic", F.lit("orders"))
    at = F.lit("2024-01-01 05:10:00").cast("timestamp")
    detectors.run_available(landing_writer(lines, lake, at))
    assert os.path.isdir(f"{lake.bronze}/topic=orders/date=2024-01-01/hour=05")
    rows = read_bronze(spark, lake.bronze, "orders", "2024-01-01").collect()
    assert sorted(r.value for r in rows) == ['{"a": 1}', "{bad"]
    assert rows[0].hour == "05"


def test_modified_after_reads_new_files_only(spark, lake):
    land(spark, lake, "orders", order("t", "NEW", 0))
    assert read_bronze(spark, lake.bronze, modified_after=datetime(2000, 1, 1)).count() == 1
    assert read_bronze(spark, lake.bronze, modified_after=datetime(2999, 1, 1)).count() == 0


def test_absent_table_reads_empty(spark, lake):
    assert read_dated(spark, lake.gold("none"), schemas.ORDER, ["2024-01-01"]).count() == 0


def test_dates_without_rows_are_untouched(spark, tmp_path):
    path = str(tmp_path / "gold")
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, n int")
    append_dated(rows, path)
    overwrite_dates(rows.where("n = 2").withColumn("n", F.lit(3)), path)
    overwrite_dates(rows.where("n > 99"), path)
    found = read_dated(spark, path, rows.schema).collect()
    assert sorted((r.date, r.n) for r in found) == [("2024-01-01", 1), ("2024-01-02", 3)]


def test_conformed_stream_schema_is_the_alert_schema(feed):
    feed.add(order("t", "NEW", 0))
    for rows in (detectors.spoofing_stream(feed.stream()), detectors.wash_stream(feed.stream())):
        assert rows.schema.fieldNames() == schemas.ALERT.fieldNames()
        assert conform(rows).isStreaming


def test_late_rows_and_those_on_time_are_all_rows(spark, feed, lake):
    feed.add(*spoof_burst(count=3))
    feed.add(order("z", "NEW", 7200))
    feed.add(*spoof_burst(count=4), order("y", "FILLED", 7198), order("x", "FILLED", 0, timestamp="garbage"))
    orders = feed.stream()
    for _ in range(2):
        detectors.run_available(late_orders_writer(spark, orders, lake, 5))
    late = spark.read.parquet(lake.folder("late", "rows"))
    marks = spark.read.parquet(lake.folder("late", "marks")).agg(F.sum("late"), F.sum("on_time")).first()
    assert late.count() == 4 and tuple(marks) == (4, spark.read.schema(orders.schema).json(str(feed.folder)).count() - 4)


def test_dropped_rows_are_counted(spark, feed, tmp_path):
    feed.add(*spoof_burst(count=1))
    feed.add(order("z", "NEW", 7200))
    feed.add(order("z", "NEW", 7201))
    feed.add(*spoof_burst(count=12))
    found = detectors.spoofing_stream(feed.stream())
    writer = detectors.parquet_writer(found, str(tmp_path / "out"), str(tmp_path / "check"))
    assert detectors.dropped_rows(detectors.run_available(writer)) > 0


def test_sets_of_traders_equal_distinct_counts(spark, lake):
    rng = random.Random(1)

    def alert(day):
        kind = rng.choice(["SPOOFING", "WASH_TRADING"])
        who = [f"t{rng.randrange(400)}" for _ in range(3)]
        named = {"trader_id": who[0]} if kind == "SPOOFING" else {"trader_id_1": who[1], "trader_id_2": rng.choice([who[2], None])}
        return {"alert_type": kind, "symbol": "S", "detected_at": f"2024-01-{day:02d}T10:00:00", **named}

    alerts = [alert(rng.randint(1, 4)) for _ in range(600)]
    for part in (alerts[:200], alerts[200:210], alerts[210:]):
        land(spark, lake, "alerts", *part)
        detectors.run_available(alert_sets_writer(spark, lake))
    numbers = spark.read.parquet(lake.folder("sets", "numbers"))
    assert numbers.select("number").distinct().count() == numbers.count()
    for first, last in ((None, None), ("2024-01-02", "2024-01-03"), ("2025-01-01", None)):
        chosen = [a for a in alerts if (first or "") <= a["detected_at"][:10] <= (last or "9")]
        wanted = {}
        for kind in {a["alert_type"] for a in chosen} | ({"ALL"} if chosen else set()):
            some = [a for a in chosen if kind in ("ALL", a["alert_type"])]
            who = {a.get(k) for a in some for k in ("trader_id", "trader_id_1", "trader_id_2")} - {None}
            wanted[kind] = (len(some), len(who))
        found = alert_key_figures(spark, lake, first, last).collect()
        assert {r.alert_type: (r.total_alerts, r.unique_traders) for r in found} == wanted
    # A repeated cycle replaces what it wrote.
    before = sorted(map(str, alert_key_figures(spark, lake).collect()))
    for folder in (f"{lake.checkpoint('alert_sets')}/commits",):
        last = max((n for n in os.listdir(folder) if n.isdigit()), key=int)
        os.rename(f"{folder}/{last}", f"{lake.root}/set-commit-{last}")
        os.rename(f"{folder}/.{last}.crc", f"{lake.root}/set-commit-{last}.crc")
    detectors.run_available(alert_sets_writer(spark, lake))
    assert sorted(map(str, alert_key_figures(spark, lake).collect())) == before


def test_guarded_cycle_skips_a_batch_without_a_required_field(spark, lake):
    good, late = order("t", "NEW", 0, order_id="1"), order("t", "CANCELLED", 4, order_id="1", extra="x")
    without = {k: v for k, v in order("t", "NEW", 9, order_id="2").items() if k != "price"}
    for part in ([good, "{bad"], [without], [late]):
        land(spark, lake, "orders", *part)
        detectors.run_available(schema_guard_writer(spark, lake))
        detectors.run_available(order_cycle_writer(spark, lake, guarded=True))
    (row,) = current_orders(spark, lake).collect()
    assert (row.order_id, row.status, row.price) == ("1", "cancelled", 100.0)
    report = spark.read.parquet(lake.folder("guard", "report")).collect()
    assert sorted((r.version, r.field, r.problem, r.lines) for r in report) == [(1, "price", "missing", 0), (2, "extra", "new", 1)]
    assert spark.read.parquet(lake.folder("quarantine", "skipped")).count() == 1


def test_folded_parts_are_no_longer_read(spark, lake, monkeypatch):
    monkeypatch.setattr(lake_job, "FOLD_EVERY", 2)
    monkeypatch.setattr(lake_job, "FOLD_AFTER", 2)
    parts = history(8)
    for part in (parts[0], parts[2]):
        land(spark, lake, "orders", *part)
        detectors.run_available(order_cycle_writer(spark, lake))
    sources = {**{table: lake.parts(table) for table in lake_job.AGGREGATES}, "settled": lake.silver("orders")}
    for table, folder in sources.items():
        dates = [d.name for d in Path(lake.folds(table)).iterdir() if d.name.startswith("date=")]
        assert dates
        for date in dates:
            for file in Path(folder, date).rglob("part-*"):
                file.write_bytes(b"no longer Parquet")
    land(spark, lake, "orders", *parts[4])
    detectors.run_available(order_cycle_writer(spark, lake))
    wanted = expected_activity(spark, lake)
    found = gold(spark, lake, "trader_daily_activity", wanted.schema)
    plain = lambda rows: sorted(str(sorted(r.asDict().items())) for r in rows)
    assert plain(found) == plain(wanted.collect())
    orders = lake_silver.silver_orders(parse_messages(read_bronze(spark, lake.bronze, "orders"), schemas.RAW_ORDER))
    assert plain(current_orders(spark, lake).select(*orders.columns).collect()) == plain(orders.collect())


def test_first_cycle_looks_back_some_hours_and_a_later_one_leaves_nothing_out(spark, lake):
    def land_hours_ago(hours, order_id):
        value = json.dumps(order("t", "NEW", 0, order_id=order_id))
        rows = spark.createDataFrame([("orders", value)], "topic string, value string")
        write_bronze(bronze_rows(rows, F.current_timestamp() - F.make_interval(hours=F.lit(hours))), lake.bronze)

    for hours, order_id in ((60, "before"), (23, "within"), (0, "now")):
        land_hours_ago(hours, order_id)
    detectors.run_available(order_cycle_writer(spark, lake, lookback_hours=24))
    assert sorted(r.order_id for r in current_orders(spark, lake).collect()) == ["now", "within"]
    # A shorter look back on a later run: the hour of the first run stays.
    land_hours_ago(20, "between")
    detectors.run_available(order_cycle_writer(spark, lake, lookback_hours=1))
    assert sorted(r.order_id for r in current_orders(spark, lake).collect()) == ["between", "now", "within"]


def test_wash_stream_keeps_legs_not_matches(spark, feed):
    feed.add(*wash_burst())
    plan = detectors.wash_stream(feed.stream())._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan and plan.count("Aggregate [") == 1
