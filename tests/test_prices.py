"""Orders of a stream against the last tick, and the batch result on the same rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tradewatch.operators.ticks import order_vs_last_tick
from tradewatch.streaming.detectors import run_available
from tradewatch.streaming.lake import Lake
from tradewatch.streaming.prices import late_orders, priced_orders, priced_orders_writer

ORDER = "order_id string, symbol string, event_time timestamp"
TICK = "symbol string, price double, timestamp_ms bigint"
DELAY = 5


class Streams:
    """Two folders; what is added between two runs makes one batch."""

    def __init__(self, spark, root):
        self.spark, self.lake = spark, Lake(str(root / "lake"))
        self.folders = [str(root / "orders"), str(root / "ticks")]
        self.added = [[], []]
        for folder in self.folders:
            os.makedirs(folder)

    def add(self, orders=(), ticks=()):
        timed = [(i, s, None if at is None else at) for i, s, at in orders]
        frames = [
            self.spark.createDataFrame(timed, "order_id string, symbol string, sec double").select(
                "order_id", "symbol", F.timestamp_millis((F.col("sec") * 1000).cast("long")).alias("event_time")
            ),
            self.spark.createDataFrame([(s, float(p), int(at * 1000)) for s, p, at in ticks], TICK),
        ]
        for place, (frame, folder, rows) in enumerate(zip(frames, self.folders, (orders, ticks))):
            if rows:
                frame.coalesce(1).write.mode("append").parquet(folder)
            self.added[place] += list(rows)

    def run(self):
        orders = self.spark.readStream.schema(ORDER).parquet(self.folders[0])
        ticks = self.spark.readStream.schema(TICK).parquet(self.folders[1])
        run_available(priced_orders_writer(self.spark, orders, ticks, self.lake, DELAY, bucket_ms=10_000))

    def found(self):
        schema = self.spark.createDataFrame([], ORDER).schema
        return {r.order_id: (r.tick_ms, r.last_price) for r in priced_orders(self.spark, self.lake, schema).collect()}


@pytest.fixture
def streams(spark, tmp_path):
    return Streams(spark, tmp_path)


def by_hand(orders, ticks, before):
    """Last tick at or before each order that the watermark has passed."""
    wanted = {}
    for order_id, symbol, at in orders:
        if at < before:
            earlier = [(t, p) for s, p, t in ticks if s == symbol and t <= at and p != 0]
            last = max(earlier, default=None)
            wanted[order_id] = (int(last[0] * 1000), float(last[1])) if last else (None, None)
    return wanted


def test_stream_equals_batch_and_hand(spark, streams):
    rng = random.Random(5)
    moments = sorted(rng.uniform(0, 400) for _ in range(240))
    number = iter(range(1000))
    for start in range(0, 240, 60):
        orders, ticks = [], []
        for at in moments[start : start + 60]:
            # Times in whole eighths so that ticks and orders also meet exactly; "b" starts late.
            at = round(at * 8) / 8 - rng.choice([0, 0, 1])
            symbol = rng.choice("aaab" if at > 200 else "aac")
            if rng.random() < 0.5:
                orders.append((f"o{next(number)}", symbol, at))
            else:
                ticks.append((symbol, rng.choice([0, 1, 2, 3.5]), at))
        streams.add(orders, ticks)
        streams.run()
    orders, ticks = streams.added
    mark = min(max(o[2] for o in orders), max(t[2] for t in ticks)) - DELAY
    found = streams.found()
    assert found == by_hand(orders, ticks, mark) and len(found) > 80
    placed = spark.read.schema(ORDER).parquet(streams.folders[0]).where(
        F.unix_millis("event_time") < int(mark * 1000)
    )
    whole = order_vs_last_tick(placed, spark.read.schema(TICK).parquet(streams.folders[1]), 10_000)
    assert {r.order_id: (r.tick_ms, r.last_price) for r in whole.collect()} == found


def test_order_waits_for_the_ticks(streams):
    streams.add([("o1", "a", 10.0)], [("a", 1, 1.0)])
    streams.run()
    assert streams.found() == {}
    streams.add([], [("a", 2, 9.0), ("a", 3, 11.0)])
    streams.run()
    # The latest order bounds the watermark too.
    assert streams.found() == {}
    streams.add([("o2", "b", 30.0)], [("a", 4, 31.0)])
    streams.run()
    assert streams.found() == {"o1": (9000, 2.0)}


def test_last_price_outlives_batches_and_a_missing_one_is_null(streams):
    streams.add([("o0", "z", 1.0)], [("a", 7, 1.0)])
    streams.run()
    for n, at in enumerate((100.0, 1000.0, 100_000.0), start=1):
        streams.add([(f"o{n}", "a", at), (f"y{n}", "z", at)], [("other", 1, at)])
        streams.run()
    assert streams.found() == {
        "o0": (None, None), "o1": (1000, 7.0), "y1": (None, None), "o2": (1000, 7.0), "y2": (None, None),
    }


def test_late_rows_are_kept_aside(spark, streams):
    streams.add([("o1", "a", 100.0)], [("a", 1, 100.0)])
    streams.run()
    streams.add([("late", "a", 50.0), ("o2", "a", 98.0), ("o3", "a", 200.0)], [("a", 9, 60.0), ("a", 2, 200.0)])
    streams.run()
    assert streams.found() == {"o2": (None, None), "o1": (100_000, 1.0)}
    schema = spark.createDataFrame([], ORDER).schema
    assert [r.order_id for r in late_orders(spark, streams.lake, schema).collect()] == ["late"]
    late_ticks = spark.read.parquet(streams.lake.folder("prices", "late_ticks"))
    assert [(r.symbol, r.price) for r in late_ticks.collect()] == [("a", 9.0)]


def test_orders_without_time_leave_at_once(streams):
    streams.add([("o1", "a", None), ("o2", None, 5.0)], [("a", 1, 1.0)])
    streams.run()
    assert streams.found() == {"o1": (None, None)}


def test_state_files_do_not_gather_and_a_repeated_batch_changes_nothing(streams):
    for n in range(4):
        streams.add([(f"o{n}", "a", 20.0 * n)], [("a", n + 1, 20.0 * n)])
        streams.run()
    before = streams.found()
    assert sorted(os.listdir(streams.lake.folder("prices", "waiting"))) == ["slot=0", "slot=1"]
    # Without its last commit a stream runs the last batch again.
    commits = f"{streams.lake.checkpoint('prices')}/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    os.rename(f"{commits}/{last}", f"{streams.lake.root}/commit-{last}")
    os.rename(f"{commits}/.{last}.crc", f"{streams.lake.root}/commit-{last}.crc")
    streams.run()
    assert last in os.listdir(commits) and streams.found() == before
