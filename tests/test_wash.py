import random
from collections import defaultdict
from datetime import timedelta

import numpy as np
import pyarrow as pa
from conftest import ORDER_DDL, START
from pyspark.sql import functions as F

from tradewatch.operators import wash, wash_pairs
from tradewatch.operators.wash import wash_alerts, wash_digest, wash_first_pairs, wash_matches
from tradewatch.params import WashParams

# START lies in the tumbling window 21:30-21:35, which ends 60 seconds later.


def leg(trader, side, at, **extra):
    return (trader, "FILLED", at, {"side": side, **extra})


def alerts(orders, params=WashParams()):
    return wash_alerts(orders, params, F.col("window_end")).collect()


def matches(orders, params=WashParams()):
    return wash_matches(orders, params).count()


def test_all_combinations_count(make_orders):
    events = [leg("A", "buy", s) for s in (0, 10, 20)] + [leg("B", "sell", s + 1) for s in (0, 10, 20)]
    (found,) = alerts(make_orders(*events))
    assert (found.trader_id_1, found.trader_id_2, found.match_count) == ("A", "B", 9)
    assert found.avg_price_diff_pct == 0.0


def test_two_matches_are_too_few(make_orders):
    assert alerts(make_orders(leg("A", "buy", 0), leg("A", "buy", 1), leg("B", "sell", 2))) == []


def test_gap_is_inclusive_both_ways(make_orders):
    assert matches(make_orders(leg("A", "buy", 0), leg("B", "sell", 30))) == 1
    assert matches(make_orders(leg("A", "buy", 0), leg("B", "sell", 31))) == 0
    assert matches(make_orders(leg("A", "buy", 30), leg("B", "sell", 0))) == 1
    assert matches(make_orders(leg("A", "buy", 31), leg("B", "sell", 0))) == 0


def test_pair_across_a_window_boundary_is_missed(make_orders):
    assert matches(make_orders(leg("A", "buy", 59), leg("B", "sell", 60))) == 0


def test_price_tolerance(make_orders):
    for price, expected in ((100.5, 1), (100.51, 0), (99.51, 1), (99.49, 0)):
        orders = make_orders(leg("A", "buy", 0), leg("B", "sell", 1, price=price))
        assert matches(orders) == expected, price


def test_quantity_tolerance(make_orders):
    for quantity, expected in ((110, 1), (111, 0), (91, 1), (90, 0)):
        orders = make_orders(leg("A", "buy", 0), leg("B", "sell", 1, quantity=quantity))
        assert matches(orders) == expected, quantity


def test_same_trader_does_not_match(make_orders):
    assert matches(make_orders(leg("A", "buy", 0), leg("A", "sell", 1))) == 0


def test_unfilled_orders_do_not_match(make_orders):
    new = ("A", "NEW", 0, {"side": "buy"})
    cancelled = ("A", "CANCELLED", 0, {"side": "buy"})
    assert matches(make_orders(new, cancelled, leg("B", "sell", 1))) == 0


def test_pair_is_counted_in_both_directions(make_orders):
    events = [leg("A", "buy", s) for s in (0, 1)] + [leg("B", "sell", s) for s in (2, 3)]
    events += [leg("B", "buy", 5), leg("A", "sell", 6)]
    (found,) = alerts(make_orders(*events))
    assert (found.trader_id_1, found.trader_id_2, found.match_count) == ("A", "B", 5)


def test_zero_quantity_raises_nothing(make_orders):
    orders = make_orders(leg("A", "buy", 0, quantity=0), leg("B", "sell", 1, quantity=0))
    assert matches(orders) == 0


def random_orders(seed, count, symbols=2, traders=5):
    rng = random.Random(seed)
    rows = []
    for number in range(count):
        # A third of all orders are copies of one leg: a hot key within a hot symbol.
        hot = rng.random() < 1 / 3
        at = 5 * 60 if hot else rng.randrange(0, 900)
        rows.append(
            (
                f"o{number}", "t0" if hot else f"t{rng.randrange(traders)}", "normal",
                "S0" if hot else f"S{rng.randrange(symbols)}",
                rng.choice(("buy", "sell")),
                100.0 if hot else round(100 * (1 + rng.uniform(-0.006, 0.006)), 2),
                100 if hot else rng.choice((80, 90, 91, 100, 110, 111, 121)),
                "FILLED", START + timedelta(seconds=at),
            )
        )
    return rows


def brute_force(rows, params):
    def deviation(a, b):
        return abs(a - b) / ((a + b) / 2.0)

    pairs = defaultdict(list)
    for b in rows:
        for s in rows:
            if b[4] != "buy" or s[4] != "sell" or b[1] == s[1] or b[3] != s[3]:
                continue
            at_b, at_s = (int(r[8].timestamp()) for r in (b, s))
            window = at_b // params.window_sec
            if window != at_s // params.window_sec:
                continue
            if (
                deviation(b[5], s[5]) <= params.price_tolerance
                and deviation(float(b[6]), float(s[6])) <= params.quantity_tolerance
                and abs(at_s - at_b) <= params.match_gap_sec
            ):
                key = (min(b[1], s[1]), max(b[1], s[1]), b[3], window * params.window_sec)
                pairs[key].append(deviation(b[5], s[5]) * 100)
    return pairs


def test_cells_and_folding_agree_with_brute_force(spark):
    for seed, params in (
        (1, WashParams()),
        (2, WashParams(window_sec=120, match_gap_sec=7, max_qty_diff_pct=19.0)),
        (3, WashParams(match_gap_sec=0, max_qty_diff_pct=250.0)),
    ):
        rows = random_orders(seed, 300)
        pairs = brute_force(rows, params)
        expected = {
            k: (len(v), round(sum(v) / len(v), 6))
            for k, v in pairs.items()
            if len(v) >= params.min_match_count
        }
        orders = spark.createDataFrame(rows, ORDER_DDL)
        assert wash_matches(orders, params).count() == sum(len(v) for v in pairs.values())
        for fold in (True, False):
            found = {
                (r.trader_id_1, r.trader_id_2, r.symbol, int(r.window_start.timestamp())): (
                    r.match_count, round(r.avg_price_diff_pct, 6),
                )
                for r in wash_alerts(orders, params, F.col("window_end"), fold).collect()
            }
            assert found == expected


def test_swapping_sides_keeps_the_pairs(spark):
    orders = spark.createDataFrame(random_orders(4, 200), ORDER_DDL)
    other = F.when(F.col("side") == "buy", "sell").otherwise("buy")
    columns = ["trader_id_1", "trader_id_2", "symbol", "match_count", "window_start"]
    straight = wash_alerts(orders).select(*columns)
    swapped = wash_alerts(orders.withColumn("side", other)).select(*columns)
    assert sorted(straight.collect()) == sorted(swapped.collect())


def test_matches_are_counted_where_they_arise(make_orders):
    events = [leg("A", "buy", s) for s in (0, 10, 20)] + [leg("B", "sell", s + 1) for s in (0, 10, 20)]
    plan = wash_alerts(make_orders(*events))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Join")]


def test_traders_of_all_lanes_meet_both_ways(make_orders):
    events = [leg(f"T{n}", "buy", 0) for n in range(20)] + [leg(f"T{n}", "sell", 1) for n in range(20)]
    found = alerts(make_orders(*events), WashParams(min_match_count=2))
    assert len(found) == 190 and {row.match_count for row in found} == {2}


def test_alerts_join_blocks_of_traders_not_legs(make_orders):
    events = [leg("A", "buy", 0), leg("B", "sell", 1)]
    plan = wash_alerts(make_orders(*events))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "time_cell" not in plan


def test_bounded_pieces_agree_with_the_leg_by_leg_join(spark, monkeypatch):
    monkeypatch.setattr(wash_pairs, "CELLS", 5)
    orders = spark.createDataFrame(random_orders(7, 300, symbols=1, traders=40), ORDER_DDL)
    odd = [
        ("n1", None, "normal", "S0", "buy", 100.0, 100, "FILLED", START),
        ("n2", "t1", "normal", "S0", "buy", None, 100, "FILLED", START),
        ("n3", "t1", "normal", "S0", "sell", 100.0, None, "FILLED", START),
        ("n4", "t2", "normal", None, "sell", 100.0, 100, "FILLED", START),
        ("n5", "t2", "normal", "S0", "sell", 100.0, -100, "FILLED", START),
        ("n6", "t2", "normal", "S0", "sell", 0.0, 100, "FILLED", START),
    ]
    orders = orders.unionByName(spark.createDataFrame(odd, ORDER_DDL))
    for params in (WashParams(min_match_count=1), WashParams(min_match_count=2, max_qty_diff_pct=250.0)):
        folded, plain = (
            sorted(
                (r.trader_id_1, r.trader_id_2, r.symbol, r.match_count, round(r.avg_price_diff_pct, 6), r.window_start)
                for r in wash_alerts(orders, params, F.col("window_end"), fold).collect()
            )
            for fold in (True, False)
        )
        assert folded == plain and folded


def test_a_lane_with_itself_may_list_its_traders_in_two_orders():
    def trader(name, buys, sells):
        legs = lambda times: [{"at": t, "price": 100.0, "size": 10.0, "copies": 1} for t in times]
        return {"trader_id": name, "buy": legs(buys), "sell": legs(sells)}

    block = [trader("A", [0, 1], []), trader("B", [], [2, 3]), trader("C", [200], [])]
    row = {"start": 0, "symbol": "S", "low_lane": 1, "high_lane": 1, "low_traders": block, "high_traders": block[::-1]}
    leg = pa.struct({"at": pa.int64(), "price": pa.float64(), "size": pa.float64(), "copies": pa.int64()})
    members = pa.list_(pa.struct({"trader_id": pa.string(), "buy": pa.list_(leg), "sell": pa.list_(leg)}))
    kinds = {"low_traders": members, "high_traders": members}
    batch = pa.RecordBatch.from_pydict({name: pa.array([value], kinds.get(name)) for name, value in row.items()})
    (found,) = wash_pairs.pair_counter(300, 30, 0.005, 0.1, 0.2, 1)(iter([batch]))
    assert [(r["trader_id_1"], r["trader_id_2"], r["match_count"]) for r in found.to_pylist()] == [("A", "B", 4)]


def test_digest_counts_the_alerts_and_keeps_the_first_pair(spark, monkeypatch):
    orders = spark.createDataFrame(random_orders(8, 300, symbols=2, traders=30), ORDER_DDL)
    params = WashParams(min_match_count=2)
    expected = defaultdict(list)
    for r in alerts(orders, params):
        key = (r.trader_id_1, r.trader_id_2, r.match_count, round(r.avg_price_diff_pct, 6))
        expected[r.symbol, r.window_start].append(key)
    for cells in (5, wash_pairs.CELLS):
        monkeypatch.setattr(wash_pairs, "CELLS", cells)
        found = defaultdict(list)
        for r in wash_digest(orders, params, F.col("window_end")).collect():
            found[r.symbol, r.window_start].append(r)
        assert found.keys() == expected.keys() and expected
        for place, rows in found.items():
            pairs = expected[place]
            assert sum(r.alert_count for r in rows) == len(pairs)
            assert {t for r in rows for t in r.traders} == {t for pair in pairs for t in pair[:2]}
            first = min(rows, key=lambda r: (r.trader_id_1, r.trader_id_2))
            assert (
                first.trader_id_1, first.trader_id_2, first.match_count, round(first.avg_price_diff_pct, 6),
            ) == min(pairs)


def test_first_pairs_are_found_without_the_others(spark, monkeypatch):
    orders = spark.createDataFrame(random_orders(8, 300, symbols=2, traders=30), ORDER_DDL)
    key = lambda r: (r.trader_id_1, r.trader_id_2, r.match_count, round(r.avg_price_diff_pct, 6))
    for least in (1, 2, 3):
        params = WashParams(min_match_count=least)
        expected = defaultdict(list)
        for r in alerts(orders, params):
            expected[r.symbol, r.window_start].append(key(r))
        for cells, few in ((5, 1), (wash_pairs.CELLS, 4)):
            monkeypatch.setattr(wash_pairs, "CELLS", cells)
            monkeypatch.setattr(wash_pairs, "FEW", few)
            found = defaultdict(list)
            for r in wash_first_pairs(orders, params, F.col("window_end")).collect():
                found[r.symbol, r.window_start].append(key(r))
            assert {place: min(rows) for place, rows in found.items()} == {
                place: min(rows) for place, rows in expected.items()
            }
            # A row per two lanes at most.
            assert max(len(rows) for rows in found.values()) <= 10


def test_tally_adds_up_dense_and_sparse(monkeypatch):
    for cells, held in ((4, 1 << 20), (4, 2), (1000, 1 << 20)):
        monkeypatch.setattr(wash_pairs, "CELLS", held)
        tally = wash_pairs._Tally(cells)
        for _ in range(2):
            tally.add(np.array([1, 1, 3]), None, np.array([0.5, 0.25, 1.0]))
        cell, weight, diff = tally.reaching(3)
        assert (cell.tolist(), weight.tolist(), diff.tolist()) == ([1], [4], [1.5])


def test_entries_of_one_trader_are_joined():
    def entry(name, side, at):
        legs = [{"at": at, "price": 100.0, "size": 10.0, "copies": 1}]
        return {"trader_id": name, "buy": legs if side == "buy" else [], "sell": legs if side == "sell" else []}

    leg = pa.struct({"at": pa.int64(), "price": pa.float64(), "size": pa.float64(), "copies": pa.int64()})
    members = pa.list_(pa.struct({"trader_id": pa.string(), "buy": pa.list_(leg), "sell": pa.list_(leg)}))
    block = [entry("A", "buy", 0), entry("B", "sell", 1), entry("A", "buy", 2), entry("A", "sell", 3)]
    row = {"start": 0, "symbol": "S", "low_lane": 1, "high_lane": 1, "low_traders": block, "high_traders": None}
    kinds = {"low_traders": members, "high_traders": members}
    batch = pa.RecordBatch.from_pydict({name: pa.array([value], kinds.get(name)) for name, value in row.items()})
    (found,) = wash_pairs.pair_counter(300, 30, 0.005, 0.1, 0.2, 2)(iter([batch]))
    assert [(r["trader_id_1"], r["trader_id_2"], r["match_count"]) for r in found.to_pylist()] == [("A", "B", 2)]


def test_legs_joined_one_by_one_give_the_same_alerts_and_only_those_are_shuffled(make_orders):
    draw = random.Random(7)
    events = [
        leg(
            f"t{draw.randrange(12):02}", draw.choice(("buy", "sell")), draw.randrange(600),
            price=draw.choice((100.0, 100.4)), quantity=draw.choice((100, 105)),
            symbol=draw.choice(("AAPL", "MSFT")),
        )
        for _ in range(500)
    ]
    orders = make_orders(*events)
    joined = wash_alerts(orders, WashParams(), F.col("window_end"), fold_copies=False)

    def key(rows):
        return {tuple(v if not isinstance(v, float) else round(v, 9) for v in row) for row in rows}

    found = alerts(orders)
    assert len(found) > 20 and len(joined.collect()) == len(found)
    assert key(joined.collect()) == key(found)
    text = joined._jdf.queryExecution().executedPlan().toString()
    # Many small tasks, so that the counts of one stay in memory.
    assert text.count(f", {wash.JOIN_TASKS * 4}), REPARTITION_BY_NUM") >= 2 and wash.JOIN_TASKS >= 8
    # The plan reads from its end: pairs are counted and chosen in the task of the join, then dealt out.
    places = [text.rindex(part) for part in ("REBALANCE_PARTITIONS_BY_COL", ">= 3)", "Join")]
    assert places == sorted(places)
