"""Wash trading: two traders filling opposite orders of like price and size at nearly one time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.numbers import midpoint_deviation
from tradewatch.functions.times import seconds
from tradewatch.operators.selection import select_rows
from tradewatch.operators.wash_pairs import COUNTS, DIGEST, pair_counter
from tradewatch.params import WashParams

BUY, SELL = "buy", "sell"

# Width of a cell in tolerances. A wider cell holds more pairs that cannot match, a narrower one
# costs more copies of each sell: a sell is copied 1 + 2/width times per dimension.
CELL_WIDTH = 2

# Traders are cut into lanes by a hash of their id; the legs of two lanes meet in one row, so matches
# are counted where they arise. A leg is copied to each lane its trader may meet.
LANES = 4
TASKS = 2  # for the lane pairs, as a multiple of the shuffle partitions
JOIN_TASKS = 8  # the same where legs are joined: a task holds the counts of all its pairs, which should not spill
LANE_PAIR = ("low_lane", "high_lane")


def _size_reach(tolerance: float) -> float | None:
    """Greatest gap of log sizes whose midpoint deviation stays within the tolerance.

    A deviation of at most t bounds the ratio of two positive sizes by (1 + t/2) / (1 - t/2); the
    margin covers rounding in the logarithm. From t = 2 on every two sizes match.
    """
    if tolerance >= 2:
        return None
    return math.log((1 + tolerance / 2) / (1 - tolerance / 2)) * (1 + 1e-9) + 1e-9


def _time_cells(side: str, params: WashParams) -> Column:
    gap = params.match_gap_sec
    width = max(CELL_WIDTH * gap, 1)

    def cell(at: Column) -> Column:
        return F.floor(at / F.lit(width)).cast("bigint")

    at = F.col("order_sec")
    return F.array(cell(at)) if side == BUY else F.sequence(cell(at - gap), cell(at + gap))


def _size_cells(side: str, params: WashParams) -> Column:
    reach = _size_reach(params.quantity_tolerance)
    if reach is None:
        return F.array(F.lit(0).cast("bigint"))

    def cell(log_size: Column) -> Column:
        return F.floor(log_size / F.lit(CELL_WIDTH * reach)).cast("bigint")

    size = F.when(F.col("quantity") > 0, F.ln(F.col("quantity").cast("double")))
    return F.array(cell(size)) if side == BUY else F.sequence(cell(size - reach), cell(size + reach))


def _legs(orders: DataFrame, side: str, params: WashParams, *carry: str) -> DataFrame:
    filled = select_rows(orders, (F.col("side") == side) & (F.col("status") == "FILLED"))
    return filled.select(
        F.window("event_time", seconds(params.window_sec)).alias("window"),
        "symbol",
        "trader_id",
        "price",
        "quantity",
        F.unix_seconds("event_time").alias("order_sec"),
        *carry,
    )


def _copies(legs: DataFrame) -> DataFrame:
    """Equal legs as one row with their number, folded within each task before the shuffle."""
    return legs.groupBy(*legs.columns).agg(F.count(F.lit(1)).alias("copies"))


def _placed_in_cells(legs: DataFrame, side: str, params: WashParams) -> DataFrame:
    return legs.withColumn("time_cell", F.explode(_time_cells(side, params))).withColumn(
        "size_cell", F.explode(_size_cells(side, params))
    )


def _match(buys: DataFrame, sells: DataFrame, params: WashParams, *units: str) -> DataFrame:
    """Join legs of one symbol and window that differ in trader and agree in price, size and time.

    A busy symbol would make window and symbol alone a quadratic key. Time and size are cut into
    cells a few tolerances wide: a buy lies in one cell, a sell is copied to the cells within its
    reach, so each pair meets in exactly one cell. The exact conditions stay in the join. `units` are
    further columns that must be equal.
    """
    b = _placed_in_cells(buys, BUY, params).alias("b")
    s = _placed_in_cells(sells, SELL, params).alias("s")
    price_gap = midpoint_deviation(F.col("b.price"), F.col("s.price"))
    size_gap = midpoint_deviation(
        F.col("b.quantity").cast("double"), F.col("s.quantity").cast("double")
    )
    apart = F.col("s.order_sec") - F.col("b.order_sec")
    same_cell = [
        F.col(f"b.{name}") == F.col(f"s.{name}")
        for name in ("window", "symbol", *units, "time_cell", "size_cell")
    ]
    condition = (
        (F.col("b.trader_id") != F.col("s.trader_id"))
        & (price_gap <= params.price_tolerance)
        & (size_gap <= params.quantity_tolerance)
        & apart.between(-params.match_gap_sec, params.match_gap_sec)
    )
    for equality in same_cell:
        condition = condition & equality
    return b.join(s, condition).withColumn("price_diff_pct", price_gap * F.lit(100.0))


def wash_matches(orders: DataFrame, params: WashParams = WashParams()) -> DataFrame:
    """Every matching buy and sell."""
    buys = _legs(orders, BUY, params, "order_id")
    sells = _legs(orders, SELL, params, "order_id")
    return _match(buys, sells, params).select(
        F.col("b.symbol").alias("symbol"),
        F.col("b.order_id").alias("buy_order_id"),
        F.col("s.order_id").alias("sell_order_id"),
        F.col("b.trader_id").alias("buy_trader_id"),
        F.col("s.trader_id").alias("sell_trader_id"),
        "price_diff_pct",
        (F.col("s.order_sec") - F.col("b.order_sec")).alias("gap_sec"),
        F.col("b.window.start").alias("window_start"),
        F.col("b.window.end").alias("window_end"),
    )


def _dealt(legs: DataFrame, side: str) -> DataFrame:
    """Each leg once per unit of two lanes, all legs of a unit in one task, with the lane of the buy it may meet."""
    tasks = JOIN_TASKS * int(legs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    legs = _in_units(legs).withColumn("buy_lane", F.col("lane" if side == BUY else "other"))
    return legs.drop("lane", "other").repartition(tasks, "window", "symbol", *LANE_PAIR)


def _counts_unfolded(orders: DataFrame, params: WashParams) -> DataFrame:
    """Counts by a join leg by leg. In a batch the matches of two traders meet in one task, so what is
    shuffled are legs and pairs that alert, not matches nor their parts."""
    buys, sells = _legs(orders, BUY, params), _legs(orders, SELL, params)
    weight = F.lit(1).cast("bigint")
    window = F.col("b.window").alias("window")
    if orders.isStreaming:
        return _counted(_match(buys, sells, params), weight, window)
    lanes = [F.col(f"b.{name}").alias(name) for name in LANE_PAIR]
    matches = _match(_dealt(buys, BUY), _dealt(sells, SELL), params, *LANE_PAIR, "buy_lane")
    counts = _counted(matches, weight, window, *lanes)
    return counts.where(F.col("match_count") >= params.min_match_count).hint("rebalance", "trader_id_1")


def _counted(matches: DataFrame, weight: Column, *keys: Column) -> DataFrame:
    pairs = matches.select(
        F.least("b.trader_id", "s.trader_id").alias("trader_id_1"),
        F.greatest("b.trader_id", "s.trader_id").alias("trader_id_2"),
        F.col("b.symbol").alias("symbol"),
        *keys,
        weight.alias("weight"),
        (F.col("price_diff_pct") * weight).alias("weighted_diff"),
    )
    by = [name for name in pairs.columns if name not in ("weight", "weighted_diff")]
    return pairs.groupBy(*by).agg(
        F.sum("weight").alias("match_count"), F.sum("weighted_diff").alias("diff_sum")
    )


def _filled_legs(orders: DataFrame, params: WashParams) -> DataFrame:
    """Legs of both sides that can match any other, from one scan."""
    wanted = F.col("side").isin(BUY, SELL) & (F.col("status") == "FILLED")
    for name in ("symbol", "trader_id", "price", "quantity"):
        wanted = wanted & F.col(name).isNotNull()
    if _size_reach(params.quantity_tolerance) is not None:
        wanted = wanted & (F.col("quantity") > 0)
    return select_rows(orders, wanted).select(
        F.window("event_time", seconds(params.window_sec)).alias("window"),
        "symbol",
        "trader_id",
        "side",
        F.unix_seconds("event_time").alias("order_sec"),
        F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"),
    )


def _in_units(rows: DataFrame) -> DataFrame:
    """Each row once per lane that its trader may meet, with the lanes of that unit."""
    return (
        rows.withColumn("lane", F.pmod(F.xxhash64("trader_id"), F.lit(LANES)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
        .withColumn("low_lane", F.least("lane", "other"))
        .withColumn("high_lane", F.greatest("lane", "other"))
    )


def _units(orders: DataFrame, params: WashParams) -> DataFrame:
    """Per symbol, window and two lanes the traders of either lane, each with their buys and sells."""
    legs = _filled_legs(orders, params)
    legs = legs.withColumn("start", F.unix_seconds("window.start")).drop("window")
    # The join asks its right side alone for known keys; asked of both here, they share their shuffles.
    legs = _copies(legs.where(F.col("start").isNotNull()))
    leg = F.struct("order_sec", "price", "quantity", "copies")
    traders = legs.groupBy("start", "symbol", "trader_id").agg(
        *[F.collect_list(F.when(F.col("side") == side, leg)).alias(side) for side in (BUY, SELL)]
    )
    traders = _in_units(traders)
    # A lane that meets itself needs its traders but once.
    apart = F.col("low_lane") < F.col("high_lane")
    return _block(traders, "low").join(_block(traders.where(apart), "high"), UNIT_KEYS, "left")


def _units_of_stream(orders: DataFrame, params: WashParams) -> DataFrame:
    """The same with a row per leg, gathered by one aggregation that gives them out as the window closes."""
    legs = _in_units(_filled_legs(orders, params))
    one = F.array(F.struct("order_sec", "price", "quantity", F.lit(1).cast("bigint").alias("copies")))
    sides = [F.when(F.col("side") == side, one).otherwise(F.array()).alias(side) for side in (BUY, SELL)]
    low = F.col("lane") == F.col("low_lane")
    member = F.struct("trader_id", *sides)
    return (
        legs.groupBy("window", "symbol", "low_lane", "high_lane")
        .agg(
            F.collect_list(F.when(low, member)).alias("low_traders"),
            F.collect_list(F.when(~low, member)).alias("high_traders"),
        )
        .withColumn("start", F.unix_seconds("window.start"))
        .drop("window")
    )


def _counts_of_units(
    units: DataFrame, params: WashParams, digest: bool = False, first: bool = False
) -> DataFrame:
    """Matches per trader pair, symbol and window, without a shuffle or even a row per match.

    The legs of a trader in a symbol and window become one row, and the traders of a lane one block. Every
    two blocks of a symbol and window meet in one row, in which numpy counts the matches of each pair of
    traders, whichever way round.
    """
    counter = pair_counter(
        params.window_sec, params.match_gap_sec, params.price_tolerance, params.quantity_tolerance,
        _size_reach(params.quantity_tolerance), params.min_match_count, digest, first,
    )
    start = F.col("start")
    window = F.struct(
        F.timestamp_seconds(start).alias("start"),
        F.timestamp_seconds(start + params.window_sec).alias("end"),
    )
    return units.mapInArrow(counter, DIGEST if digest else COUNTS).withColumn("window", window)


UNIT_KEYS = ["start", "symbol", *LANE_PAIR]


def _block(traders: DataFrame, lane: str) -> DataFrame:
    """The traders of the lower or higher lane of each unit, one row per unit."""
    tasks = TASKS * int(traders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = traders.where(F.col("lane") == F.col(f"{lane}_lane")).repartition(tasks, *UNIT_KEYS)
    return members.groupBy(*UNIT_KEYS).agg(
        F.collect_list(F.struct("trader_id", BUY, SELL)).alias(f"{lane}_traders")
    )


def wash_alerts(
    orders: DataFrame,
    params: WashParams = WashParams(),
    detected_at: Column | None = None,
    fold_copies: bool | None = None,
) -> DataFrame:
    """One alert per trader pair, symbol and window with enough matches, whichever way round.

    Matches are counted where two blocks of traders meet; in a batch, equal legs are folded before that and
    weigh by their number. fold_copies=False joins leg by leg instead.
    """
    if fold_copies is False:
        counts = _counts_unfolded(orders, params)
    else:
        units = _units_of_stream if orders.isStreaming else _units
        counts = _counts_of_units(units(orders, params), params)
    return _as_alerts(counts, params, detected_at)


def wash_digest(
    orders: DataFrame, params: WashParams = WashParams(), detected_at: Column | None = None
) -> DataFrame:
    """The alerts of a table folded where they arise, into one row per symbol, window and two lanes.

    A row is the alert of its pair that sorts first, with the number of alerts and every trader of them.
    """
    counts = _counts_of_units(_units(orders, params), params, digest=True)
    return _as_alerts(counts, params, detected_at, "alert_count", "traders")


def wash_first_pairs(
    orders: DataFrame, params: WashParams = WashParams(), detected_at: Column | None = None
) -> DataFrame:
    """Of the alerts of a table in each symbol, window and two lanes the one whose pair sorts first.

    The others are not looked for, so the work follows the traders and not the square of them.
    """
    return _as_alerts(_counts_of_units(_units(orders, params), params, first=True), params, detected_at)


def _as_alerts(counts: DataFrame, params: WashParams, detected_at: Column | None, *more: str) -> DataFrame:
    return (
        counts.where(F.col("match_count") >= params.min_match_count)
        .select(
            F.lit("WASH_TRADING").alias("alert_type"),
            "trader_id_1",
            "trader_id_2",
            "symbol",
            "match_count",
            (F.col("diff_sum") / F.col("match_count")).alias("avg_price_diff_pct"),
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *more,
        )
        .withColumn(
            "detected_at",
            F.date_trunc("second", F.current_timestamp()) if detected_at is None else detected_at,
        )
    )
