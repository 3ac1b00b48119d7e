"""Matches between the legs of two blocks of traders, counted per pair of traders in numpy.

A unit is a row with the traders of two lanes of a symbol and window, each with its buys and sells. Legs
of one side are sorted by size stratum and time, so a leg of the other meets a few slices of them; the
exact conditions are checked on whole arrays, a bounded number of pairs at once. Traders are sorted by
their legs, so those who have too few to alert with anybody else meet nobody.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Workers need not have this package: the counting travels to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTS = (
    "trader_id_1 string, trader_id_2 string, symbol string, start long, match_count long, diff_sum double"
)
#: The pair that sorts first, with the number of pairs and every trader of them.
DIGEST = f"{COUNTS}, alert_count long, traders array<string>"
CELLS = 1 << 20  # pairs of traders, and matches, held at once
FEW = 16  # traders that meet all others first when only the first pair counts; then twice as many
PIECE = 1 << 15  # pairs of legs compared at once; their arrays fit a core's cache


def _members(block: pa.ListArray) -> tuple:
    """Traders of a block by falling number of legs: their names, these numbers, buys and sells as columns."""
    entries, *sides = block.flatten().flatten()
    # A trader may come as several entries.
    entries = entries.dictionary_encode()
    names, numbers = entries.dictionary, entries.indices.to_numpy()
    legs = []
    for lists in sides:
        trader = np.repeat(numbers, lists.value_lengths().to_numpy(zero_copy_only=False))
        legs.append([trader, *[c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten()]])
    number = sum(np.bincount(trader, copies, len(names)) for trader, *_, copies in legs)
    order = np.argsort(-number, kind="stable")
    position = np.empty(len(names), np.int64)
    position[order] = np.arange(len(names))
    return names.take(pa.array(order)), number[order], *([position[trader], *rest] for trader, *rest in legs)


class _Tally:
    """Sums of weights and differences per cell; cells are a dense array once matches are many."""

    def __init__(self, cells: int) -> None:
        self.cells, self.pending, self.held, self.sums = cells, [], 0, None

    def add(self, cell: np.ndarray, weight: np.ndarray | None, diff: np.ndarray) -> None:
        self.pending.append((cell, weight, diff))
        self.held += len(cell)
        if self.held >= CELLS:
            self._fold()

    def _columns(self) -> tuple:
        cell, weight, diff = zip(*self.pending)
        self.pending, self.held = [], 0
        return np.concatenate(cell), None if weight[0] is None else np.concatenate(weight), np.concatenate(diff)

    def _fold(self) -> None:
        cell, *values = self._columns()
        sums = [np.bincount(cell, x, self.cells) for x in values]
        self.sums = sums if self.sums is None else [a + b for a, b in zip(self.sums, sums)]

    def reaching(self, least: int) -> tuple:
        """Cells with at least that weight, with their weights and differences."""
        if self.sums is None and self.held * 8 < self.cells:
            if not self.held:
                return np.empty(0, np.int64), np.empty(0), np.empty(0)
            cell, *values = self._columns()
            cell, place = np.unique(cell, return_inverse=True)
            weight, diff = (np.bincount(place, x, len(cell)) for x in values)
            some = np.flatnonzero(weight >= least)
            return cell[some], weight[some], diff[some]
        if self.held:
            self._fold()
        weight, diff = self.sums
        cell = np.flatnonzero(weight >= least)
        return cell, weight[cell], diff[cell]


def pair_counter(
    window_sec: int,
    gap: int,
    price_tolerance: float,
    size_tolerance: float,
    reach: float | None,
    least: int,
    digest: bool = False,
    first: bool = False,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts per pair of traders with at least `least` matches; `reach` as of log sizes, None for any.

    digest: one row per unit instead, with the pair that sorts first and the number and traders of all.
    first: one row per unit, that pair alone; traders come by name until one has an alert, so the work
    follows the traders of a unit, not their pairs.
    """
    least = max(least, 1)
    span = window_sec + 2 * gap + 2  # no leg of one stratum lies within the gap of another stratum
    strata = (0,) if reach is None else (-1, 0, 1)

    def placed(legs: list, start: int) -> list:
        """Legs by stratum and time, with that place and without the time."""
        trader, at, price, size, copies = legs
        stratum = 0 if reach is None else np.floor(np.log(size) / reach).astype(np.int64)
        place = stratum * span + (at - start)
        order = np.argsort(place, kind="stable")
        return [column[order] for column in (trader, place, price, size, copies)]

    def between(legs: list, first: int, last: int) -> list:
        """Legs of the traders from first to last, numbered from there."""
        some = (legs[0] >= first) & (legs[0] < last)
        trader, *rest = (column[some] for column in legs)
        return [trader - first, *rest]

    def compare(legs: list, others: list, width: int, offset: int | None, tally: _Tally, plain: bool) -> None:
        """Tally the matches of a bounded number of pairs of legs at once.

        offset: of one lane's traders, the first other's place behind the first one's; each pair counts once.
        """
        trader, place, price, size, copies = legs
        other_trader, other_place, other_price, other_size, other_copies = others
        base = trader * width
        bound = min(CELLS, PIECE)
        for step in strata:
            low = np.searchsorted(other_place, place + step * span - gap, "left")
            number = np.searchsorted(other_place, place + step * span + gap, "right") - low
            ends = np.cumsum(number)
            shift = low - (ends - number)
            begin = 0
            while begin < len(ends):
                done = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, done + bound, "right")))
                some = number[begin:end]
                j = np.arange(done, ends[end - 1]) + np.repeat(shift[begin:end], some)
                if len(j):
                    a, b = np.repeat(size[begin:end], some), other_size[j]
                    near = np.abs(a - b) / ((a + b) / 2) <= size_tolerance
                    a, b = np.repeat(price[begin:end], some), other_price[j]
                    apart = np.abs(a - b) / ((a + b) / 2)
                    near &= apart <= price_tolerance
                    near = np.flatnonzero(near)
                    i, j, apart = np.repeat(np.arange(begin, end), some)[near], j[near], apart[near]
                    if offset is not None:
                        near = np.flatnonzero(trader[i] < other_trader[j] + offset)
                        i, j, apart = i[near], j[near], apart[near]
                    if len(j):
                        weight = None if plain else (copies[i] * other_copies[j]).astype(np.float64)
                        diff = apart * 100.0
                        tally.add(base[i] + other_trader[j], weight, diff if plain else diff * weight)
                begin = end

    def pairs(number: np.ndarray, legs: list, other_number: np.ndarray, others: list, same: bool) -> Iterator[tuple]:
        """Pairs of traders that alert, by place, a bounded number at once, with their sums."""
        first = 0
        while first < len(number) and number[first] > 0:
            # Two traders have at most the product of their numbers of legs as matches.
            begin, stop = first if same else 0, int(np.searchsorted(-other_number, -least / number[first], "right"))
            width = stop - begin
            if width <= 0:
                break
            last = min(first + max(1, CELLS // width), len(number))
            mine = [between(side, first, last) for side in legs]
            theirs = [between(side, begin, stop) for side in others]
            plain = all((side[-1] == 1).all() for side in (*mine, *theirs))
            tally = _Tally((last - first) * width)
            for side, other in zip(mine, theirs):
                # In a lane with itself each pair would come twice.
                compare(side, other, width, begin - first if same else None, tally, plain)
            cell, counts, diffs = tally.reaching(least)
            if len(cell):
                yield cell // width + first, cell % width + begin, counts, diffs
            first = last

    def chosen(legs: list, traders: np.ndarray, total: int) -> list:
        """Legs of some traders, numbered by their place among these."""
        number = np.full(total, -1)
        number[traders] = np.arange(len(traders))
        some = number[legs[0]] >= 0
        return [number[legs[0][some]], *[column[some] for column in legs[1:]]]

    def first_pair(rank: np.ndarray, lows: int, legs: list, others: list, same: bool) -> tuple | None:
        """The pair that sorts first, by place, with its sums; the low lane's traders come first by place."""
        highs = lows if same else len(rank) - lows
        by_name = np.argsort(rank)
        begin, size, best = 0, FEW, None
        while begin < len(by_name) and best is None:
            some = by_name[begin : begin + size]
            meetings = [(some[some < lows], 0, legs, lows, others, highs, 0 if same else lows)]
            if not same:
                meetings.append((some[some >= lows] - lows, lows, others, highs, legs, lows, 0))
            for traders, before, own, total, opposite, width, other_before in meetings:
                step = max(1, CELLS // max(width, 1))
                for piece in (traders[k : k + step] for k in range(0, len(traders), step)):
                    tally = _Tally(len(piece) * width)
                    # Buys meet sells, and sells buys.
                    for side, other in zip(own, opposite[::-1]):
                        compare(chosen(side, piece, total), other, width, None, tally, False)
                    cell, counts, diffs = tally.reaching(least)
                    one, two = piece[cell // width] + before, cell % width + other_before
                    apart = np.flatnonzero(one != two)
                    if len(apart):
                        one, two, counts, diffs = (x[apart] for x in (one, two, counts, diffs))
                        low, high = np.minimum(rank[one], rank[two]), np.maximum(rank[one], rank[two])
                        at = int(np.argmin(low * len(rank) + high))
                        key = (low[at], high[at])
                        if best is None or key < best[0]:
                            best = key, [column[at : at + 1] for column in (one, two, counts, diffs)]
            # Pairs with a trader of an earlier name have all been met.
            begin, size = begin + size, size * 2
        return best and best[1]

    def unit(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        start, symbol = row.column("start")[0].as_py(), row.column("symbol")[0]
        same = row.column("low_lane")[0] == row.column("high_lane")[0]
        names, number, *legs = _members(row.column("low_traders"))
        legs = [placed(side, start) for side in legs]
        # A lane with itself is read once, as its two copies may list the traders in different orders.
        if not same and not row.column("high_traders").value_lengths()[0].as_py():
            return
        if same:
            all_names, other_number, others = names, number, legs
        else:
            other_names, other_number, *others = _members(row.column("high_traders"))
            others = [placed(side, start) for side in others]
            all_names = pa.concat_arrays([names, other_names])
        rank = np.empty(len(all_names), np.int64)
        rank[pc.array_sort_indices(all_names).to_numpy()] = np.arange(len(all_names))

        def rows(one: np.ndarray, two: np.ndarray, counts: np.ndarray, diffs: np.ndarray) -> dict:
            ahead = rank[one] < rank[two]
            return {
                "trader_id_1": all_names.take(pa.array(np.where(ahead, one, two))),
                "trader_id_2": all_names.take(pa.array(np.where(ahead, two, one))),
                "symbol": pa.repeat(symbol, len(one)),
                "start": pa.array(np.full(len(one), start, np.int64)),
                "match_count": pa.array(np.rint(counts).astype(np.int64)),
                "diff_sum": pa.array(diffs),
            }

        if first:
            found = first_pair(rank, len(names), legs, others, same)
            if found is not None:
                yield pa.RecordBatch.from_pydict(rows(*found))
            return
        # Buys meet the others' sells, and sells their buys.
        total, involved, best = 0, np.zeros(len(all_names), bool), None
        for one, two, *sums in pairs(number, legs, other_number, others[::-1], same):
            two = two if same else two + len(names)
            if not digest:
                yield pa.RecordBatch.from_pydict(rows(one, two, *sums))
                continue
            total += len(one)
            involved[one] = involved[two] = True
            low, high = np.minimum(rank[one], rank[two]), np.maximum(rank[one], rank[two])
            at = int(np.argmin(low * len(rank) + high))
            key = (low[at], high[at])
            if best is None or key < best[0]:
                best = key, [column[at : at + 1] for column in (one, two, *sums)]
        if best is not None:
            traders = all_names.take(pa.array(np.flatnonzero(involved)))
            extra = {"alert_count": pa.array([total], pa.int64()), "traders": pa.array([traders.to_pylist()], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(rows(*best[1]) | extra)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):  # a midpoint of zero matches nothing
            for batch in batches:
                for row in range(batch.num_rows):
                    yield from unit(batch.slice(row, 1))

    return count
