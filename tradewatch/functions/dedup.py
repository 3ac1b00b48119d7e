"""Keep one row per key as an aggregation.

The survivor is the extreme of a struct, so each task folds its own copies before the shuffle.
A key that holds a large share of all rows therefore sends one row per task, where a
row_number window would bring the whole group into one task. The struct spans every column,
which makes the order total and the result repeatable.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keep(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    pick: Callable[[Column], Column],
    also: dict[str, Column],
) -> DataFrame:
    ranks = [expr.alias(f"_rank_{i}") for i, expr in enumerate(order)]
    rest = [F.col(name) for name in df.columns if name not in keys]
    extra = [expr.alias(name) for name, expr in also.items()]
    survivors = df.groupBy(*keys).agg(pick(F.struct(*ranks, *rest)).alias("_row"), *extra)
    return survivors.select(
        *[
            F.col(name) if name in keys else F.col(f"_row.{name}").alias(name)
            for name in df.columns
            if name not in also
        ],
        *also,
    )


def keep_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], also: dict[str, Column] | None = None
) -> DataFrame:
    """Row with the greatest order values per key; the other columns break ties, ascending.

    `also` adds aggregates over the whole group, computed in the same pass.
    """
    return _keep(df, keys, order, F.max, also or {})


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], also: dict[str, Column] | None = None
) -> DataFrame:
    """Row with the smallest order values per key; NULL sorts first."""
    return _keep(df, keys, order, F.min, also or {})
