"""Bit sets of bounded size that let rows without a partner be dropped inside a scan."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANY = 1 << 26  # 8 MB, whatever the number of values


def bit_set(values: DataFrame, column: Column, bits: int) -> np.ndarray:
    """The set of a long column's values modulo `bits`."""
    bit = F.pmod(column, F.lit(bits))
    rows = (
        values.select(
            F.shiftright(bit, 5).cast("int").alias("at"), F.pmod(bit, F.lit(32)).cast("int").alias("bit")
        )
        .groupBy("at")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
        .toArrow()
    )
    # At most bits / 32 rows.
    table = np.zeros(bits // 32, np.uint32)
    table[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return table


def may_hold(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value may be in the set; those in it always may."""
    bit = (values.view(np.int64) % (len(table) * 32)).astype(np.uint32)
    return (table[bit >> np.uint32(5)] >> (bit & np.uint32(31))) & np.uint32(1) != 0
