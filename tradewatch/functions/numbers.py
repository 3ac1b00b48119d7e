"""Numeric coercion, rounding and deviation expressions; none of them raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(df: DataFrame, name: str) -> Column:
    """A column as DOUBLE; text that is not a plain decimal number becomes NULL."""
    value = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return value.cast("double")
    return F.when(value.rlike(DECIMAL_TEXT), value.try_cast("double"))


def round_half_even(value: Column, digits: int) -> Column:
    """Round a DOUBLE by scale, round-to-even and unscale."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def midpoint_deviation(a: Column, b: Column) -> Column:
    """|a-b| relative to the midpoint; NULL when the midpoint is zero."""
    return F.try_divide(F.abs(a - b), (a + b) / F.lit(2.0))
