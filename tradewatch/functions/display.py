"""Text forms shown to analysts; a missing value is a dash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"


def percent(rate: Column) -> Column:
    """A fraction as a percentage with one decimal."""
    tenths = F.rint(rate * F.lit(1000.0)) / F.lit(10.0)
    return F.when(rate.isNull(), DASH).otherwise(F.format_string("%.1f%%", tenths))


def percent_points(value: Column) -> Column:
    """A value already in percent, with three decimals."""
    thousandths = F.rint(value * F.lit(1000.0)) / F.lit(1000.0)
    return F.when(value.isNull(), DASH).otherwise(F.format_string("%.3f%%", thousandths))


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def fixed(value: Column, digits: int, suffix: str = "") -> Column:
    """A number with fixed decimals."""
    scale = F.lit(float(10**digits))
    text = F.format_string(f"%.{digits}f{suffix}", F.rint(value * scale) / scale)
    return F.when(value.isNull(), DASH).otherwise(text)


def grouped(count: Column) -> Column:
    """A whole number with thousands separators; a missing one is zero."""
    return F.format_number(F.coalesce(count, F.lit(0)), 0)
