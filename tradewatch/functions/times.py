"""Event-time expressions. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column) -> Column:
    """Whole-second time from the first 19 characters of an ISO string; NULL when unparsable."""
    head = F.replace(F.substring(text, 1, 19), F.lit("T"), F.lit(" "))
    return F.try_to_timestamp(head, F.lit("yyyy-MM-dd HH:mm:ss"))


def utc_timestamp(text: Column) -> Column:
    """Full-precision time from an ISO string, its offset applied; NULL when unparsable.

    A text without a date would be read as a time of today, so it counts as unparsable.
    """
    return F.when(text.rlike(r"^\s*\d{4}"), F.try_to_timestamp(text))


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_micros(ts: Column) -> Column:
    """ISO text with an explicit offset, as producers write it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def seconds(n: int) -> str:
    """Interval text for window and watermark arguments."""
    return f"{n} seconds"
