"""Row selection that keeps its place relative to a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition.

    A batch filter is pushed to the scan. On a stream a plain filter would also be pushed below
    the watermark, and rows it drops would no longer advance event time; there the rows are
    dropped by an explode, which stays where it is and adds no state.
    """
    if not df.isStreaming:
        return df.where(condition)
    keep = F.when(condition, F.array(F.lit(True)))
    return df.select("*", F.explode(keep).alias("_keep")).drop("_keep")
