"""Row-frame window operators over a (location_id, date) series.

Frames count rows, not days: a gap in the dates stretches the window (as in
the reference). All functions over the same partition/order share one
Exchange + Sort + Window in the physical plan.

A window partition holds one location's history, and the series is unique on
(location_id, date), so a partition is bounded by the calendar span (about
365 rows per year), not by data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series_window(key: str = "location_id", order: str = "date"):
    return Window.partitionBy(key).orderBy(order)


def trailing_avg(c: str | Column, rows: int, include_current: bool = True,
                 key: str = "location_id", order: str = "date") -> Column:
    """avg over ROWS (rows-1) PRECEDING..CURRENT, or rows PRECEDING..1 PRECEDING."""
    col = F.col(c) if isinstance(c, str) else c
    w = series_window(key, order)
    w = w.rowsBetween(-(rows - 1), 0) if include_current else w.rowsBetween(-rows, -1)
    return F.avg(col).over(w)


def change_vs_lag(c: str, n: int, key: str = "location_id", order: str = "date") -> Column:
    """x - lag(x, n): change against the n-th previous row."""
    return F.col(c) - F.lag(c, n).over(series_window(key, order))


def group_stats(df: DataFrame, key: str, c: str) -> DataFrame:
    """Whole-group mean and sample standard deviation, one row per key.

    Merged moments of equal values can be off zero by rounding: a series whose least and
    greatest values are equal has no spread.
    """
    sd = F.stddev_samp(c)
    return df.groupBy(key).agg(F.avg(c).alias("_mean"), F.when(F.min(c) == F.max(c), sd * 0).otherwise(sd).alias("_sd"))


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    """(x - mean) / sd, NULL when sd is NULL (n < 2) or 0 (all values equal)."""
    return F.when(sd.isNull() | (sd == 0), F.lit(None)).otherwise((x - mean) / sd)
