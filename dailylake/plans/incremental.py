"""Incremental refresh of the trailing-window marts.

A daily append changes the 7/30-row averages and the 7-row change only for
the new rows; a backfilled day changes the rows after it. So only the months
from the first changed date on are recomputed and rewritten. The stored mart
is partitioned by ``month``; every other month stays as it is. The window frames
of the recomputed rows are seeded with the last ``lookback`` rows of each location before that month. The seed reads the
mart's columns of all earlier months; Spark plans ``row_number() <= k`` as a
per-task group limit, so ``lookback`` rows of a location and task are shuffled.
The result is exactly equal to a full rebuild (property-tested).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailylake.operators.load import TABLE
from dailylake.operators.snapshots import Snapshots
from dailylake.plans import gold as G

# mart name -> (builder over a fact, rows of history its frames look back)
TRAILING_MARTS: dict[str, tuple[Callable[[DataFrame], DataFrame], int]] = {
    "mart_weather_rolling": (G.mart_weather_rolling, 29),
    "mart_weekly_change": (G.mart_weekly_change, 7),
}
FACT, MOMENTS = "fact_weather_daily", "location_moments"
#: Gold tables that are stored by month.
BY_MONTH = (FACT, MOMENTS, *TRAILING_MARTS)


def _month(c: str = "date"):
    return F.trunc(F.col(c), "month")


def by_month(rows: DataFrame) -> DataFrame:
    """Rows with their ``month``, arranged to be written by it and, in it, by location and date."""
    return rows.withColumn("month", _month()).hint("rebalance", "month").sortWithinPartitions("month", "location_id", "date")


def write_full(mart: DataFrame, root: str) -> None:
    """First build: the whole mart, partitioned by month."""
    change = Snapshots(mart.sparkSession, root).begin()
    change.replace(TABLE, by_month(mart), "month")
    change.commit()


def refresh(fact: DataFrame, build: Callable[[DataFrame], DataFrame], lookback: int,
            since: _dt.date | str) -> DataFrame:
    """Mart rows for every date in the months from ``since`` on, computed with
    the last ``lookback`` earlier rows of each location as seed."""
    start = F.trunc(F.lit(str(since)).cast("date"), "month")
    tail = fact.where(F.col("date") >= start)
    w = Window.partitionBy("location_id").orderBy(F.col("date").desc())
    seed = (fact.where(F.col("date") < start).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= lookback).select(*fact.columns))
    return build(seed.unionByName(tail)).where(F.col("date") >= start)


def refresh_into(spark: SparkSession, fact: DataFrame, root: str, name: str, since) -> None:
    """Recompute and replace the affected months of a stored trailing mart."""
    build, lookback = TRAILING_MARTS[name]
    change = Snapshots(spark, root).begin()
    change.replace_partitions(TABLE, by_month(refresh(fact, build, lookback, since)), "month")
    change.commit()


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    return Snapshots(spark, root).read(TABLE).drop("month")
