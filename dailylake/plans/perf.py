"""Analyst queries over the gold tables (sanity, top-k, range, rolling, country).

The ``params`` of each query (first location, last date minus N days, ...)
are one-row aggregates. They are evaluated first, as a scalar subquery would
be, and then applied as literal filters, so that they reach the Parquet scan
as pushed filters (row groups of a fact clustered by location and sorted by
date are skipped by their min/max statistics).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailylake.functions.numeric import avg_money
from dailylake.operators.snapshots import Snapshots
from dailylake.operators.windows import trailing_avg


def sanity(fact: DataFrame) -> DataFrame:
    """Date range and row count of the fact."""
    return fact.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"),
                    F.count(F.lit(1)).alias("rows_total"))


def sanity_stored(gold: Snapshots) -> DataFrame:
    """:func:`sanity` of the stored fact, from the footers of its files."""
    found = gold.bounds("fact_weather_daily", "date")
    return found.select(F.col("lo").alias("min_date"), F.col("hi").alias("max_date"), F.col("n").alias("rows_total"))


def top_locations(dim_loc: DataFrame, k: int = 10) -> DataFrame:
    """First k locations by id (a top-k: TakeOrderedAndProject, no full sort)."""
    return dim_loc.select("location_id", "country", "region", "name").orderBy("location_id").limit(k)


def params(fact: DataFrame, dim_loc: DataFrame, key: str, days: int, gold: Snapshots | None = None):
    """(first non-NULL ``key`` of the dimension, max(date) - days, max(date)).

    With ``gold`` the last date comes from the stored fact's footers.

    Both values are scalar subqueries of one job; the single row is what a
    ``params`` CTE holds.
    """
    spark = fact.sparkSession
    first_key = dim_loc.where(F.col(key).isNotNull()).agg(F.min(key)).scalar()
    if gold is not None:
        hi = gold.bounds("fact_weather_daily", "date").first()["hi"]
        return dim_loc.agg(F.min(key)).first()[0], hi - _dt.timedelta(days=days) if hi else None, hi
    last_day = fact.agg(F.max("date")).scalar()
    row = spark.range(1).select(first_key.alias("k"), last_day.alias("hi")).first()
    hi = row["hi"]
    return row["k"], (hi - _dt.timedelta(days=days) if hi else None), hi


def location_range(fact: DataFrame, dim_loc: DataFrame, days: int = 30, gold: Snapshots | None = None) -> DataFrame:
    """Daily metrics of the first location over the last ``days`` + 1 dates."""
    loc, lo, hi = params(fact, dim_loc, "location_id", days, gold)
    return (fact.where((F.col("location_id") == F.lit(loc)) & F.col("date").between(lo, hi))
            .select("location_id", "date", "temp_avg_c", "precip_mm", "wind_max_kph")
            .orderBy("date"))


def rolling_range(fact: DataFrame, dim_loc: DataFrame, days: int = 60, gold: Snapshots | None = None) -> DataFrame:
    """7-row rolling average computed *after* the range filter (short first frames)."""
    loc, lo, hi = params(fact, dim_loc, "location_id", days, gold)
    f = fact.where((F.col("location_id") == F.lit(loc)) & F.col("date").between(lo, hi))
    return f.select("location_id", "date", "temp_avg_c",
                    trailing_avg("temp_avg_c", 7).alias("temp_avg_7d")).orderBy("date")


def country_daily(fact: DataFrame, dim_loc: DataFrame, days: int = 30, gold: Snapshots | None = None) -> DataFrame:
    """Average per day over the first country's locations, numeric(10,2)."""
    country, lo, hi = params(fact, dim_loc, "country", days, gold)
    locs = dim_loc.where(F.col("country") == F.lit(country)).select("location_id", "country")
    f = fact.where(F.col("date").between(lo, hi)).select("location_id", "date", "temp_avg_c")
    return (f.join(locs, "location_id")
            .groupBy("country", "date")
            .agg(avg_money("temp_avg_c").alias("avg_temp_avg_c"))
            .orderBy("date"))

