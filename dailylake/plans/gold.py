"""Gold models: dimensions, fact, marts and BI views.

Each model is a function of DataFrames, so the dependency graph is the call
graph. Dimension joins carry no broadcast hint: adaptive execution measures
each dimension's materialized stage and broadcasts it only when it is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; a larger dimension stays a
sort-merge join. The final plans of the BI views are broadcast hash joins
(dimensions are bounded by the calendar and the location registry), and a
separate size-check job would only recompute the dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.functions import dates as D
from dailylake.functions.numeric import avg_money, money
from dailylake.operators.dedup import latest_by_key
from dailylake.operators.windows import (change_vs_lag, group_stats, trailing_avg, zscore)

FACT_COLUMNS = ["location_id", "date", "dt", "temp_min_c", "temp_max_c", "temp_avg_c",
                "precip_mm", "humidity_avg", "wind_max_kph", "condition_code",
                "condition_text", "ingested_at"]

DIM_LOCATION_COLUMNS = ["location_id", "name", "region", "country", "lat", "lon", "tz_id",
                        "local_time"]


def dim_location(stg_locations: DataFrame) -> DataFrame:
    """Latest row per location by ``ingested_at DESC`` (NULL first, as in Postgres)."""
    latest = latest_by_key(stg_locations, ["location_id"], ["ingested_at"], nulls_first=True)
    return latest.select(*DIM_LOCATION_COLUMNS)


def dim_date(stg_daily: DataFrame) -> DataFrame:
    """Every day between the first and last observed date, with calendar fields."""
    bounds = stg_daily.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return D.calendar(days)


def dim_date_between(spark: SparkSession, lo: str, hi: str) -> DataFrame:
    """The calendar between two known days."""
    day = lambda v: F.lit(v).cast("date")
    return D.calendar(spark.range(1).select(F.explode(F.sequence(day(lo), day(hi))).alias("date")))


def fact_weather_daily(stg_daily: DataFrame) -> DataFrame:
    """Pure projection of the staging view."""
    return stg_daily.select(*FACT_COLUMNS)


def mart_weather_rolling(fact: DataFrame) -> DataFrame:
    """7- and 30-row trailing averages, current row included."""
    return fact.select("location_id", "date", "temp_avg_c",
                       trailing_avg("temp_avg_c", 7).alias("temp_avg_7d"),
                       trailing_avg("temp_avg_c", 30).alias("temp_avg_30d"))


def mart_weekly_change(fact: DataFrame) -> DataFrame:
    """Change against the value 7 rows earlier."""
    return fact.select("location_id", "date", "temp_avg_c",
                       change_vs_lag("temp_avg_c", 7).alias("temp_wow_change"))


def mart_anomalies(fact: DataFrame) -> DataFrame:
    """z-score of ``temp_avg_c`` within its location.

    The per-location mean and deviation are a partial aggregate (one row per
    location) joined back; adaptive execution broadcasts it, so the fact is
    not shuffled for the statistics.
    """
    stats = group_stats(fact, "location_id", "temp_avg_c").withColumnRenamed("location_id", "_loc")
    f = fact.select("location_id", "date", "temp_avg_c")
    # null-safe: a window PARTITION BY keeps NULL keys together, an equi-join would drop them
    return (f.join(stats, f["location_id"].eqNullSafe(stats["_loc"]))
            .select("location_id", "date", "temp_avg_c",
                    zscore(F.col("temp_avg_c"), F.col("_mean"), F.col("_sd")).alias("z_score")))


def location_moments(fact: DataFrame) -> DataFrame:
    """Count, mean, sum of squared deviations, least and greatest ``temp_avg_c`` by location and month.

    They merge: a load changes its months' rows only, and :func:`merged_moments`
    gives the whole series' statistics without reading it.
    """
    x = F.col("temp_avg_c").cast("double")
    return (fact.groupBy("location_id", F.trunc("date", "month").alias("month"))
            .agg(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("lo"), F.max(x).alias("hi")))


def merged_moments(moments: DataFrame) -> DataFrame:
    """Mean and sample deviation by location: squared deviations within the months and between them."""
    some = moments.where("n > 0")
    whole = some.groupBy("location_id").agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"),
                                            (F.min("lo") == F.max("hi")).alias("_flat"))
    whole = whole.withColumnRenamed("location_id", "_loc")
    parts = some.join(whole, some["location_id"].eqNullSafe(whole["_loc"]))
    spread = F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean")))
    return (parts.groupBy("_loc", "_n", "_mean", "_flat").agg(spread.alias("_m2"))
            .select("_loc", "_mean", F.when((F.col("_n") > 1) & ~F.col("_flat"), F.sqrt(F.col("_m2") / (F.col("_n") - 1))).alias("_sd")))


def mart_anomalies_from(fact: DataFrame, moments: DataFrame) -> DataFrame:
    """:func:`mart_anomalies` from stored moments: the fact is read once and not aggregated."""
    f = fact.select("location_id", "date", "temp_avg_c")
    stats = merged_moments(moments)
    return (f.join(stats, f["location_id"].eqNullSafe(stats["_loc"]), "left")
            .select("location_id", "date", "temp_avg_c", zscore(F.col("temp_avg_c").cast("double"), F.col("_mean"), F.col("_sd")).alias("z_score")))


def weather_daily_bi(fact: DataFrame, dim_dt: DataFrame, dim_loc: DataFrame) -> DataFrame:
    f = fact.select("location_id", "date", "temp_avg_c", "temp_min_c", "temp_max_c", "precip_mm")
    d = dim_dt.select("date", "year", "month")
    l = dim_loc.select("location_id", F.col("name").alias("city"), "country")
    return (f.join(d, "date").join(l, "location_id")
            .select("date", "year", "month", "location_id", "city", "country",
                    "temp_avg_c", "temp_min_c", "temp_max_c", "precip_mm"))


def weekly(fact: DataFrame) -> DataFrame:
    """Per location and ISO week (Monday start): counts and numeric(10,2) measures."""
    ws = D.week_start("date")
    return (fact.groupBy("location_id", ws.alias("week_start"), D.week_end("date").alias("week_end"))
            .agg(F.count(F.lit(1)).alias("days_in_week"),
                 avg_money("temp_avg_c").alias("temp_avg_c_wk"),
                 money(F.min("temp_min_c")).alias("temp_min_c_wk"),
                 money(F.max("temp_max_c")).alias("temp_max_c_wk"),
                 money(F.sum(F.coalesce(F.col("precip_mm"), F.lit(0)))).alias("precip_mm_wk"),
                 avg_money("humidity_avg").alias("humidity_avg_wk"),
                 money(F.max("wind_max_kph")).alias("wind_max_kph_wk")))


def weather_weekly_bi(fact: DataFrame, dim_loc: DataFrame) -> DataFrame:
    w = weekly(fact)
    l = dim_loc.select("location_id", F.col("name").alias("city"), "country",
                                          "region", "tz_id")
    return (w.join(l, "location_id")
            .select("week_start", "week_end",
                    D.iso_year("week_start").alias("iso_year"),
                    D.iso_week("week_start").alias("iso_week"),
                    "location_id", "city", "country", "region", "tz_id", "days_in_week",
                    "temp_avg_c_wk", "temp_min_c_wk", "temp_max_c_wk", "precip_mm_wk",
                    "humidity_avg_wk", "wind_max_kph_wk"))


def anomalies(fact: DataFrame, threshold: float = 5.0) -> DataFrame:
    """7-row baselines (current row excluded), rounded before the difference.

    Rows without a temperature baseline are dropped *after* the window, so the
    first row of a location still feeds the baselines of the rows after it.
    """
    base = fact.select("location_id", "date", "temp_avg_c", "precip_mm", "wind_max_kph")
    calc = base.select(
        "*",
        money(trailing_avg("temp_avg_c", 7, include_current=False)).alias("temp_baseline_7d"),
        money(trailing_avg(F.coalesce(F.col("precip_mm"), F.lit(0)), 7, include_current=False))
        .alias("precip_baseline_7d"))
    return (calc.where(F.col("temp_baseline_7d").isNotNull())
            .select("location_id", "date", "temp_avg_c", "temp_baseline_7d",
                    money(F.col("temp_avg_c") - F.col("temp_baseline_7d")).alias("temp_anomaly_vs_7d"),
                    "precip_mm", "precip_baseline_7d",
                    money(F.coalesce(F.col("precip_mm"), F.lit(0))
                          - F.coalesce(F.col("precip_baseline_7d"), F.lit(0)))
                    .alias("precip_anomaly_vs_7d"),
                    "wind_max_kph")
            .withColumn("is_temp_anomaly_5c",
                        (F.abs(F.col("temp_anomaly_vs_7d")) >= F.lit(threshold)).cast("boolean")))


def weather_anomalies_bi(fact: DataFrame, dim_dt: DataFrame, dim_loc: DataFrame,
                         threshold: float = 5.0) -> DataFrame:
    a = anomalies(fact, threshold)
    d = dim_dt
    l = dim_loc.select("location_id", F.col("name").alias("city"), "country",
                                          "region", "tz_id")
    return (a.join(d, "date").join(l, "location_id")
            .select("date", "year", "month", "day", "iso_dow", "year_month",
                    "location_id", "city", "country", "region", "tz_id",
                    "temp_avg_c", "temp_baseline_7d", "temp_anomaly_vs_7d",
                    "precip_mm", "precip_baseline_7d", "precip_anomaly_vs_7d",
                    "wind_max_kph", "is_temp_anomaly_5c"))


def present(df: DataFrame, *keys: str) -> DataFrame:
    """The views' ORDER BY, applied only at the final read (a global sort)."""
    return df.orderBy(*keys)


class Gold:
    """Builds the gold models once from the two staging tables."""

    def __init__(self, stg_daily_table: DataFrame, stg_locations_table: DataFrame):
        from dailylake.plans.staging import stg_locations, stg_weather_daily
        self.stg_daily = stg_weather_daily(stg_daily_table)
        self.stg_locations = stg_locations(stg_locations_table)

    def fact(self) -> DataFrame:
        return fact_weather_daily(self.stg_daily)

    def dim_location(self) -> DataFrame:
        return dim_location(self.stg_locations)

    def dim_date(self) -> DataFrame:
        return dim_date(self.stg_daily)
