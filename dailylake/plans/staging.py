"""Staging views: typed projections of the staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailylake.schemas import NUMERIC

DAILY_NUMERIC = ["temp_min_c", "temp_max_c", "temp_avg_c", "precip_mm", "humidity_avg",
                 "wind_max_kph"]


def stg_weather_daily(src: DataFrame) -> DataFrame:
    """Select and cast the 12 contract columns (``loaded_at`` stays in the table)."""
    return src.select(
        F.col("dt").cast("date").alias("dt"),
        F.col("location_id").cast("string").alias("location_id"),
        F.col("date").cast("date").alias("date"),
        *[F.col(c).cast(NUMERIC).alias(c) for c in DAILY_NUMERIC],
        F.col("condition_code").cast("int").alias("condition_code"),
        F.col("condition_text").cast("string").alias("condition_text"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
    )


def stg_locations(src: DataFrame) -> DataFrame:
    """Select and cast the 9 location columns."""
    return src.select(
        F.col("location_id").cast("string").alias("location_id"),
        F.col("name").cast("string").alias("name"),
        F.col("region").cast("string").alias("region"),
        F.col("country").cast("string").alias("country"),
        F.col("lat").cast(NUMERIC).alias("lat"),
        F.col("lon").cast(NUMERIC).alias("lon"),
        F.col("tz_id").cast("string").alias("tz_id"),
        F.col("local_time").alias("local_time"),
        F.col("ingested_at").alias("ingested_at"),
    )
