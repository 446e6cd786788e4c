"""Bronze -> silver flattening (P1, P2) with coercion; the delivery order for keep-last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailylake.functions.coerce import (to_date_strict, to_double, to_int, to_timestamp_local,
                                        to_timestamp_utc)


def _dt(bronze: DataFrame) -> Column:
    """Business date: the partition value when read from files, else metadata.dt."""
    src = F.col("dt") if "dt" in bronze.columns else F.col("metadata.dt")
    return to_date_strict(src)


def silver_locations(bronze: DataFrame) -> DataFrame:
    """One location row per bronze record; missing objects become NULLs."""
    loc = "payload.location."
    out = bronze.select(
        _dt(bronze).alias("dt"),
        F.col("metadata.location_id").alias("location_id"),
        F.col(loc + "name").alias("name"), F.col(loc + "region").alias("region"),
        F.col(loc + "country").alias("country"),
        to_double(loc + "lat").alias("lat"), to_double(loc + "lon").alias("lon"),
        F.col(loc + "tz_id").alias("tz_id"),
        to_timestamp_local(loc + "local_time").alias("local_time"),
        to_timestamp_utc("metadata.ingested_at").alias("ingested_at"),
        *_position(bronze))
    return out


def silver_daily(bronze: DataFrame) -> DataFrame:
    """The first forecast day of each record; a record without one yields no row."""
    fd = F.get(F.col("payload.forecast.forecastday"), 0)
    day = fd.getField("day")
    return (bronze.where(F.size("payload.forecast.forecastday") > 0)
            .select(_dt(bronze).alias("dt"),
                    F.col("metadata.location_id").alias("location_id"),
                    to_timestamp_utc("metadata.ingested_at").alias("ingested_at"),
                    to_date_strict(fd.getField("date")).alias("date"),
                    to_double(day.getField("mintemp_c")).alias("temp_min_c"),
                    to_double(day.getField("maxtemp_c")).alias("temp_max_c"),
                    to_double(day.getField("avgtemp_c")).alias("temp_avg_c"),
                    to_double(day.getField("totalprecip_mm")).alias("precip_mm"),
                    to_double(day.getField("totalsnow_cm")).alias("snow_cm"),
                    to_double(day.getField("avghumidity")).alias("humidity_avg"),
                    to_double(day.getField("maxwind_kph")).alias("wind_max_kph"),
                    to_int(day.getField("condition").getField("code")).alias("condition_code"),
                    day.getField("condition").getField("text").alias("condition_text"),
                    *_position(bronze)))


#: Columns that order the deliveries of a key, in both silver outputs alike.
DELIVERY = ["_arrived", "_record"]


def delivery_order(bronze: DataFrame) -> DataFrame:
    """Bronze with ``_arrived`` and ``_record``: which of two records of a key is the later.

    Landed files come in listing order, one record each; in Spark-written bronze the
    file names mean nothing, so the time of ingestion decides. Equal times are
    decided by the record's text, the same for both outputs.
    """
    arrived = (F.col("source_file") if "source_file" in bronze.columns
               else F.date_format(to_timestamp_utc("metadata.ingested_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return bronze.withColumns({"_arrived": arrived, "_record": F.to_json(F.struct("metadata", "payload"))})


def _position(bronze: DataFrame) -> list[Column]:
    return [F.col(c) for c in DELIVERY if c in bronze.columns]
