"""Driver tables as daily observations.

The checks and the benchmark run on the generated TPC-H-like tables, mapped
onto the weather contract as:

* location  = nation (``location_id`` = nation key as text), country = region name;
* date / dt = order date;
* measures  = order prices of that nation and day, as exact decimals:
  ``temp_min_c``/``temp_max_c`` = min/max price, ``temp_avg_c`` = price of the
  day's first order (lowest order key), ``precip_mm`` = spread of the day's prices
  (bounded whatever the number of orders), NULL when the day has a single order
  (exercises NULL handling), ``humidity_avg`` = share
  of urgent orders in percent (integer division, 0..100), ``wind_max_kph`` =
  largest price among finished orders (NULL when none), ``snow_cm`` = number
  of low-priority orders, ``condition_code`` / ``condition_text`` = lowest /
  highest priority label;
* ``ingested_at`` = midnight UTC after the business date.

The aggregation is hash-based with partial (map-side) aggregation, so a
nation holding a third of all orders costs one pre-aggregated row per task,
day and priority, not a third of the orders in one task.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRICE = "decimal(18,2)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def observations(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per (location_id, date) with decimal measures (see module doc).

    Two-phase aggregate: first per (location, day, priority), where the
    priority label is only a grouping key, so every buffer is numeric and the
    raw rows go through hash aggregation (a string min/max buffer would force
    a sort of all raw rows); then per (location, day) over at most one row per
    priority, where the label's min/max is cheap.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                      "o_orderpriority", "o_orderstatus")
    c = customer.select("c_custkey", "c_nationkey")
    price = F.col("o_totalprice").cast(PRICE)
    keys = [F.col("c_nationkey").cast("string").alias("location_id"),
            F.to_date("o_orderdate").alias("date")]
    per_priority = (o.join(c, o.o_custkey == c.c_custkey)
                    .groupBy(*keys, "o_orderpriority")
                    .agg(F.min(price).alias("mn"), F.max(price).alias("mx"),
                         F.min("o_orderkey").alias("k0"),
                         F.min_by(price, F.col("o_orderkey")).alias("p0"),
                         F.count(F.lit(1)).alias("n"),
                         F.max(F.when(F.col("o_orderstatus") == "F", price)).alias("wf")))
    n = F.sum("n")
    prio = F.col("o_orderpriority")
    obs = (per_priority.groupBy("location_id", "date")
           .agg(F.min("mn").alias("temp_min_c"),
                F.max("mx").alias("temp_max_c"),
                F.min_by("p0", "k0").alias("temp_avg_c"),
                F.when(n > 1, (F.max("mx") - F.min("mn")).cast(PRICE)).alias("precip_mm"),
                F.sum(F.when(prio == "5-LOW", F.col("n")).otherwise(0)).cast(PRICE).alias("snow_cm"),
                (F.sum(F.when(prio == "1-URGENT", F.col("n")).otherwise(0)) * 100 / n)
                .cast("bigint").cast(PRICE).alias("humidity_avg"),
                F.max("wf").alias("wind_max_kph"),
                F.substring(F.min(prio), 1, 1).cast("int").alias("condition_code"),
                F.max(prio).alias("condition_text")))
    return obs.withColumn("ingested_at", F.date_add("date", 1).cast("timestamp"))


def order_observations(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One observation per order: re-deliveries of the same (location, day).

    Each order is a separate record for its nation and order date, ingested
    at the next midnight plus ``o_orderkey`` seconds (so later keys are later
    deliveries), and filed under the UTC day it was ingested (``dt``), which
    can differ from the observation day. Used by the duplicate, keep-last and
    freshness checks.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                      "o_orderpriority", "o_orderstatus")
    c = customer.select("c_custkey", "c_nationkey")
    price = F.col("o_totalprice").cast(PRICE)
    ing = F.timestamp_seconds(F.unix_seconds(F.date_add(F.to_date("o_orderdate"), 1).cast("timestamp"))
                              + F.col("o_orderkey"))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("c_nationkey").cast("string").alias("location_id"),
                    F.to_date("o_orderdate").alias("date"),
                    price.alias("temp_min_c"), price.alias("temp_max_c"), price.alias("temp_avg_c"),
                    price.alias("precip_mm"),
                    F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(0).cast(PRICE).alias("snow_cm"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", 100).otherwise(0).cast(PRICE)
                    .alias("humidity_avg"),
                    F.when(F.col("o_orderstatus") == "F", price).alias("wind_max_kph"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("condition_code"),
                    F.col("o_orderpriority").alias("condition_text"),
                    ing.alias("ingested_at"))
            .withColumn("dt", F.to_date("ingested_at")))


def locations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Location registry rows: nation joined with its region (25 x sf-independent)."""
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("string").alias("location_id"),
                    F.col("n_name").alias("name"),
                    F.col("r_name").alias("country"),
                    F.lower("r_name").alias("region"),
                    (F.col("n_nationkey") * 3 - 36).cast("double").alias("lat"),
                    (F.col("n_regionkey") * 45 - 90).cast("double").alias("lon"),
                    F.lit("UTC").alias("tz")))


def location_snapshots(obs: DataFrame, locs: DataFrame) -> DataFrame:
    """Staging-shaped locations: several snapshots of each location.

    One per calendar year, as of the location's last observed day in it
    (``dt``/``ingested_at``/``local_time``), and for every fifth location one more
    under a new name whose ``ingested_at`` is NULL. A location without any
    observation has one snapshot with NULLs.
    """
    yearly = obs.groupBy("location_id", F.year("date").alias("_year")).agg(F.max("date").alias("dt"))
    renamed = (locs.where(F.col("location_id").cast("int") % 5 == 0)
               .join(obs.select("location_id").distinct(), "location_id", "left_semi")
               .withColumns({"name": F.concat("name", F.lit(" (renamed)")), "dt": F.lit(None).cast("date")}))
    return (locs.join(yearly.drop("_year"), "location_id", "left").unionByName(renamed)
            .select("dt", "location_id", "name", "region", "country", "lat", "lon",
                    F.col("tz").alias("tz_id"),
                    F.col("dt").cast("timestamp_ntz").alias("local_time"),
                    F.date_add("dt", 1).cast("timestamp").alias("ingested_at")))


def staging_daily_rows(obs: DataFrame) -> DataFrame:
    """Observations in the staging daily column order (loader input)."""
    return obs.select(F.col("date").alias("dt"), "location_id", "date", "temp_min_c",
                      "temp_max_c", "temp_avg_c", "precip_mm", "humidity_avg",
                      "wind_max_kph", "condition_code", "condition_text", "ingested_at")


class Tables:
    """Lazy access to one scale factor's tables and their observation views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)

    def obs(self) -> DataFrame:
        return observations(self.orders, self.customer)

    def order_obs(self) -> DataFrame:
        return order_observations(self.orders, self.customer)

    def registry(self) -> DataFrame:
        return locations(self.nation, self.region)

    def staging_daily(self) -> DataFrame:
        """What the daily loads leave in staging: rows plus ``loaded_at``.

        ``loaded_at`` is normally the load's ``current_timestamp()``; for the
        generated tables it is taken as one hour after ingestion so that the
        freshness checks are reproducible.
        """
        rows = staging_daily_rows(self.obs())
        return rows.withColumn("loaded_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))

    def staging_locations(self) -> DataFrame:
        snap = location_snapshots(self.obs(), self.registry())
        return snap.withColumn("loaded_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
