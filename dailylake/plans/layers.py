"""Lasting layers: databases with the staging and gold tables and the BI views.

``staging`` and ``analytics`` have a view for every stored table over the folders of
its last commit, ``analytics_bi`` the BI views on top of them, without an order (the
final read asks for one). They live in the session's catalog, so another session on
the same metastore reads them by name. A view is replaced in one step after the
commit that it shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dailylake.operators.snapshots import Snapshots
from dailylake.plans.incremental import BY_MONTH, FACT, MOMENTS
from dailylake.session import folder_names

STAGING, ANALYTICS, BI = "staging", "analytics", "analytics_bi"

MART_ANOMALIES = f"""
WITH whole AS (
    SELECT location_id AS loc, sum(n) AS n, sum(n * mean) / sum(n) AS mean, min(lo) = max(hi) AS flat FROM {ANALYTICS}.{MOMENTS} WHERE n > 0 GROUP BY location_id),
stats AS (
    SELECT w.loc, w.mean, CASE WHEN w.n > 1 AND NOT w.flat THEN sqrt(sum(p.m2 + p.n * (p.mean - w.mean) * (p.mean - w.mean)) / (w.n - 1)) END AS sd
    FROM {ANALYTICS}.{MOMENTS} p JOIN whole w ON p.location_id <=> w.loc WHERE p.n > 0 GROUP BY w.loc, w.n, w.mean, w.flat)
SELECT f.location_id, f.date, f.temp_avg_c, CASE WHEN sd <> 0 THEN (cast(f.temp_avg_c AS double) - mean) / sd END AS z_score
FROM {ANALYTICS}.{FACT} f LEFT JOIN stats ON f.location_id <=> stats.loc"""

#: The BI views over the tables of ``analytics``.
VIEWS = {
    "weather_daily_bi": f"""
SELECT f.date, d.year, d.month, f.location_id, l.name AS city, l.country, f.temp_avg_c, f.temp_min_c, f.temp_max_c, f.precip_mm
FROM {ANALYTICS}.{FACT} f JOIN {ANALYTICS}.dim_date d ON d.date = f.date JOIN {ANALYTICS}.dim_location l ON l.location_id = f.location_id""",
    "weather_weekly_bi": f"""
WITH weekly AS (
    SELECT location_id, cast(date_trunc('week', date) AS date) AS week_start, count(*) AS days_in_week,
        cast(avg(temp_avg_c) AS decimal(10,2)) AS temp_avg_c_wk, cast(min(temp_min_c) AS decimal(10,2)) AS temp_min_c_wk,
        cast(max(temp_max_c) AS decimal(10,2)) AS temp_max_c_wk, cast(sum(coalesce(precip_mm, 0)) AS decimal(10,2)) AS precip_mm_wk,
        cast(avg(humidity_avg) AS decimal(10,2)) AS humidity_avg_wk, cast(max(wind_max_kph) AS decimal(10,2)) AS wind_max_kph_wk
    FROM {ANALYTICS}.{FACT} GROUP BY location_id, cast(date_trunc('week', date) AS date))
SELECT week_start, date_add(week_start, 6) AS week_end, cast(extract(YEAROFWEEK FROM week_start) AS int) AS iso_year, weekofyear(week_start) AS iso_week,
    w.location_id, l.name AS city, l.country, l.region, l.tz_id, days_in_week,
    temp_avg_c_wk, temp_min_c_wk, temp_max_c_wk, precip_mm_wk, humidity_avg_wk, wind_max_kph_wk
FROM weekly w JOIN {ANALYTICS}.dim_location l ON l.location_id = w.location_id""",
    "weather_anomalies_bi": f"""
WITH based AS (
    SELECT location_id, date, temp_avg_c, precip_mm, wind_max_kph,
        cast(avg(temp_avg_c) OVER before AS decimal(10,2)) AS temp_baseline_7d,
        cast(avg(coalesce(precip_mm, 0)) OVER before AS decimal(10,2)) AS precip_baseline_7d
    FROM {ANALYTICS}.{FACT} WINDOW before AS (PARTITION BY location_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
compared AS (
    SELECT *, cast(temp_avg_c - temp_baseline_7d AS decimal(10,2)) AS temp_anomaly_vs_7d,
        cast(coalesce(precip_mm, 0) - coalesce(precip_baseline_7d, 0) AS decimal(10,2)) AS precip_anomaly_vs_7d
    FROM based WHERE temp_baseline_7d IS NOT NULL)
SELECT c.date, d.year, d.month, d.day, d.iso_dow, d.year_month, c.location_id, l.name AS city, l.country, l.region, l.tz_id,
    c.temp_avg_c, temp_baseline_7d, temp_anomaly_vs_7d, c.precip_mm, precip_baseline_7d, precip_anomaly_vs_7d, c.wind_max_kph,
    abs(temp_anomaly_vs_7d) >= 5.0D AS is_temp_anomaly_5c
FROM compared c JOIN {ANALYTICS}.dim_date d ON d.date = c.date JOIN {ANALYTICS}.dim_location l ON l.location_id = c.location_id""",
}


def store_series(spark: SparkSession, fact: DataFrame, name: str = f"{ANALYTICS}.fact_by_location", buckets: int = 64) -> DataFrame:
    """The fact as a table in buckets of locations, each sorted by location and date; returns the table.

    Windows over a location's series (the rolling, weekly and baseline models) and joins by
    location then need no exchange, whoever asks and however often: for whole rebuilds and
    repeated analyses of all history. A bucket is one file, so choose ``buckets`` by the
    table's size; a location lies in one bucket, as its window does in one task.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    (fact.repartition(buckets, "location_id").write.mode("overwrite").format("parquet")
         .bucketBy(buckets, "location_id").sortBy("location_id", "date").saveAsTable(name))
    return spark.table(name)


def files_of(store: Snapshots, table: str, record: dict) -> str:
    """The folders of a table as one path pattern; a load whose partitions are all current is one name."""
    state = record["tables"][table]
    loads: dict[str, list[str]] = {}
    for part, load in state["folders"].items():
        loads.setdefault(load, []).append(part)
    names = []
    for load, parts in sorted(loads.items()):
        if parts == [""]:
            names.append(load)
        elif len(parts) == len([n for n in folder_names(store.spark, f"{store.root}/{table}/{load}") if n.startswith(f"{state['by']}=")]):
            names.append(f"{load}/{state['by']}=*")
        else:
            names.append(f"{load}/{{{','.join(parts)}}}")
    return f"{store.root}/{table}/{{{','.join(names)}}}"


def publish(spark: SparkSession, staging: Snapshots, gold: Snapshots) -> None:
    """Create the databases and replace their views by those of the last commits."""
    for name in (STAGING, ANALYTICS, BI):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    for db, store in ((STAGING, staging), (ANALYTICS, gold)):
        record = store.record()
        for table, state in record["tables"].items():
            columns = [f["name"] for f in state["schema"]["fields"]]
            # the partition's value is a folder name: a staging day is its rows' date, a gold month follows from it
            shown = [f"`date` AS `{c}`" if c == state["by"] == "dt" else f"`{c}`" for c in columns
                     if c != "month" or table not in BY_MONTH or not state["by"]]
            spark.sql(f"CREATE OR REPLACE VIEW {db}.{table} AS SELECT {', '.join(shown)} FROM parquet.`{files_of(store, table, record)}`")
    spark.sql(f"CREATE OR REPLACE VIEW {ANALYTICS}.mart_anomalies AS {MART_ANOMALIES}")
    for name, query in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {BI}.{name} AS {query}")
