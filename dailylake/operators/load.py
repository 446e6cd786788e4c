"""Staging loads (K3-K6, K9): contract column selection, NaN -> NULL, typed
casts, ``loaded_at``, and idempotent writes.

* daily:     replace the ``dt`` partitions being loaded (DELETE WHERE dt + INSERT);
* locations: full replace or upsert by key (the contract's ON CONFLICT, safe for
             backfills of older days);
* upsert:    ``target`` anti-joined with the update keys, plus the updates.

The staging primary keys are checked before writing, because Spark enforces
none (a (location_id, date) pair may collide across two dts). All writes go
through :mod:`dailylake.operators.snapshots`: alone as one commit, or into a
``change`` that commits several tables together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.functions.coerce import nan_to_null, to_double, to_timestamp_local, to_timestamp_utc
from dailylake.operators.dedup import keep_last
from dailylake.operators.snapshots import Change, Snapshots
from dailylake.schemas import (NUMERIC, STG_DAILY_COLUMNS, STG_LOCATIONS_COLUMNS,
                               STG_LOCATIONS_OPTIONAL)
from dailylake.session import path_exists

#: Name of the only table of a root that holds one.
TABLE = "rows"


class LoadError(ValueError):
    pass


def _require(df: DataFrame, cols: list[str], what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise LoadError(f"{what} rows can't be loaded: the contract's columns {missing} are not there")


def _ts_utc(df: DataFrame, c: str):
    """Timestamp column as UTC timestamp; text is parsed, bad text -> NULL."""
    t = dict(df.dtypes)[c]
    return F.col(c).cast("timestamp") if t.startswith("timestamp") else \
        to_timestamp_utc(F.col(c).cast("string"))


def _ts_local(df: DataFrame, c: str):
    """Wall-clock timestamp column; text is parsed, bad text -> NULL."""
    t = dict(df.dtypes)[c]
    return F.col(c).cast("timestamp_ntz") if t.startswith("timestamp") else \
        to_timestamp_local(F.col(c).cast("string"))


def staging_daily_rows(silver_daily: DataFrame, loaded_at=None) -> DataFrame:
    """Silver daily -> staging daily rows (contract order, staging types, loaded_at)."""
    _require(silver_daily, STG_DAILY_COLUMNS, "Silver daily")
    df = nan_to_null(silver_daily.select(*STG_DAILY_COLUMNS))
    out = df.select(
        F.col("dt").cast("date").alias("dt"), F.col("location_id").cast("string").alias("location_id"),
        F.col("date").cast("date").alias("date"),
        *[F.col(c).cast(NUMERIC).alias(c) for c in ["temp_min_c", "temp_max_c", "temp_avg_c",
                                                     "precip_mm", "humidity_avg", "wind_max_kph"]],
        F.col("condition_code").cast("int").alias("condition_code"),
        F.col("condition_text").cast("string").alias("condition_text"),
        _ts_utc(df, "ingested_at").alias("ingested_at"))
    return out.withColumn("loaded_at", loaded_at if loaded_at is not None else F.current_timestamp())


def staging_location_rows(silver_locations: DataFrame, position: list[str] | None = None,
                          loaded_at=None) -> DataFrame:
    """Silver locations -> staging rows, keep the last row per location_id.

    ``ingested_at``, ``lat``, ``lon``, ``local_time`` may be absent (NULL
    columns); the other six are required.
    """
    df = silver_locations
    for c in STG_LOCATIONS_OPTIONAL:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    _require(df, STG_LOCATIONS_COLUMNS, "Silver locations")
    pos = position or ["dt"]
    df = keep_last(df.select(*STG_LOCATIONS_COLUMNS, *[p for p in pos if p not in STG_LOCATIONS_COLUMNS]),
                   ["location_id"], pos)
    out = df.select(
        F.col("dt").cast("date").alias("dt"), F.col("location_id").cast("string").alias("location_id"),
        "name", "region", "country",
        to_double("lat").cast(NUMERIC).alias("lat"), to_double("lon").cast(NUMERIC).alias("lon"),
        "tz_id",
        _ts_local(df, "local_time").alias("local_time"),
        _ts_utc(df, "ingested_at").alias("ingested_at"))
    return out.withColumn("loaded_at", loaded_at if loaded_at is not None else F.current_timestamp())


def read_table(spark: SparkSession, root: str, table: str = TABLE) -> DataFrame | None:
    """The committed table at ``root``; None if there is none.

    A folder of plain Parquet files is a table too. A folder without either (a
    crashed write of another tool) is an error, not an empty table.
    """
    rows = Snapshots(spark, root).read(table)
    if rows is None and path_exists(spark, root) and not Snapshots(spark, root).versions():
        return spark.read.parquet(root)
    return rows


def check_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Primary-key check: raise with a bounded sample of duplicated keys."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .orderBy(*keys).limit(5).collect())
    if dup:
        raise LoadError(f"{what}: duplicate key {keys}: {[tuple(r) for r in dup]}")


def check_not_null(df: DataFrame, keys: list[str], what: str) -> None:
    """NOT NULL part of a primary key."""
    n = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys]).first()
    if any(n):
        raise LoadError(f"{what}: null key values: { {k: n[k] for k in keys if n[k]} }")


def check_daily_keys(rows: DataFrame, date_is_dt: bool = False, existing: DataFrame | None = None) -> None:
    """The primary key (location_id, date) of daily rows: not null, once, and in no other stored day."""
    what = "stg_weather_daily"
    keys = rows.select("dt", "location_id", "date")
    check_not_null(keys, ["dt", "location_id", "date"], what)
    if date_is_dt:
        wrong = keys.where(F.col("date") != F.col("dt")).limit(5).collect()
        if wrong:
            raise LoadError(f"{what}: date differs from dt: {[tuple(r) for r in wrong]}")
    elif existing is not None:
        old = (existing.select("dt", "location_id", "date")
               .join(keys.select("location_id", "date").distinct(), ["location_id", "date"], "left_semi")
               .join(keys.select("dt").distinct(), "dt", "left_anti"))
        keys = keys.unionByName(old)
    check_unique(keys, ["location_id", "date"], what)


def load_daily_replace_dt(spark: SparkSession, rows: DataFrame, root: str,
                          check_keys: bool = True, date_is_dt: bool = False,
                          change: Change | None = None, table: str = TABLE) -> None:
    """Replace the dt partitions present in ``rows``; other days survive.

    ``date_is_dt``: the rows' date must be their dt (the gate's rule). Then a key
    can only collide with rows of its own, replaced day, and nothing stored is
    read. Otherwise the stored keys of other days are joined with the new ones.
    """
    own = change or Snapshots(spark, root).begin()
    if check_keys:
        check_daily_keys(rows, date_is_dt, None if date_is_dt else own.read(table))
    own.replace_partitions(table, rows.hint("rebalance", "dt").sortWithinPartitions("dt", "location_id", "date"), "dt")
    if change is None:
        own.commit()


def load_locations_full(rows: DataFrame, root: str, change: Change | None = None, table: str = TABLE) -> None:
    """DELETE all + INSERT: the table becomes exactly ``rows``."""
    own = change or Snapshots(rows.sparkSession, root).begin()
    own.replace(table, rows)
    if change is None:
        own.commit()


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` whose key is not updated, plus all ``updates``."""
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates)


def upsert_into(spark: SparkSession, updates: DataFrame, root: str, keys: list[str],
                partition_by: str | None = None, change: Change | None = None, table: str = TABLE) -> None:
    """Upsert into the table at ``root``; a key may occur once in ``updates``.

    Unpartitioned: the merged table is written whole. Partitioned by
    ``partition_by``: only the affected partitions are rewritten (those of the
    updates and those their keys move out of); one that all rows left goes. The
    names of the affected partitions come to the driver, which writes them into
    the commit record.
    """
    own = change or Snapshots(spark, root).begin()
    check_not_null(updates, keys, root)
    check_unique(updates, keys, root)
    target = own.read(table)
    p = partition_by
    if target is None:
        own.replace(table, updates, p)
    elif not p:
        own.replace(table, upsert_by_key(target.select(*updates.columns), updates, keys))
    else:
        target = target.select(*updates.columns)
        moved = target.join(updates.select(*keys).distinct(), keys, "left_semi").select(p)
        affected = {r[0] for r in updates.select(p).union(moved).distinct().select(F.col(p).cast("string")).collect()}
        # a null partition has a folder name of its own: it is always read
        old = own.read(table, keep=lambda v: v in affected or v.startswith("__HIVE")).select(*updates.columns)
        old = old.where(F.col(p).cast("string").isin(sorted(affected - {None})) | (F.col(p).isNull() if None in affected else F.lit(False)))
        merged = upsert_by_key(old, updates, keys)
        own.replace_partitions(table, merged.hint("rebalance", p), p, drop=affected - {None})
    if change is None:
        own.commit()
