"""Bronze layer: envelope build (K1) and JSON scan.

Envelope: ``metadata`` (dt, location_id, location_name, ingested_at, source,
api_version, request{q, endpoint}) + raw ``payload``. Files land as
``dt=<dt>/.../raw.json`` (one pretty-printed object per file) when written by
an ingestion client, or as JSON Lines part files when written by Spark; the
reader's ``landed`` switch picks ``multiLine`` and the file-name filter
accordingly (``multiLine`` on a JSON Lines file would silently return only
its first record).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.schemas import BRONZE, CORRUPT
from dailylake.session import delete_path, folder_names, scratch_path


def _s(c) -> Column:
    """Leaf value as JSON text, the way the API delivers numbers and codes."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def build_envelopes(obs: DataFrame, locations: DataFrame, ingested_at: Column | None = None,
                    source: str = "api", api_version: str = "v1",
                    endpoint: str = "history.json") -> DataFrame:
    """Bronze records for observation rows joined to their location.

    ``obs``: location_id, date and the daily measures (see ``schemas.BRONZE_DAY``
    field names in ``DAY_FIELDS``); ``locations``: registry rows. Output has
    the envelope columns plus ``dt`` (the partition value).
    """
    loc = (locations.select(
        "location_id", F.col("name").alias("_name"), F.col("region").alias("_region"),
        F.col("country").alias("_country"), F.col("lat").alias("_lat"),
        F.col("lon").alias("_lon"), F.col("tz").alias("_tz")))
    j = obs.join(loc, "location_id", "left")
    ing = ingested_at if ingested_at is not None else F.col("ingested_at")
    day = F.struct(
        *[_s(src).alias(dst) for dst, src in DAY_FIELDS],
        F.struct(_s("condition_code").alias("code"), _s("condition_text").alias("text"))
        .alias("condition"))
    payload = F.struct(
        F.struct(F.col("_name").alias("name"), F.col("_region").alias("region"),
                 F.col("_country").alias("country"), _s("_lat").alias("lat"),
                 _s("_lon").alias("lon"), F.col("_tz").alias("tz_id"),
                 F.date_format(F.col("date").cast("timestamp"), "yyyy-MM-dd HH:mm")
                 .alias("local_time")).alias("location"),
        F.struct(F.array(F.struct(_s("date").alias("date"), day.alias("day")))
                 .alias("forecastday")).alias("forecast"))
    metadata = F.struct(
        (F.col("dt").cast("string") if "dt" in obs.columns else _s("date")).alias("dt"),
        F.col("location_id"),
        F.coalesce(F.col("_name"), F.col("location_id")).alias("location_name"),
        F.date_format(ing, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingested_at"),
        F.lit(source).alias("source"), F.lit(api_version).alias("api_version"),
        F.struct(F.concat_ws(",", _s("_lat"), _s("_lon")).alias("q"),
                 F.lit(endpoint).alias("endpoint")).alias("request"))
    dt = F.col("dt").cast("string") if "dt" in obs.columns else _s("date")
    return j.select(dt.alias("dt"),
                    metadata.alias("metadata"), payload.alias("payload"))


# (payload field, observation column)
DAY_FIELDS = [("mintemp_c", "temp_min_c"), ("maxtemp_c", "temp_max_c"),
              ("avgtemp_c", "temp_avg_c"), ("totalprecip_mm", "precip_mm"),
              ("totalsnow_cm", "snow_cm"), ("avghumidity", "humidity_avg"),
              ("maxwind_kph", "wind_max_kph")]


def _one_per_key(envelopes: DataFrame) -> DataFrame:
    """The last record of each (dt, location_id): by ingestion time, then by content."""
    rows = envelopes.select("dt", "metadata", "payload", F.col("metadata.location_id").alias("_id"),
                            F.to_json(F.struct("metadata", "payload")).alias("_text"))
    order = F.struct(F.col("metadata.ingested_at").try_cast("timestamp"), "_text")
    last = rows.groupBy("dt", "_id").agg(F.max_by(F.struct("metadata", "payload"), order).alias("r"))
    return last.select("dt", "r.metadata", "r.payload")


def write_bronze(envelopes: DataFrame, root: str, partition_by: tuple[str, ...] = ("dt",)) -> None:
    """Write envelopes as JSON Lines; a record replaces the stored one of its (dt, location_id).

    One folder per day by default, so that many locations do not turn into many
    tiny files: the day's other stored records are merged in and the day is
    rewritten (dynamic overwrite; the merged days pass through the shared scratch
    folder, since a job cannot overwrite files that it reads). Only the folders of
    the days written are opened; their names come to the driver, one for a day.
    ``partition_by=("dt", "location_id")`` has a folder per key and rewrites only
    those written. Of several records of a key the one ingested last is kept.
    """
    spark = envelopes.sparkSession
    out = _one_per_key(envelopes)
    if "location_id" in partition_by:
        out = out.withColumn("location_id", F.col("metadata.location_id"))
    scratch = None
    stored = set(folder_names(spark, root)) if tuple(partition_by) == ("dt",) else set()
    if stored:
        scratch = scratch_path(spark, "bronze-merge")
        out.write.parquet(f"{scratch}/new")
        out = new = spark.read.parquet(f"{scratch}/new")
        days = [r["dt"] for r in new.select("dt").distinct().collect() if f"dt={r['dt']}" in stored]
        if days:
            keys = new.select("dt", F.col("metadata.location_id").alias("_id")).alias("k")
            old = read_bronze(spark, root, days=days).select("dt", "metadata", "payload").alias("o")
            kept = old.join(keys, (F.col("o.dt") == F.col("k.dt"))
                            & F.col("o.metadata.location_id").eqNullSafe(F.col("k._id")), "left_anti")
            new.unionByName(kept).write.parquet(f"{scratch}/days")
            out = spark.read.parquet(f"{scratch}/days")
    (out.hint("rebalance", *partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).json(root))
    if scratch:
        delete_path(spark, scratch)


def read_bronze(spark: SparkSession, root: str, dt: str | None = None,
                landed: bool = False, days: list[str] | None = None,
                keep_malformed: bool = False) -> DataFrame:
    """Scan bronze with the explicit envelope schema; a malformed file fails the job.

    Adds ``dt`` (from the partition folder, as text) and, for landed files,
    ``source_file`` (listing order, used by keep-last; the part files of a Spark
    write have no meaningful order). ``location_id`` is *not* taken from the
    path: identity is ``metadata.location_id``. With ``dt`` or ``days`` only those
    days' folders are listed. ``keep_malformed``: records that are no envelope or
    whose dates don't parse don't fail the scan; they have true in a further
    column ``malformed``, and all rows have their ``source_file``.
    """
    r = (spark.read.schema(CORRUPT if keep_malformed else BRONZE)
         .option("mode", "PERMISSIVE" if keep_malformed else "FAILFAST")
         .option("columnNameOfCorruptRecord", "_corrupt")
         .option("multiLine", landed))
    if landed:
        r = r.option("pathGlobFilter", "*raw.json")
    folders = [f"{root}/dt={d}" for d in (days if days is not None else [] if dt is None else [dt])]
    df = r.option("basePath", root).json(folders or root)
    if "dt" not in df.columns:
        raise ValueError(f"bronze root {root} is not partitioned by dt")
    file = [F.col("_metadata.file_path").alias("source_file")] if landed or keep_malformed else []
    if keep_malformed:
        stated = F.get("payload.forecast.forecastday", 0)["date"]
        bad = (F.col("_corrupt").isNotNull() | F.col("metadata").isNull() | F.col("dt").try_cast("date").isNull()
               | (stated.isNotNull() & stated.try_cast("date").isNull()))
        file.append(F.coalesce(bad, F.lit(False)).alias("malformed"))
    return df.select("dt", "metadata", "payload", *file)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when ``df`` is empty; cheap on a scan, a whole run below an aggregate."""
    if df.limit(1).count() == 0:
        raise ValueError(f"no {what} found")
    return df
