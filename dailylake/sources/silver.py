"""Silver layer: partitioned Parquet sink (K2), scan (S3), partition listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailylake.session import folder_names, path_exists


class SchemaDriftError(ValueError):
    pass


def write_silver(df: DataFrame, root: str) -> None:
    """Overwrite the ``dt`` partitions present in ``df``; others survive (dynamic mode).

    ``rebalance`` lets AQE size the output: a small day becomes one file, a
    day holding a third of the data is split over several tasks. Rows are
    clustered by location and date inside each file so that Parquet min/max
    statistics skip row groups for location/date filters.
    """
    (df.hint("rebalance", "dt")
       .sortWithinPartitions("dt", "location_id", *(["date"] if "date" in df.columns else []))
       .write.mode("overwrite").partitionBy("dt").parquet(root))


def read_silver(spark: SparkSession, root: str, dt=None, dt_from=None, dt_to=None,
                schema: T.StructType | None = None) -> DataFrame:
    """Scan silver; ``dt`` / range filters prune partitions before any file is opened.

    A single day lists its own folder only, if it is there. With ``schema`` the
    files are read by it and not by what a footer says: a column of another type
    fails (on the sampled footer at once, elsewhere in the scan). A column that the
    files don't have stays away, for the gate's rule on required columns.
    """
    if dt is None and dt_from is not None and str(dt_from) == str(dt_to):
        dt = dt_from
    day = f"{root}/dt={dt}"
    path = day if dt is not None and path_exists(spark, day) else root
    df = spark.read.option("basePath", root).parquet(path)
    if schema is not None:
        kinds = {f.name: f.dataType for f in df.schema.fields if f.name != "dt"}
        drifted = [f"{f.name} is {kinds[f.name].simpleString()}, not {f.dataType.simpleString()}"
                   for f in schema.fields if f.name in kinds and kinds[f.name] != f.dataType]
        if drifted:
            raise SchemaDriftError(f"{path}: {'; '.join(drifted)}")
        own = T.StructType([f for f in schema.fields if f.name in kinds or f.name == "dt"])
        df = spark.read.schema(own).option("basePath", root).parquet(path)
    df = df.withColumn("dt", F.col("dt").cast("date"))
    if dt is not None:
        return df.where(F.col("dt") == F.lit(str(dt)).cast("date"))
    if dt_from is not None:
        df = df.where(F.col("dt") >= F.lit(dt_from).cast("date"))
    if dt_to is not None:
        df = df.where(F.col("dt") <= F.lit(dt_to).cast("date"))
    return df


def present_dts(spark: SparkSession, root: str) -> DataFrame:
    """Distinct ``dt`` partitions that hold a file with content (empty when the root is absent).

    The file system says so: files are listed by Spark (in tasks, where there are
    many folders) and none is opened.
    """
    if not folder_names(spark, root):
        return spark.createDataFrame([], "dt date")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("basePath", root).load(root).where("length > 0"))
    return files.select(F.col("dt").cast("date").alias("dt")).distinct()


def missing_dts(present: DataFrame, dt_from=None, dt_to=None) -> DataFrame:
    """Days without a partition, with the nearest days ``before`` and ``after`` that have one.

    The gaps between neighbouring days are unrolled, so the work is one row for a
    present day and one for a missing day. With ``dt_from`` and ``dt_to`` (columns or
    values) the days of that range count, otherwise those between the first and last
    present day. A day with neither neighbour means that nothing is there at all.
    """
    day = lambda v: F.lit(v if v is None else str(v)).cast("date")
    ends = present.sparkSession.range(1).select(F.explode(F.array(
        F.struct(F.date_sub(day(dt_from), 1).alias("dt"), F.lit(False).alias("real")),
        F.struct(F.date_add(day(dt_to), 1).alias("dt"), F.lit(False).alias("real")))).alias("e")).select("e.*").where("dt is not null")
    rows = present.select("dt", F.lit(True).alias("real")).unionByName(ends)
    w = Window.orderBy("dt", "real")  # one row for a day of the calendar
    real = F.when(F.col("real"), F.col("dt"))
    gaps = rows.select("dt", F.lead("dt").over(w).alias("next"), F.last(real, ignorenulls=True).over(w).alias("before"),
                       F.first(real, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("after"))
    days = F.explode(F.sequence(F.date_add("dt", 1), F.date_sub("next", 1)))
    out = gaps.where(F.datediff("next", "dt") > 1).select(days.alias("dt"), "before", "after")
    lo, hi = day(dt_from), day(dt_to)
    if dt_from is not None:
        out = out.where(F.col("dt") >= lo)
    return out.where(F.col("dt") <= hi) if dt_to is not None else out


def partition_hint(spark: SparkSession, root: str, dt, n: int = 3) -> str:
    """What there is in place of a missing partition: the nearest days with data, for messages."""
    day = F.lit(str(dt)).cast("date")
    near = (present_dts(spark, root).orderBy(F.abs(F.datediff("dt", day)), "dt").limit(n))
    found = sorted(str(r["dt"]) for r in near.collect())
    return f"no data of {dt} in {root}; nearest days with data: {', '.join(found) or 'none'}"
