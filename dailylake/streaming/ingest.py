"""Incremental pickup of newly landed bronze files (the daily schedule, Spark-native).

A file-source Structured Streaming query over the bronze root, triggered
with ``availableNow``: each invocation processes exactly the files that
arrived since the previous one (the source's file log and the checkpoint live
under ``spark.checkpoint.dir``), then stops. Each micro-batch only yields the
days (``dt``) it touched; those days are rebuilt from *all* their bronze files
through the regular day-grouped pipeline (silver, gate, staging), so a day
whose files arrive over several invocations ends up exactly as a single run
over the complete day would leave it; days between them that the batch did not
touch stay as they are. Days with malformed files or that fail the gate are
recorded in the run log and hold nothing up; a fault of the cluster fails the
batch, which comes again.
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailylake.operators.load import LoadError
from dailylake.operators.quality import QualityConfig, QualityGateError
from dailylake.plans import pipeline as PL
from dailylake.schemas import BRONZE
from dailylake.session import checkpoint_root, scratch_path

STREAM_SCHEMA = T.StructType(BRONZE.fields + [T.StructField("dt", T.StringType())])


def bronze_stream(spark: SparkSession, root: str, landed: bool = True,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(STREAM_SCHEMA).option("multiLine", landed)
    if landed:
        r = r.option("pathGlobFilter", "*raw.json")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(root)


def process_new_files(spark: SparkSession, paths: PL.LakePaths, landed: bool = True,
                      cfg: QualityConfig = QualityConfig(), locations_mode: str = "upsert",
                      registry: DataFrame | None = None, name: str = "bronze_pickup",
                      max_files_per_trigger: int | None = None) -> list[tuple[str, str]]:
    """Run the pipeline for every day touched by newly landed files; returns the
    first and last day of each micro-batch that was loaded."""
    done: list[tuple[str, str]] = []

    def batch(df: DataFrame, epoch_id: int) -> None:
        scratch = scratch_path(spark, "touched")
        df.select(F.col("dt").cast("date").alias("dt")).distinct().write.parquet(scratch)
        days = spark.read.parquet(scratch)
        lo, hi = days.agg(F.min("dt").cast("string"), F.max("dt").cast("string")).first()
        if lo is None:
            return
        try:
            PL.run(spark, paths, lo, hi, cfg=cfg, landed=landed, locations_mode=locations_mode,
                   registry=registry, with_gold=False, strict=False, days=days)
            done.append((lo, hi))
        except (QualityGateError, LoadError) as e:
            # the data's fault, logged by the run: the days can be run again by hand. Any other
            # error fails the batch, which the next call replays.
            logging.getLogger(__name__).warning("pickup of %s..%s failed: %s", lo, hi, e)

    ckpt = os.path.join(checkpoint_root(spark), "streams", name)
    q = (bronze_stream(spark, paths.bronze, landed, max_files_per_trigger)
         .select("dt").writeStream.foreachBatch(batch)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return done
