"""Run log (K8): one appended row per day and run, derived from the gate report."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailylake.schemas import PIPELINE_RUNS


def utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def log_days(outcome: DataFrame, root: str, started: _dt.datetime,
             loaded: DataFrame | None = None, warning: str | None = None) -> None:
    """Append one row per day of ``outcome`` (dt, failed_rule) to the run log.

    ``loaded``: (dt, records_loaded) for the days that reached staging;
    ``warning`` stands in the summary of successful days. The rows are built from
    DataFrames (one per day), not on the driver.
    """
    finished = utc_now()
    df = outcome if loaded is None else outcome.join(loaded, "dt", "left")
    if loaded is None:
        df = df.withColumn("records_loaded", F.lit(None).cast("int"))
    rows = df.select(
        F.expr("uuid()").alias("run_id"), F.col("dt").cast("date").alias("dt"),
        F.when(F.col("failed_rule").isNull(), "success").otherwise("failed").alias("status"),
        F.lit(started).cast("timestamp_ntz").alias("started_at"),
        F.lit(finished).cast("timestamp_ntz").alias("finished_at"),
        F.lit(round((finished - started).total_seconds(), 3)).cast("decimal(18,3)").alias("duration_sec"),
        F.col("records_loaded").cast("int").alias("records_loaded"),
        F.coalesce("failed_rule", F.lit(warning)).alias("error_summary"))
    rows.select(*[f.name for f in PIPELINE_RUNS.fields]).write.mode("append").parquet(root)
