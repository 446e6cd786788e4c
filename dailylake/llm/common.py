"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dailylake.session import scratch_path

#: Text bytes that one step of a Python task holds at a time.
CHUNK_BYTES = 12 << 20


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage in a way that outlives executors: the folder is the one that
    ``spark.checkpoint.dir`` names.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(batches: Iterable[pa.RecordBatch], text_col: int = 1,
           limit: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """Regroup Arrow batches into tables of about ``limit`` bytes of text (one row at least)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        parts = max(1, math.ceil(batch.column(text_col).nbytes / limit))
        step = max(1, math.ceil(rows / parts))
        for at in range(0, rows, step):
            piece = batch.slice(at, step)
            n = piece.column(text_col).nbytes
            if held and size + n > limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(piece)
            size += n
    if held:
        yield pa.Table.from_batches(held)
