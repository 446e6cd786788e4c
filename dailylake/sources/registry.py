"""Location registry (S1): a seed DataFrame with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.schemas import REGISTRY


class RegistryError(ValueError):
    pass


def registry_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Registry from configuration rows (a parsed YAML list); empty -> error."""
    if not rows:
        raise RegistryError("no locations configured")
    cols = [f.name for f in REGISTRY.fields]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], REGISTRY)


def validate_registry(reg: DataFrame) -> DataFrame:
    """Fail on an empty registry or a location without coordinates.

    One aggregate pass; returns the registry unchanged when it is valid.
    """
    chk = reg.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("lat").isNull() | F.col("lon").isNull()).alias("no_coord"),
                  F.min(F.when(F.col("lat").isNull() | F.col("lon").isNull(),
                               F.col("location_id"))).alias("first_bad")).first()
    if chk["n"] == 0:
        raise RegistryError("no locations found in the registry")
    if chk["no_coord"]:
        raise RegistryError(f"location {chk['first_bad']} is missing lat/lon "
                            f"({chk['no_coord']} locations without coordinates)")
    return reg
