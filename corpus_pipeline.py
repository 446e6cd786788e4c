"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. quality: documents that the quality classifier finds bad or toxic go.
2. simhash: of each near-duplicate group the document with the smallest id stays (of its
   repeated rows one).
3. decontamination: documents that contain a benchmark item go.
4. pii: personal data in the text is replaced by its kind; ``n_chars`` follows.
5. byte_bpe: the text as token ids, beside the columns of ``documents``.

Nulls: a null text passes all stages (it is one near-duplicate group with the empty texts),
a null id is kept apart like any other id, and null labels or benchmark texts don't count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dailylake.llm import bpe, decontaminate, pii, quality, simhash
from dailylake.llm.common import materialize, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.with_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("simhash", keep_first),
    ("decontamination", keep_clean),
    ("pii", redact),
    ("byte_bpe", tokenize),
]

#: The stages' models, hashes and parsers can't be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
