"""Sharding by extendible hashing.

Rows are hashed; a shard is a prefix of hash bits. One bucket holds all rows at first, and
only a bucket over the byte limit splits, on its next bit, until every shard fits. The sizes
of all prefixes come from sums over cells (prefixes of the greatest depth of a round), so a
round does many splits at once: a bucket is a shard if it fits and its parent doesn't. The
directory has an entry for each cell, which names the shard that the cell belongs to, and
rows find their shard by the bits of their cell. Buckets that still don't fit go to the next
round, with their rows alone. Rows that are alike in id and text share all bits; if they
exceed the limit together, they are dealt to numbered pages of their shard.

Everything is DataFrame functions; the directory is a distributed table.

Edge cases: null ids and texts count as empty; empty texts have no bytes; one row over the
limit has a shard (or page) of its own; repeated rows are each placed; an empty table has no
shard; other columns are carried by ``write`` and ignored by the query.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailylake.llm.common import materialize

BITS = 60
#: Text bytes of a shard at most: what a reader shuffles in memory at once.
LIMIT = 1 << 20
#: Bits by which the first round looks below the even split, and bits of each later round.
SPARE = 3
STEP = 6


def row_hash(id_col: Column, text_col: Column) -> Column:
    """The first 60 bits of the MD5 of id and text."""
    key = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text_col, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: int) -> Column:
    """The first ``depth`` of the 60 bits."""
    return F.shiftright(h, BITS - depth)


def directory(rows: DataFrame, base: int, depth: int, limit: int) -> DataFrame:
    """``llm_entry`` (the first ``depth`` bits) of every bucket that fits below ``base``, and its shard.

    ``rows``: ``llm_hash`` and ``llm_bytes`` of rows whose buckets at ``base`` don't fit.
    """
    sums = [F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"), F.min("low").alias("low"), F.max("high").alias("high")]
    cells = materialize(rows.groupBy(_prefix(F.col("llm_hash"), depth).alias("cell")).agg(F.sum("llm_bytes").alias("bytes"), F.count("*").alias("docs"), F.min("llm_hash").alias("low"), F.max("llm_hash").alias("high")), "cells")
    levels = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright("cell", depth - d).alias("prefix")) for d in range(base, depth + 1)])).alias("at")
    buckets = cells.select(levels, "bytes", "docs", "low", "high").groupBy("at.depth", "at.prefix").agg(*sums)
    buckets = materialize(buckets.withColumn("fits", (F.col("bytes") <= limit) | (F.col("low") == F.col("high"))), "buckets")
    split = buckets.where("not fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    below = buckets.where("fits").withColumn("parent", F.shiftright("prefix", 1))
    shards = below.join(split, ["depth", "parent"], "left_semi")
    if base == 0:  # the one bucket of the start has no parent
        shards = shards.unionByName(below.where("depth = 0"))
    # all entries that share the shard's bits
    width = F.expr(f"shiftleft(1L, {depth} - depth)")
    entries = F.explode(F.sequence(F.col("prefix") * width, (F.col("prefix") + 1) * width - 1)).alias("llm_entry")
    named = shards.withColumn("bits", F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), BITS, "0")).withColumn("shard", F.expr(f"substring(bits, {BITS + 1} - depth, depth)"))
    return named.select(entries, F.col("shard").alias("llm_shard"), F.col("depth").alias("llm_depth"), F.col("bytes").alias("llm_shard_bytes"), F.col("docs").alias("llm_shard_docs"))


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Deal the rows of shards over the limit (all alike) to pages that fit.

    Rows are numbered within the part of the input that a task wrote, and parts by their
    place, so no task needs all rows of a shard.
    """
    rows = materialize(rows.withColumn("llm_part", F.spark_partition_id()), "alike")
    parts = rows.groupBy("llm_shard", "llm_part").agg(F.count("*").alias("llm_n"))
    before = Window.partitionBy("llm_shard").orderBy("llm_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("llm_shard", "llm_part", F.coalesce(F.sum("llm_n").over(before), F.lit(0)).alias("llm_start"))
    number = F.row_number().over(Window.partitionBy("llm_shard", "llm_part").orderBy("llm_hash")) - 1
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.col("llm_bytes"))))
    dealt = rows.withColumn("llm_number", number).join(starts, ["llm_shard", "llm_part"])
    dealt = dealt.withColumn("llm_page", F.floor((F.col("llm_start") + F.col("llm_number")) / room).cast("int"))
    held = F.least(room, F.col("llm_shard_docs") - F.col("llm_page") * room)
    return dealt.withColumn("llm_shard_bytes", held * F.col("llm_bytes")).withColumn("llm_shard_docs", held)


def assign(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The columns asked for, and for every row ``llm_shard`` (bits), ``llm_depth``, ``llm_page``,
    ``llm_bytes``, ``llm_shard_bytes``, ``llm_shard_docs``."""
    columns = docs.columns if columns is None else columns
    text = F.col(text_col)
    rows = materialize(docs.select(*columns, row_hash(F.col(id_col), text).alias("llm_hash"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("llm_bytes")), "rows")
    total = rows.agg(F.sum("llm_bytes")).first()[0] or 0
    base, depth = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE)
    placed = []
    while True:
        entries = directory(rows, base, depth, limit)
        found = materialize(rows.withColumn("llm_entry", _prefix(F.col("llm_hash"), depth)).join(entries, "llm_entry", "left").drop("llm_entry"), "placed")
        placed.append(found.where("llm_shard is not null"))
        rows = found.where("llm_shard is null").select(*columns, "llm_hash", "llm_bytes")
        if not rows.limit(1).count():
            break
        base, depth = depth, min(BITS, depth + STEP)
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    kept = [*columns, "llm_shard", "llm_depth", "llm_page", "llm_bytes", "llm_shard_bytes", "llm_shard_docs"]
    over = out.where(F.col("llm_shard_bytes") > limit)
    return out.where(F.col("llm_shard_bytes") <= limit).withColumn("llm_page", F.lit(0)).select(kept).unionByName(_paged(over, limit).select(kept))


def write(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows as Parquet, one folder for each shard and page; a shard's rows meet in one task.

    The folders' column is ``shard``, or ``llm_shard`` where the rows have a column of that name.
    """
    out = assign(docs, limit, id_col, text_col)
    folder = "llm_shard" if "shard" in docs.columns else "shard"
    name = F.concat(F.lit("b"), F.col("llm_shard"), F.when(F.col("llm_page") > 0, F.concat(F.lit("-"), F.col("llm_page"))).otherwise("")).alias(folder)
    out.select(*docs.columns, name).repartition(folder).write.partitionBy(folder).parquet(path)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the shard of every document."""
    out = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), columns=["doc_id"])
    return out.select("doc_id", *[F.col(f"llm_{c}").alias(c) for c in ("shard", "depth", "page")], F.col("llm_bytes").alias("n_bytes"), F.col("llm_shard_bytes").alias("shard_bytes"), F.col("llm_shard_docs").alias("shard_docs"))


SHARDS_SQL = f"""
WITH rows AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
levels AS (SELECT CAST(unnest(range(0, 31)) AS INTEGER) AS depth),
buckets AS (
  SELECT depth, h >> (60 - depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs, count(DISTINCT h) AS kinds
  FROM rows, levels GROUP BY 1, 2),
shards AS (
  SELECT b.* FROM buckets b LEFT JOIN buckets p ON p.depth = b.depth - 1 AND p.prefix = b.prefix >> 1
  WHERE (b.shard_bytes <= {LIMIT} OR b.kinds = 1) AND (p.depth IS NULL OR NOT (p.shard_bytes <= {LIMIT} OR p.kinds = 1)))
SELECT doc_id, right(lpad(bin(prefix), 60, '0'), depth) AS shard, depth, CAST(0 AS INTEGER) AS page, n_bytes, shard_bytes, shard_docs
FROM rows JOIN shards ON h >> (60 - depth) = prefix
"""
