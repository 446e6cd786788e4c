"""Extendible hashing against one-split-at-a-time; pages; files."""

import hashlib
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dailylake.llm import sharding
from dailylake.session import scratch_path


def plain(rows, limit):
    """Shard bits of every hash, splitting one bucket at a time."""
    h = lambda i, t: int(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:15], 16)
    own = [(h(i, t), len((t or "").encode())) for i, t in rows]
    out, todo = {}, [("", own)]
    while todo:
        bits, part = todo.pop()
        if not part:
            continue
        if sum(b for _, b in part) <= limit or len({x for x, _ in part}) == 1:
            out |= {x: (bits, sum(b for _, b in part)) for x, _ in part}
        else:
            for c in "01":
                todo.append((bits + c, [(x, b) for x, b in part if format(x, "060b")[len(bits)] == c]))
    return [(i, *out[x], b) for (i, t), (x, b) in zip(rows, own)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("depth", F.lit("x")).withColumn("cell", F.lit(1))


@pytest.mark.parametrize("limit,step", [(400, 1), (5000, 6), (10**9, 6)])
def test_shards(spark, monkeypatch, limit, step):
    monkeypatch.setattr(sharding, "STEP", step)
    monkeypatch.setattr(sharding, "SPARE", 0)
    rng = random.Random(limit)
    rows = [(i, "é" * rng.choice([0, 3, 30, 150])) for i in range(300)] + [(1000, "big" * 4000), (1001, None), (None, "x"), (5, "same"), (5, "same")]
    got = sharding.assign(frame(spark, rows), limit, columns=["doc_id"]).collect()
    assert len(got) == len(rows)
    want = sorted(plain(rows, limit), key=str)
    assert sorted(((r.doc_id, r.llm_shard, r.llm_shard_bytes, r.llm_bytes) for r in got), key=str) == want
    assert all(r.llm_depth == len(r.llm_shard) and r.llm_page == 0 for r in got)


def test_rows_all_alike_go_to_pages(spark):
    rows = [(1, "x" * 10)] * 333 + [(i, "y" * 10) for i in range(2, 50)]
    got = sharding.assign(frame(spark, rows).repartition(5), 100, columns=["doc_id"]).collect()
    by = defaultdict(list)
    for r in got:
        by[r.llm_shard, r.llm_page].append(r)
    assert len(got) == len(rows) and all(sum(r.llm_bytes for r in v) <= 100 for v in by.values())
    assert all(len(v) == v[0].llm_shard_docs and sum(r.llm_bytes for r in v) == v[0].llm_shard_bytes for v in by.values())
    assert sum(page > 0 for _, page in by) == 33


def test_files(spark):
    rows = [(i, "z" * 40) for i in range(100)]
    df = frame(spark, rows)
    path = scratch_path(spark, "shards")
    sharding.write(df, path, 500)
    back = spark.read.parquet(path)
    assert back.drop("shard").columns == df.columns
    sizes = back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).collect()
    assert sum(r.n for r in sizes) == 4000 and max(r.n for r in sizes) <= 500
    assert sharding.assign(df.limit(0), columns=["doc_id"]).count() == 0


def test_clashing_columns(spark):
    """Columns named as the operator's own words stay as they are, in rows and files."""
    own = ["entry", "shard", "prefix", "bytes", "docs", "at", "low", "high", "fits", "parent", "bits"]
    df = frame(spark, [(i, "z" * 40) for i in range(60)])
    for i, c in enumerate(own):
        df = df.withColumn(c, F.lit(i))
    got = sharding.assign(df, 500)
    assert got.columns == [*df.columns, "llm_shard", "llm_depth", "llm_page", "llm_bytes", "llm_shard_bytes", "llm_shard_docs"]
    want = {r.doc_id: r.llm_shard for r in sharding.assign(frame(spark, [(i, "z" * 40) for i in range(60)]), 500).collect()}
    assert {r.doc_id: r.llm_shard for r in got.collect()} == want and {tuple(r) for r in got.select(own).distinct().collect()} == {tuple(range(len(own)))}
    path = scratch_path(spark, "shards")
    sharding.write(df, path, 500)
    back = spark.read.parquet(path)
    assert back.drop("llm_shard").columns == df.columns and back.count() == 60 and {r.shard for r in back.collect()} == {1}
    assert sorted(os.listdir(path.removeprefix("file:")))[-1].startswith("llm_shard=b")


def test_native(spark):
    plan = sharding.assign(frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
