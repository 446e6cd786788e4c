"""Branch-and-bound search against a full scan."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailylake.llm import topk


def plain(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in ok if i % every == 0}:
        best = {}
        for _, qv in (r for r in ok if r[0] == q):
            for i, v in ok:
                if i != q and len(v) == len(qv):
                    best[i] = max(best.get(i, -10**18), sum(a * b for a, b in zip(v, qv)))
        out |= {(q, n + 1, i, s) for n, (i, s) in enumerate(sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k])}
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("block", F.lit(1))
    return [tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).select("query_id", "rank", "vec_id", "score").collect()]


def test_search(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 97)
    monkeypatch.setattr(topk, "ROUND_BYTES", 3 * 8 * 21)
    monkeypatch.setattr(topk, "TASK_ROWS", 150)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=20)]) for i in range(400)]
    same = rows[7][1]
    rows += [(i, same) for i in range(400, 560)]  # a third of the rows are one vector: ties
    rows += [(600, None), (601, [1.0, None]), (602, [float("nan")] * 20), (603, [float("inf")] * 20), (None, same), (650, [0.5]), (651, [0.25]), (700, []), (701, []), (100, same), (7, same), (7, same)]
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_small_and_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0, -0.001])]) == []
    assert set(run(spark, [(0, [1.0, -0.001]), (50, [1.0, 1.0])])) == {(0, 1, 50, 256 * 256 - 256), (50, 1, 0, 256 * 256 - 256)}


def test_bounds_drop_candidates():
    rng = np.random.default_rng(1)
    rows = rng.integers(-60, 60, (3000, 64)) * np.r_[np.full(16, 10), np.ones(48, int)]
    found = topk.search_block(np.array([-1]), rows[:1] + 1, np.arange(3000), rows, 5)
    scores = rows @ (rows[0] + 1)
    assert [s for _, _, s in found] == sorted(scores.tolist(), reverse=True)[:5]


def test_repeated_ids_take_one_place():
    rows = np.zeros((10, 16), int)
    rows[:, 0] = [100] * 5 + [99, 98, 97, 96, 95]
    ids = np.array([1] * 5 + [2, 3, 4, 5, 6])
    query = np.eye(1, 16, dtype=int)
    assert topk.search_block(np.array([0]), query, ids, rows, 5) == [(0, 1, 100), (0, 2, 99), (0, 3, 98), (0, 4, 97), (0, 5, 96)]
    assert topk.search_block(np.array([0]), query, ids, rows, 7) == [(0, i, s) for i, s in zip(range(1, 7), range(100, 94, -1))]


def test_repeated_ids_with_distinct_scores(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=20)]) for i in range(120)]
    rows += [rows[i] for i in range(0, 120, 3) for _ in range(6)]  # rows that repeat as a whole
    rows += [(i, [float(np.float32(x)) for x in rng.normal(size=20) * 3]) for i in [50] * 9 + [7] * 60 + [8] * 60]  # ids with several vectors
    assert set(run(spark, rows)) == plain(rows)


def test_an_id_with_many_vectors_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(topk, "TASK_ROWS", 50)
    rows = [(50, [1.0, 1.0]), (50, [2.0, 0.0])] + [(7, [float(i), 1.0]) for i in range(400)] + [(i, [1.0, float(i)]) for i in range(100, 150)]
    assert set(run(spark, rows)) == plain(rows)


def test_components_too_large_for_a_score_fail(spark):
    rows = [(0, [1.0, 2.0]), (1, [float(2**20), 0.0])]
    assert run(spark, rows) == [(0, 1, 1, 2**36)]
    for x in (2.0**30, 1e30):
        with pytest.raises(Exception, match="too large for scores of 64 bits"):
            run(spark, rows + [(2, [x, 0.0])])


def test_rows_are_shuffled_once_whatever_the_rounds(spark, monkeypatch):
    """The plan of a round reads the written rows and exchanges winners only."""
    plans = []
    keep = topk.materialize
    monkeypatch.setattr(topk, "materialize", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or keep(df, name))
    monkeypatch.setattr(topk, "ROUND_BYTES", 200)
    run(spark, [(i, [1.0, float(i)]) for i in range(500)])
    rounds = [p for name, p in plans if name == "winners"]
    assert len(rounds) > 1 and all(p.count("Exchange hashpartitioning(query_id") == 1 and p.count("Exchange") == 1 for p in rounds)
