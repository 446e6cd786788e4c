"""Exact top-k search by columnar branch-and-bound.

Queries go to the rows: rounds of ``ROUND_BYTES`` of query vectors at most are broadcast, and
each task of the candidates, which stay where they are, keeps the k best ids that it holds for
every query of the round. So the rows cross the shuffle once (to drop repetitions of an id
with its vector), whatever the number of queries, and after that only winners do. In a task
the candidates lie in vertical layout, one array for each dimension. Scores are accumulated
one block of dimensions at a time. After each block the mass that remains, the product of the
norms of the rest of the query and of the candidate, bounds every final score from both sides:
candidates whose upper bound is below the k-th highest lower bound (that of an id being the
highest of its rows), or below the k-th best score that the task has found in earlier
candidates, are compacted away, and the next block is read for the survivors only. Scores are
sums of 64-bit integers, and bounds carry a margin for rounding, so the result is exact.

Edge cases: a vector that is null, or holds null or a component that is not finite, takes no
part, nor does a row without id; vectors of different lengths are not compared; rows with
the query's id are the query's own; if an id occurs in several rows, its best score counts
once; ties go to the smaller id; a vector whose scaled components have a sum of squares of
2**62 or more, so that a score might not fit 64 bits, is an error; an empty table, or no
queries, gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailylake.llm.common import materialize

K = 5
SCALE = 256
#: Candidates that a task holds at a time, as 64-bit integers.
CANDIDATE_BLOCK = 8192
#: Rows of a task's part of the candidates, about.
TASK_ROWS = 1 << 16
#: Bytes of the query vectors that a round broadcasts, about.
ROUND_BYTES = 32 << 20
DIMENSIONS = 8

PAIRS = "query_id long, vec_id long, score long"


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double; null if the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = lambda v: F.floor(v * F.lit(float(scale)))
    squares = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.pow(v * F.lit(float(scale)) - 1, F.lit(2.0)))
    fits = squares + F.size(x) < F.lit(2.0**62)
    too_large = F.raise_error(F.lit("a vector's scaled components are too large for scores of 64 bits")).cast("array<bigint>")
    return F.when(usable & fits, F.transform(x, scaled)).when(usable, too_large)


def _norms(m: np.ndarray, starts: range) -> np.ndarray:
    """For each start of a block, the norm of the rest of every row, rounded up a little."""
    squares = (m.astype(np.float64) ** 2)[:, ::-1].cumsum(axis=1)[:, ::-1]
    return np.sqrt(np.stack([squares[:, s] if s < m.shape[1] else np.zeros(len(m)) for s in starts])) * (1 + 1e-9)


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, width: int = DIMENSIONS,
                 floors: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(query id, row id, score) of the k best ids of a block for every query.

    ``floors``: for each query a score that k other ids are known to reach; lower ones are left out.
    """
    dims = rows.shape[1]
    starts = range(0, dims + width, width) if dims else range(1)
    columns = np.ascontiguousarray(rows.T)  # vertical layout: a dimension's values lie together
    rest, query_rest = _norms(rows, starts), _norms(queries, starts)
    distinct, own_id = np.unique(ids, return_inverse=True)
    repeated = len(distinct) < len(ids)
    out = []
    for qn, (query_id, q) in enumerate(zip(query_ids.tolist(), queries)):
        alive = np.flatnonzero(ids != query_id)
        score = np.zeros(len(alive), np.int64)
        for bn, start in enumerate(starts[:-1]):
            for d in range(start, min(start + width, dims)):
                score += columns[d, alive] * q[d]
            if len(alive) <= k:
                continue
            mass = rest[bn + 1, alive] * query_rest[bn + 1, qn] + 1e-6
            if floors is not None and floors[qn] > -np.inf:
                keep = score + mass >= floors[qn]
                alive, score, mass = alive[keep], score[keep], mass[keep]
                if len(alive) <= k:
                    continue
            least = score - mass
            if repeated:  # k places for k ids: an id's rows have one place
                least = np.full(len(distinct), -np.inf)
                np.maximum.at(least, own_id[alive], score - mass)
                if len(least) <= k:
                    continue
            floor = np.partition(least, len(least) - k)[len(least) - k]
            keep = score + mass >= floor
            if not keep.all():
                alive, score = alive[keep], score[keep]
        order = np.lexsort((ids[alive], -score))
        seen: set[int] = set()
        for i in order:
            if len(seen) == k:
                break
            if (own := int(ids[alive[i]])) not in seen:
                seen.add(own)
                out.append((query_id, own, int(score[i])))
    return out


def _merged(found: list[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
    """The k best ids for each query, of several blocks' results."""
    if not found:
        return found
    q, i, s = np.array(found, np.int64).T
    order = np.lexsort((i, -s, q))
    out: list[tuple[int, int, int]] = []
    now, seen = None, set()
    for own, vec, score in zip(q[order].tolist(), i[order].tolist(), s[order].tolist()):
        if own != now:
            now, seen = own, set()
        if len(seen) < k and vec not in seen:
            seen.add(vec)
            out.append((own, vec, score))
    return out


def _winners(rows: DataFrame, queries: list[tuple[int, list[int]]], k: int) -> DataFrame:
    """The k best ids of each task's rows for every query of a round."""
    by: dict[int, list[tuple[int, list[int]]]] = {}
    for own, v in queries:
        by.setdefault(len(v), []).append((own, v))
    packed = {dims: (np.array([own for own, _ in some], np.int64), np.array([v for _, v in some], np.int64).reshape(len(some), dims)) for dims, some in by.items()}
    shared = rows.sparkSession.sparkContext.broadcast(packed)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int, int]]] = {dims: [] for dims in shared.value}
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def search(dims: int) -> None:
            parts = held.pop(dims)
            query_ids, vectors = shared.value[dims]
            # the k-th best score of each query so far; an id with several queries has the least of them
            floors = np.full(len(query_ids), -np.inf)
            ranked: dict[int, list[int]] = {}
            for own, _, score in best[dims]:
                ranked.setdefault(own, []).append(score)
            for n, own in enumerate(query_ids.tolist()):
                if repeated[dims].get(own, 1) == 1 and len(ranked.get(own, ())) >= k:
                    floors[n] = min(ranked[own])
            ids, block = (np.concatenate(c) for c in zip(*parts))
            best[dims] = _merged(best[dims] + search_block(query_ids, vectors, ids, block, k, floors=floors), k)

        repeated = {dims: dict(zip(*(x.tolist() for x in np.unique(q, return_counts=True)))) for dims, (q, _) in shared.value.items()}
        size: dict[int, int] = {}
        for batch in batches:
            lists = batch.column(1)
            flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            lengths = np.diff(offsets)
            for dims in np.unique(lengths).tolist():
                if dims not in shared.value:
                    continue
                at = np.flatnonzero(lengths == dims)
                ids = batch.column(0).to_numpy()[at]
                values = flat[(offsets[at][:, None] + np.arange(dims)).ravel()].reshape(len(at), dims)
                for a in range(0, len(at), CANDIDATE_BLOCK):
                    held.setdefault(dims, []).append((ids[a:a + CANDIDATE_BLOCK], values[a:a + CANDIDATE_BLOCK]))
                    size[dims] = size.get(dims, 0) + len(ids[a:a + CANDIDATE_BLOCK])
                    if size[dims] >= CANDIDATE_BLOCK:
                        search(dims)
                        size[dims] = 0
        for dims in list(held):
            search(dims)
        found = [r for some in best.values() for r in some]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["query_id", "vec_id", "score"])

    return rows.select("id", "v").mapInArrow(task, PAIRS)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the k best rows for each query.

    A task gives its k best ids, if it has that many, each with its best score there. An id
    among the k best of all is among those of the task that holds its best row.
    """
    shape = lambda df: (df.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col), scale).alias("v"))
                        .where("id is not null and v is not null"))
    spark = vectors.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-vectors.count() // TASK_ROWS))
    rows = materialize(shape(vectors).repartition(tasks, "id", "v").distinct(), "vectors")
    wanted = materialize(shape(queries).distinct(), "queries")
    rounds = max(1, -(-8 * (wanted.agg(F.sum(F.size("v") + 1)).first()[0] or 0) // ROUND_BYTES))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = None
    for r in range(rounds):
        own = wanted.where(F.pmod(F.xxhash64("id", "v"), F.lit(rounds)) == r).toArrow()  # about ROUND_BYTES
        found = _winners(rows, list(zip(own["id"].to_pylist(), own["v"].to_pylist())), k)
        # an id may have queries in several rounds: winners are ranked when all rounds are there
        found = materialize(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "winners")
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the 5 nearest of all vectors to every vector whose id 50 divides."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


VECTOR_SEARCH_SQL = """
WITH clean AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, len(embedding) AS dims, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding) AS x FROM clean),
whole AS (SELECT vec_id, dims, d, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM parts),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.d = c.d AND q.dims = c.dims AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
