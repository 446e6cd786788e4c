"""Connected components of a large graph: smallest reachable id, in a few shuffles a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailylake.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it can reach) for every node of ``a``-``b`` edges.

    Each round gives every node the smallest root among its neighbours' and its own, then
    the root of that root, so paths shorten to about a half in each round. Every round is
    written to the shared folder; only the number of changed rows comes to the driver.
    The groups of the first step are a node's links, those of the second a root's members,
    which partial aggregation and adaptive skew joins split.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialize(both, "links")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hop = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        jump = roots.select(F.col("node").alias("via"), F.col("root").alias("far"))
        step = materialize(hop.join(jump, "via").select("node", "old", F.least("via", "far").alias("root")), "roots")
        roots = step.select("node", "root")
        if step.where("old <> root").limit(1).count() == 0:
            return roots
