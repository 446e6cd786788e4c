"""Prefix trie of conversations, from the common prefixes of sorted neighbours.

A conversation is its sequence of turns (role, text); every distinct prefix is a node. Turns
are replaced by 128-bit hashes and the sequences range-partitioned and sorted by their hashes,
then by id, so copies of one sequence, however many, spread over tasks. Sorted neighbours share
their longest common prefix (LCP), which is an edge between them. A task takes its edges in
descending depth and joins the two sides with union-find: a merge makes the branching node at
that depth, with both sides' top nodes as its children, or joins a top node that is there
already. Between two branching nodes lies a chain of nodes with the same members, which are
written out at the end.

Only nodes on the path of a task's first or last sequence can have members in another task. All
others are final. The forest is contracted to these open nodes, keyed by a hash of their prefix,
and forests are merged by summing the open nodes' figures. At the boundary of two tasks the
figures that both counted are taken off: with L the LCP of the last sequence before and the
first one after it (the number of open prefixes that both have), each shared node counted the
bytes down to depth L twice, one child twice above depth L, and a leaf that isn't one if the
sequence before ends at depth L.

Edge cases: rows without a conversation id take no part; null turns come first, null roles and
texts are empty; turns of one number go by a hash of (role, text); repeated rows are turns of
their own; texts of any length go in as hashes; a conversation's hashes (some 24 bytes a turn) are
held by one task; no conversations, no nodes, not even a root; other columns pass unused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dailylake.llm.common import materialize, table

#: Turns in a task's part of the sorted sequences, on average.
TASK_TURNS = 250_000
#: Ids in one piece of a node's list of ends.
PIECE_IDS = 50_000
HEAD_TURNS = 8
NODE = (
    "pid int, open boolean, first boolean, last boolean, prefix binary, parent binary, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, before long, upto long, ends_sha256 string, piece long, ids string")


def sequences(conversations: DataFrame, keep_together: str = "conv_id") -> DataFrame:
    """``conv_id`` and ``turns`` (hash and text bytes of each turn, in order), dealt by ``keep_together``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", F.unhex(F.substring(F.sha2(said, 256), 1, 32)).alias("key"), F.octet_length(text).cast("long").alias("size")).alias("turn"))
    rows = rows.withColumn("together", F.expr(keep_together)).repartition("together")
    turns = rows.groupBy("together", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return turns.withColumn("turns", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))))


def with_shared_heads(conversations: DataFrame) -> DataFrame:
    """Sequences whose first crc32(id) % 9 turns are those of the conversation whose id is the next lower multiple of five."""
    own = sequences(conversations, "conv_id - conv_id % 5")
    head = F.max(F.when(F.col("conv_id") == F.col("together"), F.slice("turns", 1, HEAD_TURNS))).over(Window.partitionBy("together"))
    own = own.withColumn("head", F.coalesce(head, F.array().cast(own.schema["turns"].dataType)))
    own = own.withColumn("h", F.expr("cast(crc32(cast(cast(conv_id as string) as binary)) % 9 as int)"))
    return own.select("conv_id", F.expr("concat(slice(head, 1, h), slice(turns, h + 1, size(turns)))").alias("turns"))


class Forest:
    """Compact trie of sorted sequences: ``depth``, ``up`` and the figures of its branching and end nodes."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, keys: np.ndarray, sizes: np.ndarray):
        self.ids, self.offsets, self.keys = ids, offsets, keys
        self.bytes = np.concatenate([[0], np.cumsum(sizes)])
        m = len(ids)
        lens = np.diff(offsets).tolist()
        starts = offsets.tolist()
        lcp = np.zeros(max(m - 1, 0), np.int64)
        for i in range(m - 1):
            k = min(lens[i], lens[i + 1])
            differ = np.flatnonzero((keys[starts[i]:starts[i] + k] != keys[starts[i + 1]:starts[i + 1] + k]).any(axis=1)) if k else ()
            lcp[i] = differ[0] if len(differ) else k
        self.lcp = lcp
        self._merge(m, lens)
        self._sum(m)

    def _merge(self, m: int, lens: list[int]) -> None:
        """One union for each LCP edge, deepest first; a union makes, or extends, the node at its depth."""
        root, top = list(range(m)), list(range(m))
        depth, up, row, same = list(lens), [-1] * m, list(range(m)), list(range(m))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for e in np.argsort(-self.lcp, kind="stable").tolist():
            a, b, w = find(e), find(e + 1), int(self.lcp[e])
            s, t = top[a], top[b]
            if depth[s] == w and depth[t] == w:
                same[t] = s
            elif depth[s] == w:
                up[t] = s
            elif depth[t] == w:
                up[s], s = t, t
            else:
                up[s] = up[t] = len(depth)
                s = len(depth)
                depth.append(w)
                up.append(-1)
                row.append(row[top[a]])
                same.append(s)
            root[b], top[a] = a, s
        for t in range(len(same)):
            s = t
            while same[s] != s:
                s = same[s]
            while same[t] != s:
                same[t], t = s, same[t]
        self.depth, self.row, self.same = depth, row, same
        self.up = [same[p] if p >= 0 else -1 for p in up]

    def spent(self, row: int, depth: int) -> int:
        """Text bytes of the first ``depth`` turns of a sequence."""
        at = self.offsets[row]
        return int(self.bytes[at + depth] - self.bytes[at])

    def _sum(self, m: int) -> None:
        size = len(self.depth)
        self.n, self.least, self.children, self.leaves, self.saved = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size
        self.ends: dict[int, list[int]] = {}
        for r, c in enumerate(self.ids.tolist()):
            t = self.same[r]
            self.n[t] += 1
            self.least[t] = c if self.least[t] is None else min(self.least[t], c)
            self.ends.setdefault(t, []).append(c)
        self.nodes = sorted((t for t in range(size) if self.same[t] == t), key=lambda t: -self.depth[t])
        for t in self.nodes:
            if not self.children[t]:
                self.leaves[t] = 1
            p = self.up[t]
            if p >= 0:
                self.n[p] += self.n[t]
                self.least[p] = self.least[t] if self.least[p] is None else min(self.least[p], self.least[t])
                self.children[p] += 1
                self.leaves[p] += self.leaves[t]
                r = self.row[t]
                self.saved[p] += self.saved[t] + (self.n[t] - 1) * (self.spent(r, self.depth[t]) - self.spent(r, self.depth[p]))

    def path(self, row: int) -> list[int]:
        """The node of a sequence and all nodes above it."""
        t, out = self.same[row], []
        while t >= 0:
            out.append(t)
            t = self.up[t]
        return out

    def prefixes(self, row: int) -> list[bytes]:
        """A hash of every prefix of a sequence, the empty one first."""
        out = [hashlib.sha256(b"").digest()[:16]]
        for key in self.keys[self.offsets[row]:self.offsets[row + 1]]:
            out.append(hashlib.sha256(out[-1] + key.tobytes()).digest()[:16])
        return out

    def rows(self, pid: int) -> Iterator[dict]:
        last_row = len(self.ids) - 1
        on_first, on_last = set(self.path(0)), set(self.path(last_row))
        first_names, last_names = self.prefixes(0), self.prefixes(last_row)
        none = hashlib.sha256(b"").hexdigest()
        for t in self.nodes:
            a, p, r, n = self.depth[t], self.up[t], self.row[t], self.n[t]
            w = self.depth[p] if p >= 0 else -1
            first, last = t in on_first, t in on_last
            names = first_names if first else last_names if last else None
            above = first_names if p in on_first else last_names if p in on_last else None
            ends = self.ends.get(t)
            for d in range(w + 1, a + 1):
                before = self.spent(r, max(d - 1, 0))
                at_end = ends if d == a else None
                parent = names[d - 1] if names and d else above[w] if above and d == w + 1 else None
                yield {
                    "pid": pid, "open": names is not None, "first": first, "last": last, "prefix": names[d] if names else None,
                    "parent": parent, "depth": d, "conv_id": self.least[t],
                    "parent_conv_id": None if parent or not d else self.least[p] if d == w + 1 else self.least[t],
                    "n_convs": n, "n_children": self.children[t] if d == a else 1, "n_leaves": self.leaves[t],
                    "saved_tokens": self.saved[t] + (n - 1) * (self.spent(r, a) - before), "before": before, "upto": self.spent(r, d),
                    "ends_sha256": hashlib.sha256(",".join(map(str, at_end)).encode()).hexdigest() if at_end and not names else none}
                if at_end and names:
                    for k in range(0, len(at_end), PIECE_IDS):
                        yield {"pid": pid, "prefix": names[d], "piece": k, "ids": ",".join(map(str, at_end[k:k + PIECE_IDS]))}


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one task's sorted sequences: final nodes, open nodes, and the ids that end at open nodes."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    part = pa.Table.from_batches(held).combine_chunks()
    turns = part.column("turns").chunk(0)
    offsets = turns.offsets.to_numpy().astype(np.int64)
    flat = turns.values.slice(offsets[0], offsets[-1] - offsets[0])
    keys, sizes = flat.field("key"), flat.field("size")
    at = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset] if len(keys) else 0
    names = np.frombuffer(keys.buffers()[2], np.uint64, 2 * len(keys), int(at)).reshape(-1, 2) if len(keys) else np.zeros((0, 2), np.uint64)
    trie = Forest(part.column("conv_id").to_numpy(), offsets - offsets[0], names, sizes.to_numpy())
    schema = pa.schema([(f, _KINDS[k]) for f, k in (c.split() for c in NODE.split(", "))])
    rows: list[dict] = []
    for row in trie.rows(TaskContext.get().partitionId()):
        rows.append(row)
        if len(rows) == 10_000:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each prefix's ids, whose pieces come in order."""
    now, state = None, None
    done = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["prefix", "ends"])
    for batch in batches:
        for prefix, ids in zip(batch.column("prefix").to_pylist(), batch.column("ids").to_pylist()):
            if prefix == now:
                state.update(b",")
            else:
                if state:
                    yield done()
                now, state = prefix, hashlib.sha256()
            state.update(ids.encode())
    if state:
        yield done()


def trie(seqs: DataFrame) -> DataFrame:
    """All nodes of the trie of ``conv_id``, ``turns`` (array of key, 16 bytes, and size)."""
    spark = seqs.sparkSession
    seqs = materialize(seqs, "sequences")
    total = seqs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    tasks = max(1, -(-total // TASK_TURNS))
    dealt = seqs.select("conv_id", "turns", F.transform("turns", lambda t: t["key"]).alias("keys"))
    dealt = dealt.repartitionByRange(tasks, "keys", "conv_id").sortWithinPartitions("keys", "conv_id").select("conv_id", "turns")
    forest = materialize(dealt.mapInArrow(_forests, NODE), "forests")

    opened = forest.where("open")
    pids = sorted(r["pid"] for r in opened.select("pid").distinct().collect())  # one int for each task
    follows = spark.createDataFrame(list(zip(pids, pids[1:])), "pid int, next int")
    before = opened.where("last").select("pid", "depth", "prefix").join(F.broadcast(follows), "pid")
    after = opened.where("first").select(F.col("pid").alias("next"), "depth", "prefix", "before", "upto")
    shared = before.join(after, ["next", "depth", "prefix"])
    lengths = before.groupBy("next").agg(F.max("depth").alias("length"))
    boundary = shared.groupBy("next").agg(F.max("depth").alias("deep"), F.max("upto").alias("bytes")).join(lengths, "next")
    twice = shared.join(boundary, "next").select(
        "prefix", "depth", F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("n_convs"),
        F.when(F.col("depth") < F.col("deep"), -1).otherwise(0).cast("long").alias("n_children"),
        F.when(F.col("length") == F.col("deep"), -1).otherwise(0).cast("long").alias("n_leaves"),
        (F.col("bytes") - F.col("before")).alias("saved_tokens"))
    parts = opened.select(twice.columns).unionByName(twice)
    add = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    joint = parts.groupBy("prefix", "depth").agg(F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), *add)

    pieces = forest.where("ids is not null").select("prefix", "pid", "piece", "ids")
    ends = pieces.repartition("prefix").sortWithinPartitions("prefix", "pid", "piece").select("prefix", "ids").mapInArrow(_hash_pieces, "prefix binary, ends string")
    joint = materialize(joint.join(ends, "prefix", "left").withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit(""), 256))), "open-nodes")

    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = joint.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("above"))
    closed = forest.where("not open").select(*out, "parent")
    every = closed.unionByName(joint.withColumn("parent_conv_id", F.lit(None).cast("long")).select(closed.columns))
    return every.join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(out)


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the trie of all conversations, rebuilt on shared heads."""
    return trie(with_shared_heads(table(spark, sf_dir, "conversations")))


PREFIX_TRIE_SQL = """
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
    SELECT conv_id, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda r, c: list_reduce([xor(r, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, u: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
    FROM own),
convs AS (
    SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) AS turns
    FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
members AS (
    SELECT conv_id, len(turns) AS n, d, turns[1:d] AS node FROM convs, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS d)),
nodes AS (
    SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends,
        CASE WHEN any_value(d) = 0 THEN 0 ELSE strlen(any_value(node)[-1].text) END AS size
    FROM members GROUP BY node),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
shown AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
below AS (
    SELECT node[1:d] AS node, sum((n_convs - 1) * size) AS saved, count(*) FILTER (n_children = 0) AS leaves
    FROM shown, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) GROUP BY 1)
SELECT s.conv_id, CAST(s.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(s.n_convs AS BIGINT) AS n_convs,
    CAST(s.n_children AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(s.ends) AS ends_sha256
FROM shown s JOIN below b USING (node) LEFT JOIN nodes p ON s.depth > 0 AND p.node = s.node[1:s.depth - 1]
"""
