"""The prefix trie against sets of prefixes, over many task boundaries, and edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dailylake.llm import prefixtrie as T

SCHEMA = "conv_id long, turn long, role string, text string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def plain(convs):
    members = defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        cost = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += not children[node]
    rows = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        rows.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children[node]), leaves[node], saved[node],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("x")).withColumn("prefix", F.lit(1)).withColumn("h", F.lit(2)).withColumn("turns", F.lit(3))
    got = T.trie(T.with_shared_heads(df))
    assert got.columns == OUT
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rebuilt(rows))


@pytest.mark.parametrize("seed", range(4))
def test_random_conversations_over_many_boundaries(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(T, "TASK_TURNS", [3, 10, 40, 10**6][seed])
    rows = []
    for c in range(-20, 60):
        for turn in range(rng.randint(1, 12)):
            rows.append((c, turn, rng.choice(["user", "bot"]), rng.choice(["a", "bé", "", "c"][: rng.choice([1, 1, 4])])))
    rng.shuffle(rows)
    check(spark, rows)


def test_hot_copies_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(T, "TASK_TURNS", 60)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 1500, 5) for t in range(3)]  # many copies of one sequence
    rows += [(10_000, t, "user", f"same {t}" if t < 40 else "tail") for t in range(400)]
    rows += [(10_001, t, "user", f"same {t}" if t < 40 else "tail") for t in range(300)]
    rows += [(20_000 + c, t, "u", "same 0" if not t else str(c)) for c in range(60) for t in range(2)]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, 5, "us", "era"), (2, 5, "user", "a"), (3, None, "x", "z" * 200_000)]
    rows += [(None, 0, "user", "lost"), (0, 1, "", "a"), (0, 2, None, "a"), (5, 0, "user", "only"), (6, 0, "user", "one"), (-7, 0, "user", "a"), (2**62, 0, "q", "r")]
    check(spark, rows)
    empty = spark.createDataFrame([(None, 0, "user", "lost")], SCHEMA)
    assert T.trie(T.with_shared_heads(empty)).collect() == []
    assert T.trie(T.sequences(empty.limit(0))).collect() == []


def test_sequences_as_they_are(spark):
    rows = [(7, 0, "u", "a"), (7, 1, "b", "c"), (8, 0, "u", "a")]
    got = [tuple(r)[:7] for r in T.trie(T.sequences(spark.createDataFrame(rows, SCHEMA))).orderBy("depth").collect()]
    assert got == [(7, 0, None, 2, 1, 1, 1), (7, 1, 7, 2, 1, 1, 1), (7, 2, 7, 1, 0, 1, 0)]
