"""Fingerprints and groups against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dailylake.llm import simhash
from dailylake.llm.components import components


def plain_fingerprint(text):
    words = bytes(text or "", "utf-8").lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, bits=2):
    """Smallest reachable id of every (id, fingerprint)."""
    best = {f: f for _, f in fps}
    keys = sorted(best)
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    small = {}
    for i, f in fps:
        if i is not None:
            small[find(f)] = min(i, small.get(find(f), i))
    return {(i, f): small.get(find(f)) for i, f in fps}


def test_fingerprint():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one TWO", "a\x85b c\xa0d É", *(" ".join(rng.choice("ab cde F éß".split()) for _ in range(n)) for n in (3, 4, 50, 4000))]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("bits", [1, 2])
def test_links_of_random_fingerprints(spark, bits):
    """Dense clusters: long posting lists, chains, both ways of probing."""
    rng = random.Random(bits)
    fps = set()
    for _ in range(8):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([2, 5, 60, 250])):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.choice(range(rng.choice([8, 20, 64])))
            fps.add(x)
    rows = [(i, f) for i, f in enumerate(sorted(fps, key=str))]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r.node % (1 << 64): r.root for r in components(simhash.links(df, bits)).collect()}
    want = plain_groups(rows, bits)
    by_want, by_own = {}, {}
    for i, f in rows:
        by_want.setdefault(want[i, f], set()).add(f)
        by_own.setdefault(roots.get(f, ("alone", f)), set()).add(f)
    assert sorted(map(sorted, by_want.values())) == sorted(map(sorted, by_own.values()))
    assert max(map(len, by_want.values())) > 60


def test_query(spark):
    rng = random.Random(9)
    base = [" ".join("w%d" % rng.randrange(40) for _ in range(rng.choice([4, 30, 300]))) for _ in range(12)]
    texts = [None, "", "", *base, *(t.upper() for t in base[:5]), *(t + " tail" for t in base), *(t.replace("w1 ", "w2 ", 1) for t in base)]
    rows = [(i * 3 - 20, t) for i, t in enumerate(texts)] + [(None, base[0]), (5, None), (1, base[1]), (1, base[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("root", F.lit("x"))
    got = simhash.near_duplicates(df).collect()
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    want = plain_groups(fps)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == sorted(((i, "%016x" % f, want[i, f]) for i, f in fps), key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_bit_counts():
    h = np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    assert simhash.bit_counts(h).tolist() == [int((h >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]


def test_very_long_text(spark):
    """One text of millions of characters, its near copy, and a short one."""
    rng = random.Random(3)
    long = " ".join("w%d" % rng.randrange(500) for _ in range(400_000))
    rows = [(1, long), (2, long + " one more"), (3, "short text of few words")]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].component_id, got[2].component_id, got[3].component_id) == (1, 1, 3)
    assert got[3].fingerprint == "%016x" % plain_fingerprint(rows[2][1])
