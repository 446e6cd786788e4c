"""Periodic runs against the definition, planted repeats, edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dailylake.llm import runs as R


def plain(w, min_words=6, min_copies=4):
    """Every maximal stretch of each period, kept if no smaller period spans it."""
    n, out = len(w), []
    for q in range(1, n):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            a = i
            while i < n and w[i] == w[i - q]:
                i += 1
            start, length = a - q, i - a + q
            part = w[start:start + length]
            small = any(all(part[j] == part[j - r] for j in range(r, length)) for r in range(1, q))
            if length >= max(min_words, min_copies * q) and not small:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_diagonals_equal_the_definition():
    rng = random.Random(4)
    n_runs = 0
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 5)):
            w = []
            while len(w) < rng.randint(0, 70):
                block = [rng.choice("ab" if rng.random() < 0.5 else "abcde") for _ in range(rng.randint(1, 9))]
                w += block * rng.randint(1, 6) + block[:rng.randint(0, len(block))]
            texts.append(w)
        offsets = np.cumsum([0] + [len(w) for w in texts])
        numbers = np.array([ord(c) for w in texts for c in w], np.int64)
        got = [tuple(map(int, r)) for r in R.diagonals(numbers, offsets)]
        want = [(int(o) + s, length, q) for o, w in zip(offsets, texts) for s, length, q in plain(w)]
        assert got == want
        n_runs += len(want)
    assert n_runs > 500


def test_split_words_equals_the_pattern():
    texts = ["", " ", "a", " a\tb\n\x0bc\x0c\rd ", "x\x1cy\x85z\xa0w v  u", None, "é ü\n\n"]
    words, offsets = R.split_words(pa.array(texts))
    got = [words.slice(a, b - a).to_pylist() for a, b in zip(offsets, offsets[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_query_on_odd_rows(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(None, "x " * 9), (None, None), (7, None), (8, ""), (9, " \n "), (9, " \n "), (-3, "p q p q\tp q\np q r r r r r r r"), (10**15, "a b " * 30)]
    rows += [(11, "one two three " * 4), (12, "one two three " * 3), (13, "same " * 5), (13, "same " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("words", F.lit("w")).withColumn("n", F.lit(0)).withColumn("h", F.lit(10))
    got = [tuple(r) for r in R.digests(R.find(R.planted(df))).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted((expected(*r) for r in rows), key=key)
    assert R.find(df.limit(0)).count() == 0


def test_very_long_text(spark):
    half = " ".join(f"w{i}" for i in range(150_000))
    df = spark.createDataFrame([(1, half + " " + "tick tock " * 200_000 + half), (2, "only " * 300_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in R.find(df).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(150_000, 400_000, 2)]
    assert got[1]["collapsed"] == half + " tick tock " + half and got[2]["collapsed"] == "only"
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 300_000, 1)]


def test_registered_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"] for r in docs if len((r["text"] or "").split()) < 400}
    got = {r["doc_id"]: tuple(r) for r in R.periodic_runs(spark, sf).collect()}
    assert len(got) == len(docs) and len(short) > 100
    assert {i: got[i] for i in short} == {r["doc_id"]: expected(r["doc_id"], r["text"]) for r in docs if r["doc_id"] in short}
    assert sum(got[i][1] for i in short) > 3
