"""Containment pairs against brute force; sketches lose no contained item."""

import random
import re

import pytest
from pyspark.sql import functions as F

from dailylake.llm import decontaminate as D


def words(text):
    return [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]


def plain_shingles(text, k):
    w = words(text)
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}


def plain(docs, items, t=0.8):
    out = set()
    for i, x in set(items):
        k = min(5, len(words(x)))
        s = plain_shingles(x, k) if k else set()
        out |= {(d, i, len(s)) for d, text in docs if s and len(s & plain_shingles(text, k)) >= t * len(s) - 1e-9}
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(30))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 9, 20, 40, 130])))) for i in range(25)]
    docs = []
    for d in range(80):
        parts = [word() for _ in range(rng.choice([0, 4, 200, 2000]))]
        for _ in range(rng.randrange(3)):
            own = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = "changed"
            at = rng.randint(0, len(parts))
            parts[at:at] = own
        docs.append((d, rng.choice([" ", ", "]).join(parts).upper() if d % 3 else " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_pairs(spark, monkeypatch, broadcast):
    monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast)
    docs, items = corpus(broadcast)
    docs += [(500, None), (501, ""), (None, items[4][1]), (None, "clean"), (7, items[5][1]), (7, items[5][1]), (502, "w " * 20_000)]
    items += [(90, None), (91, "..."), (None, "one two three four five six"), items[0]]
    docs.append((503, "x one two three four five six y"))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("hash", F.lit(1))
    it = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    want = plain(docs, items)
    assert len(want) > 30
    assert {(r.doc_id, r.item_id, r.n_shingles) for r in D.contained(df, it).collect()} == want
    bad = {d for d, _, _ in want}
    kept = D.keep_clean(df, it)
    assert kept.columns == df.columns
    clean = [(d, x) for d, x in docs if not plain([(d, x)], items)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)
    assert None in bad and any(d is None for d, _ in clean)


def test_short_items_inside_long_documents(spark):
    items = [(1, "what is two plus"), (2, "Paris"), (3, "blue whale"), (4, "one two three"), (5, "two, three"), (6, "")]
    docs = [(1, "tell me: what is two plus two? " + "filler " * 3000), (2, "a paris of the north"), (3, "whale blue"), (4, "zero one two three four"), (5, "blue whale"), (6, "parisian"), (7, None)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shingles) for r in D.contained(df, it).collect()}
    assert got == plain(docs, items) == {(1, 1, 1), (2, 2, 1), (4, 4, 1), (4, 5, 1), (5, 3, 1)}
    assert sorted(r.doc_id for r in D.keep_clean(df, it).collect()) == [3, 6, 7]


def test_sql_states_the_operator(spark):
    """Short items, several texts of an id, null ids and repeated rows, in DuckDB too."""
    duckdb = pytest.importorskip("duckdb")
    docs, items = corpus(3)
    docs += [(None, "the red fox runs home"), (900, "red fox"), (900, "no fox"), (900, "red fox")]
    items += [(None, "red fox"), (70, "red fox"), (70, "the red fox runs home"), (71, None), items[0]]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", it.toPandas().astype({"item_id": "Int64"}))
    want = con.sql(D.CONTAMINATION_SQL).fetchall()
    got = [tuple(r) for r in D.best_pairs(D.contained(df, it)).collect()]
    assert len(want) > 30 and sorted(got, key=str) == sorted(want, key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    it = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contained(df, it).count() == 0
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert D.contained(docs, it.limit(0)).count() == 0 and D.keep_clean(docs, it.limit(0)).count() == 1


def test_native(spark):
    docs, items = corpus(1)
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plan = D.contained(df, it)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def plain_texts(docs, items, t=0.8):
    """Like ``plain``, every text of an id being an item by itself."""
    return set().union(*(plain(docs, [item], t) for item in items))


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_texts_of_one_id_are_items_by_themselves(spark, monkeypatch, broadcast):
    monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast)
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    items = [(None, text("a", 20)), (None, text("b", 30)), (None, text("b", 30)), (7, text("c", 12)), (7, text("d", 40)), (7, None), (8, text("c", 12))]
    docs = [(1, "x " + text("a", 20) + " y"), (2, text("b", 30)), (3, text("c", 12) + " z"), (4, "z " + text("d", 40)), (None, text("c", 12) + " " + text("d", 40)), (6, text("e", 50))]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain_texts(docs, items)
    assert len(want) == 8
    assert {(r.doc_id, r.item_id, r.n_shingles) for r in D.contained(df, it).collect()} == want
    assert [r.doc_id for r in D.keep_clean(df, it).collect()] == [6]


def test_best_text_of_an_id_counts(spark, tmp_path):
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    spark.createDataFrame([(1, text("a", 24) + " x " + text("b", 12))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, text("a", 26)), (7, text("b", 12))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [tuple(r) for r in D.contamination(spark, str(tmp_path)).collect()] == [(1, 7, 8, 8, 1.0)]
