"""Held-out accuracy, shrinkage against brute force, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailylake.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    taught = big[1].where("doc_id % 2 = 0")
    held = big[1].where("doc_id % 2 = 1").withColumnRenamed("quality", "good")
    got = quality.judge(big[0], taught).join(held, "doc_id").toPandas()
    clean = got[(got.good == 1) & (got.toxic == 0)]
    assert clean.kept.mean() > 0.995
    assert 1 - got[got.good == 0].kept.mean() > 0.97
    assert 1 - got[(got.toxic == 1)].kept.mean() > 0.85  # few labels in each language here
    own = quality.judge(docs, labels)
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in own.where("kept").collect())


def test_site_rates_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(f"h{h}" if h else None, f"p{p}" if p else None, float(rng.normal(h - 2, 1)), -3.0) for h in range(5) for p in range(3) for _ in range(rng.integers(1, 40))]
    df = spark.createDataFrame(rows, "host string, path string, quality double, toxic double")
    got, rates = quality.site_rates(df)
    p = [1 / (1 + np.exp(-r[2])) for r in rows]
    rate = np.mean(p)
    assert rates["quality"] == pytest.approx(rate)

    def level(keys):
        sites = {}
        for k, x in zip(keys, p):
            n, s = sites.get(k, (0, 0.0))
            sites[k] = (n + 1, s + x)
        many = [(n, s) for n, s in sites.values() if n > 1]
        chance = rate * (1 - rate)
        spread = sum(n * (s / n - rate) ** 2 for n, s in many)
        between = max(1e-6 * chance, (spread - len(many) * chance) / sum(n for n, _ in many))
        return sites, min(1e6, max(1.0, chance / between - 1))

    hosts, kh = level([r[0] for r in rows])
    paths, kp = level([(r[0], r[1]) for r in rows])
    for r in got.collect():
        n, s = hosts[r.host]
        up = (s + rate * kh) / (n + kh)
        n, s = paths[r.host, r.path]
        assert r.host_quality == pytest.approx(up) and r.path_quality == pytest.approx((s + up * kp) / (n + kp))


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (None, 0, 1), (2, None, 0), (2, 1, None)]])
def test_few_labels_and_odd_rows(spark, labels):
    docs = spark.createDataFrame([(1, None, None, None), (2, "", "a", "x"), (2, "", "a", "x"), (None, "w " * 3000, "b", None)], "doc_id long, text string, source string, lang string").withColumn("n", F.lit(1)).withColumn("host", F.lit("clash"))
    taught = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.judge(docs, taught)
    assert got.count() == 4 and all(r.kept for r in got.collect())
    assert quality.keep(docs, taught).columns == docs.columns and quality.keep(docs, taught).count() == 4
    assert quality.judge(docs.limit(0), taught).count() == 0


def test_toxic_words_are_learned(spark):
    rows = [(i, f"plain words number{i % 7} here" + (" vile" if i % 4 == 0 else ""), "s", "l") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = docs.where("doc_id < 200").select("doc_id", F.lit(1).alias("quality"), F.expr("int(doc_id % 4 = 0)").alias("toxic"))
    assert {r.doc_id for r in quality.keep(docs, labels).collect()} == {i for i in range(400) if i % 4}


def fitted(spark, monkeypatch, docs, labels, sample):
    """How many rows the classifiers are fitted on."""
    rows = []
    whole = quality.fit_head
    monkeypatch.setattr(quality, "fit_head", lambda found, *a, **b: rows.append(len(found)) or whole(found, *a, **b))
    known = quality.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), sample)
    return known, rows


def test_labels_without_documents_take_no_place(spark, monkeypatch):
    docs = [(i, f"word{i % 5}") for i in range(30)]
    labels = [(i, 1, i % 2) for i in range(600)]
    assert fitted(spark, monkeypatch, docs, labels, 30)[1] == [30, 30]


def test_repeated_documents_count_once(spark, monkeypatch):
    docs = [(i, f"word{i % 5}") for i in range(30)] + [(7, f"other words {i % 3}") for i in range(300)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(30)]
    known, rows = fitted(spark, monkeypatch, docs, labels, 20)
    assert rows == [20, 20]
    again, _ = fitted(spark, monkeypatch, docs[::-1], labels, 20)
    assert all((known[h][0] == again[h][0]).all() and np.isclose(known[h][2], again[h][2]) for h in quality.HEADS)
