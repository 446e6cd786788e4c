"""Filters against plain sets, held-out accuracy, edge cases."""

import binascii
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailylake.llm import langid

SF = "/root/testdata/sf0.01"


def plain_trigrams(text):
    words = "".join(c if c.isalpha() else " " for c in text or "").split()
    low = [[ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in w] for w in words]
    codes = [32] + [c for w in low for c in (*w, 32)]
    return [codes[i] << 42 | codes[i + 1] << 21 | codes[i + 2] for i in range(len(codes) - 2) if codes[i + 1] != 32]


def test_trigrams():
    for t in (None, "", " ", "1 2", "a", "Ab c", "  É1x\n日本 İ.", "no 4 letters 12"):
        assert langid.trigrams(t).tolist() == plain_trigrams(t), t


def test_filter_holds_what_it_learned(spark):
    rows = [("en", "the then this that"), ("xx", "zork zork"), (None, "mmm"), ("en", None), ("yy", "zork the")]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("n", F.lit("clash"))
    known = langid.learn(df)
    assert known.languages == ["en", "xx", "yy"]
    counts = {lang: Counter(g for la, t in rows if la == lang for g in plain_trigrams(t)) for lang in known.languages}
    share = {la: {g: n / c.total() for g, n in c.items()} for la, c in counts.items()}
    for g in set().union(*counts.values()):
        at = langid.slots(np.array([g]))[:, 0]
        mask = int(np.bitwise_and.reduce(known.masks[0][at]))
        for i, la in enumerate(known.languages):
            if share[la].get(g, 0) >= langid.MIN_RATIO * max(s.get(g, 0) for s in share.values()):
                assert mask >> i & 1, (g, la)


def test_more_languages_than_a_word(spark):
    rows = [(f"l{i:02}", chr(0x4E00 + 10 * i) * 3 + " " + chr(0x4E01 + 10 * i)) for i in range(70)]
    df = spark.createDataFrame(rows, "lang string, text string")
    known = langid.learn(df)
    assert [known.decide(t)[0] for _, t in rows] == [la for la, _ in rows]


def test_too_many_languages_fail_clearly(spark):
    df = spark.createDataFrame([(f"l{i:04}", "some words") for i in range(1000)], "lang string, text string")
    with pytest.raises(ValueError, match="more than 512 values of lang"):
        langid.learn(df)


def test_very_long_text(spark):
    known = langid.learn(spark.createDataFrame([("en", "the then there"), ("fr", "des les ces")], "lang string, text string"))
    df = spark.createDataFrame([(1, "the then " * 400_000 + "des"), (2, "q" * 3_000_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(df, known).collect()}
    assert got[1].lang_pred == "en" and got[1].score > 0.99 and got[2].lang_pred in ("en", "fr")


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 +"), (4, "q"), (4, "q"), (None, "a b")], "doc_id long, text string").withColumn("lang_pred", F.lit(1))
    nothing = langid.learn(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {(r.lang_pred, r.score) for r in langid.predict(df, nothing).collect()} == {("und", 0.0)}
    known = langid.learn(spark.createDataFrame([("en", "the"), ("en", "then"), ("fr", "des")], "lang string, text string"))
    got = sorted(map(tuple, langid.predict(df, known).collect()), key=str)
    assert [g[:2] for g in got] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "en")]
    assert langid.predict(df.limit(0), known).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
