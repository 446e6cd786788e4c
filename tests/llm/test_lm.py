"""The lattice against all segmentations, counts and base score against brute force."""

import binascii
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from dailylake.llm import lm

PATH = P.path("piece_bpe_32k.model")


def segmentations(text):
    if not text:
        yield ()
    for k in range(1, len(text) + 1):
        for rest in segmentations(text[k:]):
            yield (text[:k], *rest)


def test_lattice_sums_all_segmentations():
    weights = {lm.START: 1.0, lm.START + b"a": 2.0, b"a": 3.0, b"ab": 4.0, b"b": 1.0, b"aba": 0.5, **{bytes([i]): 0.01 for i in range(256) if i not in b"ab"}}
    lattice = lm.Lattice(weights, 0.25)
    first = sum(w for p, w in weights.items() if p.startswith(lm.START))
    inner = sum(w for p, w in weights.items()) - first
    for word in (b"abab", b"b", b"aabba", b"zab"):
        total, expected = 0.0, Counter()
        for seg in segmentations(lm.START + word):
            if seg[0].startswith(lm.START) and all(p in weights for p in seg) and not any(p.startswith(lm.START) for p in seg[1:]):
                p = weights[seg[0]] / first * math.prod(weights[x] / inner for x in seg[1:]) * 0.75 ** (len(seg) - 1) * 0.25
                total += p
                for x in seg:
                    expected[x] += p
        assert lattice.log_probability(word) == pytest.approx(math.log(total))
        found = {}
        lattice.expect(word, found)
        assert found == pytest.approx({p: n / total for p, n in expected.items()}, abs=1e-9)


def test_expected_counts_of_short_and_long_words_agree(monkeypatch):
    """With and without logs, and where the numbers get too small."""
    lattice = lm.Lattice(lm.first_weights(lm.read_pieces(PATH)), 0.3)
    for word in (b"a", b"thereunto", b"\x00\x01\x02" * 12, "日本".encode(), b"zqxj" * 9):
        plain, logs = {}, {}
        lattice.expect(word, plain, 3)
        with monkeypatch.context() as m:
            m.setattr(lm, "SHORT", 0)
            lattice.expect(word, logs, 3)
        assert all(plain[p] == pytest.approx(logs.get(p, 0.0), rel=1e-6, abs=1e-9) for p in plain) and logs.keys() <= plain.keys()


def test_long_and_foreign_words():
    lattice = lm.Lattice(lm.first_weights(lm.read_pieces(PATH)), 0.3)
    for word in ("x" * 20_000, "日本́", "▁▁a", "\x00\U0001F600"):
        assert -1e6 < lattice.log_probability(word.encode()) < 0


def plain(rows):
    held = lambda i: binascii.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    toks = [[*(t or "").encode().lower().split(), b""] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, toks) if not held(i) for w in ws)
    n, v = c.total(), len(c)
    return [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in ws)) for (i, _), ws in zip(rows, toks)]


@pytest.mark.parametrize("bundle", [40, 1 << 24])
def test_query(spark, monkeypatch, bundle):
    monkeypatch.setattr(lm, "BUNDLE_BYTES", bundle)
    rows = [(i, f"The cat{i % 3} sat\x0bÉté on w{i} " + "the " * (i % 4)) for i in range(40)] + [(100, None), (101, ""), (101, ""), (None, "the the"), (7, "x " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("c", F.lit(2))
    got = lm.score(df, PATH).collect()
    key = lambda r: (str(r[0]), *r[1:5], round(r[5], 4))
    for g, w in zip(sorted((tuple(r) for r in got), key=key), sorted(plain(rows), key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5]) and g[6] < 0


def test_nothing_to_learn_from(spark):
    held = [i for i in range(40) if binascii.crc32(str(i).encode()) % 7 == 2]
    df = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    assert {(r.n_known, r.train_tokens, round(r.base_score, 9)) for r in lm.score(df, PATH).collect()} == {(0, 0, 0.0)}
    assert lm.score(df.limit(0), PATH).count() == 0


def test_more_probable_in_its_own_corpus(spark):
    """Held-out texts of the corpus beat the same texts with the letters of each word reversed."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = docs.where("crc32(cast(doc_id as string)) % 7 = 2")
    turned = held.selectExpr("doc_id", "array_join(transform(split(text, ' '), w -> reverse(w)), ' ') as text")
    rows = docs.where("crc32(cast(doc_id as string)) % 7 <> 2").unionByName(held).unionByName(turned)
    got = lm.score(rows, PATH).where("held_out").groupBy("doc_id").agg(F.max("score").alias("best"), F.min("score").alias("worst"), F.max_by("n_known", "score").alias("known"), F.max("n_known").alias("most")).collect()
    assert sum(r.known == r.most for r in got) / len(got) > 0.95


def _every_way(weights, text):
    """Sum over all segmentations by plain recursion, for one word with its start mark."""
    first = sum(w for p, w in weights.items() if p.startswith(lm.START))
    inner = sum(weights.values()) - first
    size = max(len(p) for p in weights)

    def below(at):
        if at == len(text):
            return 0.3
        total = 0.0
        for k in range(1, min(size, len(text) - at) + 1):
            w = weights.get(text[at:at + k], 0.0)
            if at and w and not text[at:at + k].startswith(lm.START):
                total += w / inner * 0.7 * below(at + k)
            elif not at and w and text[:k].startswith(lm.START):
                total += w / first * below(k)
        return total

    return below(0)


def test_score_is_the_sum_over_all_segmentations(spark, monkeypatch):
    """Whole documents, with the vocabulary's own weights: every segmentation, one by one."""
    monkeypatch.setattr(lm, "ROUNDS", 0)
    rows = [(i, f"The cat{i % 3} w{i % 11} " + "new " * (i % 4)) for i in range(60)] + [(101, None), (None, "the le")]
    held = lambda i: binascii.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    weights = lm.first_weights(lm.read_pieces(PATH))
    taught = [(t or "").encode().lower().split() for i, t in rows if not held(i)]
    end = (len(taught) + 1) / (sum(map(len, taught)) + len(taught) + 2)
    known = {}
    want = []
    for i, t in rows:
        p = math.log10(end)
        for w in (t or "").encode().lower().split():
            known[w] = known.get(w) or _every_way(weights, lm.START + w)
            p += math.log10((1 - end) * known[w])
        want.append((str(i), p))
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    for (i, x), (j, y) in zip(sorted((str(r.doc_id), r.score) for r in got), sorted(want), strict=True):
        assert i == j and x == pytest.approx(y, rel=1e-9)


def test_reweighting_counts_words_as_often_as_they_occur(spark):
    """One pass of expected counts raises the training words' probability, most that of frequent ones."""
    words = spark.createDataFrame([("the", 500), ("thble", 20), ("qxz", 1)], "word string, n long")
    prior = lm.first_weights(lm.read_pieces(PATH))
    weights, stop = lm.reweigh(words, prior, 0.3, prior)
    before, after = lm.Lattice(prior, 0.3), lm.Lattice(weights, stop)
    total = lambda lat: sum(n * lat.log_probability(w) for w, n in ((b"the", 500), (b"thble", 20), (b"qxz", 1)))
    assert total(after) > total(before) + 500 and 0 < stop <= 1
    assert lm.reweigh(words.limit(0), prior, 0.3, prior) == (prior, 0.3)


def test_held_out_texts_gain_from_the_corpus(spark, monkeypatch):
    """Re-weighted pieces say more about unseen texts than the vocabulary's ranks alone."""
    mean = lambda: spark_mean(lm.lm_score(spark, "/root/testdata/sf0.01"))
    spark_mean = lambda df: df.where("held_out").agg(F.sum("score") / F.sum("n_tokens")).first()[0]
    taught = mean()
    monkeypatch.setattr(lm, "ROUNDS", 0)
    assert taught > mean() + 1
