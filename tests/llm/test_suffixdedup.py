"""Removed passages against brute force over all windows; the factor arrays themselves."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dailylake.llm import suffixdedup as S


def plain(rows, length, keep="none"):
    """Remaining bytes, and removed bytes and spans, of every row."""
    data = [((i, t), (t or "").encode()) for i, t in rows]
    starts = Counter(d[k:k + length] for _, d in data for k in range(len(d) - length + 1))
    firsts = {}
    for (i, t), d in data:
        for k in range(len(d) - length + 1):
            place = (i is not None, i or 0, k)
            firsts[d[k:k + length]] = min(place, firsts.get(d[k:k + length], place))
    out = []
    for (i, t), d in data:
        gone = [False] * (len(d) + 1)
        for k in range(len(d) - length + 1):
            w = d[k:k + length]
            if starts[w] > 1 and (keep == "none" or firsts[w] != (i is not None, i or 0, k)):
                gone[k:k + length] = [True] * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(d)))
        out.append((i, bytes(b for b, g in zip(d, gone) if not g), len(d), sum(gone[:-1]), spans))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(rng.choice([length // 2, length, length + 1, 2 * length, 5 * length])) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [text(rng.choice([0, 3, length, 4 * length])) for _ in range(3)]
        parts[1:1] = [rng.choice(shared)] * (rng.random() < 0.7)
        rows.append((i, "".join(parts)))
    rows += [(100 + i, text(10) + shared[3][5:] + text(9)) for i in range(30)]
    rows += [(200, "z" * (5 * length)), (201, "z" * (length + 3) + "q"), (202, "ab" * length), (203, None), (204, ""), (205, None)]
    return rows


@pytest.mark.parametrize("seed,bucket,keep", [(1, 512, "none"), (2, 3, "none"), (3, 512, "first"), (4, 3, "first")])
def test_remove(spark, monkeypatch, seed, bucket, keep):
    monkeypatch.setattr(S, "BUCKET", bucket)
    monkeypatch.setattr(S, "SORTED", 50)
    monkeypatch.setattr(S, "BLOCK", 5)
    length = 40
    rows = corpus(seed, length)
    if keep == "none":
        rows += [rows[3], rows[3], (None, rows[5][1]), (7, rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("data", F.lit(1)).withColumn("th", F.lit("x"))
    got = S.remove(df, length, 12, keep)
    own = sorted(((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got.collect()), key=str)
    assert own == sorted(plain(rows, length, keep), key=str)
    assert sum(r[3] for r in own) > 1000


def test_previous_factors():
    rng = random.Random(0)
    for _ in range(50):
        spans = [bytes(rng.choice(b"ab") for _ in range(rng.randint(8, 30))) for _ in range(3)]
        spans.append(spans[0][2:])
        previous, following = S.factors(spans, 8)
        windows = [s[i:i + 8] for s in spans for i in range(len(s) - 7)]
        shared = lambda a, b: next((k for k in range(8) if a[k] != b[k]), 8)
        for k, w in enumerate(windows):
            assert previous[k] == max((shared(w, x) for x in windows[:k]), default=0)
            assert following[k] == max((shared(w, x) for x in windows[k + 1:]), default=0)


def test_empty(spark):
    assert S.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = random.Random(5)
    core = bytes(rng.choice(b"abc") for _ in range(900))
    found = []
    for _ in range(2):
        lead = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 500)))
        first, last, anchor, gram = S.runs(lead + core + lead)
        found.append({p - len(lead): (a - p, g) for f, e, a, g in zip(first, last, anchor, gram) for p in range(f, e + 1) if 0 <= p - len(lead) <= 500})
    assert found[0] == found[1] and len(found[0]) == 501


def test_very_long_text(spark):
    """A passage at both ends of a text of millions of bytes, and in another one."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = text(700)
    rows = [(1, passage + text(2_500_000) + passage), (2, text(900) + passage), (3, text(2_000))]
    got = {r.doc_id: r for r in S.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_spans == 2 and 1400 <= got[1].n_removed < 1420 and got[2].n_spans == 1 and 700 <= got[2].n_removed < 720
    assert got[3].n_removed == 0 and bytes(got[3].kept).decode() == rows[2][1]


def test_query_returns_the_rest_to_be_read(spark, tmp_path):
    """Passages of 60 long words go from both texts, one of 55 short words (below 400 bytes) stays; cut characters are marked."""
    rng = random.Random(11)
    words = lambda n, k: " ".join("".join(rng.choices("abcdefgh", k=k)) for _ in range(n))
    long, short, cut = words(60, 8), words(55, 5), words(50, 9)
    rows = [(1, f"{words(70, 6)}\n{long}\n{words(9, 6)}"), (2, f"{long}\n{words(80, 6)}"), (3, f"{words(5, 6)} {short}"), (4, f"{short} {words(5, 7)}"),
            (5, "Aé" + cut), (6, "B©" + cut + "é"), (7, words(300, 6)), (8, None), (9, ""), (None, "漢字")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in S.suffix_dedup(spark, str(tmp_path)).collect()}
    for i, kept, size, removed, spans in plain(rows, 400):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (size, removed, spans, hashlib.sha256(kept).hexdigest())
        assert r.text == kept.decode(errors="replace")
    assert long not in got[1].text and long not in got[2].text and min(got[1].n_removed, got[2].n_removed) >= 400
    assert [got[i].text for i in (3, 4, 7, 9, None)] == [rows[k][1] for k in (2, 3, 6, 8, 9)] and got[8].text == ""
    assert got[5].text == "A\ufffd" and got[6].text == "B\ufffdé"


def test_candidates():
    """Every window that another run has too is a candidate, and few others are."""
    rng = random.Random(3)
    for _ in range(60):
        gram = bytes(rng.choice(b"ab") for _ in range(6))
        spans = []
        for _ in range(5):
            before = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14)))
            spans.append((len(before), before + gram + bytes(rng.choice(b"ab") for _ in range(20 - 6 - rng.randint(0, len(before)) + 2))))
        spans = [(lead, data) for lead, data in spans if len(data) >= 20]
        for k, ((lead, data), (a, b)) in enumerate(zip(spans, S.candidates(spans, 20))):
            others = {(o - i, d[i:i + 20]) for j, (o, d) in enumerate(spans) if j != k for i in range(min(o, len(d) - 20) + 1)}
            equal = [i for i in range(min(lead, len(data) - 20) + 1) if (lead - i, data[i:i + 20]) in others]
            assert all(a <= i <= b for i in equal)
            assert a >= 0 and b <= len(data) - 20


def in_two(rows, words):
    """Positions of the rows with ``words`` words on end that another row has too."""
    own = [(t or "").encode().split() for _, t in rows]
    found = [{tuple(w[k:k + words]) for k in range(len(w) - words + 1)} for w in own]
    rows_of = Counter(x for f in found for x in f)
    return [any(rows_of[x] > 1 for x in f) for f in found]


@pytest.mark.parametrize("seed,gram,held", [(1, 4, 3 << 20), (2, 3, 300), (3, 12, 3 << 20)])
def test_repeated(spark, monkeypatch, seed, gram, held):
    monkeypatch.setattr(S, "WORD_BYTES", held)
    rng = random.Random(seed)
    words = lambda n: [rng.choice(["a", "b", "é", "dd"]) for _ in range(n)]
    shared = [words(n) for n in (11, 12, 12, 13, 20, 40)]
    rows = []
    for i in range(120):
        parts = [words(rng.choice([0, 5, 12, 60])) for _ in range(2)]
        parts[1:1] = [rng.choice(shared)] * (rng.random() < 0.4)
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w for p in parts for w in p)))
    once = " ".join(words(30))
    rows += [(200, f"{once} x {once}"), (201, " ".join(["z"] * 90)), (202, "q " * 12), (202, "q " * 12), (None, "w " * 14), (None, "w " * 14),
             (203, "k " * 11), (203, "k " * 11), (204, None), (205, ""), (204, None), (206, " ".join(shared[5])), (None, "v " + " ".join(shared[5]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("data", F.coalesce("text", F.lit("")).cast("binary"))
    docs = docs.withColumn("th", F.xxhash64("data")).select("doc_id", "data", "th")
    got = {(r.of, r.of_th) for r in S.repeated(docs, 12, gram).collect()}
    at = {(r.doc_id, bytes(r.data)): r.th for r in docs.collect()}
    want = in_two(rows, 12)
    assert {(i, at[i, (t or "").encode()]) for (i, t), w in zip(rows, want) if w} == got
    assert 20 < sum(want) < len(rows) - 20


def test_query_names_passages_of_over_50_words(spark, tmp_path):
    """A passage of 51 short words stays in both texts, which are named; one of 50 words names none."""
    rng = random.Random(12)
    words = lambda n, k: " ".join("".join(rng.choices("abcdefgh", k=k)) for _ in range(n))
    over, under = words(51, 4), words(50, 4)
    rows = [(1, f"{words(70, 6)} {over} {words(9, 6)}"), (2, f"{words(3, 6)}\n{over}"), (3, f"{words(9, 6)} {under} {words(40, 5)}"), (4, f"{under} {words(40, 5)}"), (5, words(300, 6)), (6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in S.suffix_dedup(spark, str(tmp_path)).collect()}
    assert [got[i].repeated for i in range(1, 7)] == [True, True, False, False, False, False]
    assert all(got[i].n_removed == 0 and got[i].text == (t or "") for i, t in rows)
