"""Merge replay against the tiktoken library."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from dailylake.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(bpe.read_ranks(PATH), P.PATTERN)


def ids(vocab, texts):
    rows, pieces = bpe.encode_texts(vocab, texts)
    return [[t for i in r.tolist() for t in pieces[i]] for r in rows]


def test_random_texts(known, vocab):
    rng = random.Random(3)
    letters = "ab 1\t\n\r\x1f\x85\xa0 　'stre²½éñ漢\U0001F600.,!aaaeeetthhhing   "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    assert ids(vocab, texts) == [known.encode_ordinary(t) for t in texts]


def test_long_words_and_runs(known, vocab):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefghij") for _ in range(20_000)), "a" * 4_999, "ab" * 3_000, " " * 777, "<|endoftext|>", ""]
    assert ids(vocab, texts) == [known.encode_ordinary(t) for t in texts]
    words = [t.encode() for t in ("banana", "aaaa", "the", "x")]
    assert vocab.replay(words) == [vocab.replay_one(w) for w in words]
    assert vocab.replay([]) == []


def test_query_and_round_trip(spark, known):
    rows = [(1, "The cat's  hat.\n"), (2, None), (3, ""), (1, "é 漢字"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", bpe_lit())
    got = sorted(map(tuple, bpe.digests(df, PATH, P.PATTERN).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        own = known.encode_ordinary(t or "")
        want.append((i, len(own), sha(" ".join(map(str, own)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=str)
    back = bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH).collect()
    assert sorted(bytes(r.data) for r in back) == sorted((t or "").encode() for _, t in rows)
    assert bpe.digests(df.limit(0), PATH, P.PATTERN).count() == 0


def bpe_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_with_tokens_across_steps(spark, known, monkeypatch):
    """Pieces met in earlier steps, with few kept, and rows without text; columns pass unchanged."""
    monkeypatch.setattr(bpe, "REPLAYED_BESIDE", 600)
    monkeypatch.setattr(bpe, "KNOWN", 7)
    rng = random.Random(6)
    words = ["the", "Straße", "re-run", "漢字", "x" * 60, "a\tb", "don't", "  ", "aaaa", "𝒳y", ""]
    rows = [(None, None), (0, ""), *((i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(200))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.text, r.token_ids, r.n_tokens, r.decodes) for r in bpe.with_tokens(df, PATH, P.PATTERN).collect()), key=str)
    assert got == sorted(((i, t, (own := known.encode_ordinary(t or "")), len(own), True) for i, t in rows), key=str)


@pytest.mark.parametrize("kept", [bpe.REPLAYED, 3_000])
def test_digests_across_steps(spark, known, monkeypatch, kept):
    """Pieces met in earlier steps of a task, with all kept or few, beside odd spaces and rows without text."""
    monkeypatch.setattr(bpe, "REPLAYED", 600)
    monkeypatch.setattr(bpe, "MET", kept)
    rng = random.Random(7)
    words = ["the", "Straße", "re-run", "漢字", "x" * 60, "a\tb", "don't", "\n", "aaaaaa", "𝒳y", "", "\x85", "e\n"]
    rows = [(None, None), (0, ""), (1, " "), (2, " a"), (3, "a "), *((i, " ".join(rng.choice(words[:rng.choice([7, 13])]) for _ in range(rng.randint(0, 60)))) for i in range(4, 200))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(own := known.encode_ordinary(t or "")), sha(" ".join(map(str, own)).encode()), sha((t or "").encode())) for i, t in rows]
    assert sorted(map(tuple, bpe.digests(df, PATH, P.PATTERN).collect()), key=str) == sorted(want, key=str)


def test_words_of_a_task_are_replayed_once(monkeypatch):
    """The task of digests alone, in four steps over the same words."""
    from types import SimpleNamespace

    import pyarrow as pa

    context = SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x))
    docs = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context), selectExpr=lambda *a: SimpleNamespace(mapInArrow=lambda task, schema: task))
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=12)) for _ in range(50)]
    texts = ["x " + " ".join(rng.sample(words, 50)) for _ in range(4)]
    monkeypatch.setattr(bpe, "REPLAYED", len(texts[0]) + 50)
    replayed = []
    monkeypatch.setattr(bpe.Vocabulary, "replay", lambda self, words, f=bpe.Vocabulary.replay: replayed.extend(words) or f(self, words))
    batch = pa.RecordBatch.from_arrays([pa.array(range(4), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    assert len(list(bpe.digests(docs, PATH, P.PATTERN)(iter([batch])))) == 4
    assert 0 < len(replayed) == len(set(replayed)) <= 50


def test_tokens_of_long_task_in_little_memory(vocab):
    """Some megabytes of text in steps, as a task of with_tokens takes them: less than a hundred bytes a byte of a step."""
    import tracemalloc
    from array import array

    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(60_000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(bpe.REPLAYED_BESIDE * 3 // 1950)]
    step = len(texts) // 3
    held: dict[str | tuple[str], array] = {}
    want = ids(vocab, texts[-5:])
    tracemalloc.start()
    for k in range(0, len(texts), step):
        rows, pieces = bpe.encode_again(vocab, texts[k:k + step], held)
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows, pieces = bpe.encode_again(vocab, texts[-5:], held)
    assert [[t for i in r.tolist() for t in pieces[i]] for r in rows] == want
    assert len(held) <= bpe.KNOWN and top < 100 << 20
