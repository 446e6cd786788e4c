"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Each task gathers the distinct pre-tokens of its documents, lays them out as one array of
byte tokens and keeps an inverted index from merge rank (= token pair) to the positions where
the pair stands. Merges are taken from a heap in rank order; applying one changes only the
two neighbours of each touched position, whose new pairs are added to the index. A pair is
thus merged once per distinct pre-token of some megabytes of text, not once per occurrence;
``digests`` keeps the pieces of text that its task has met, so that later megabytes replay new
ones only, and ``with_tokens`` takes less text at a time and keeps the ids of short pieces.

Edge cases: a null text counts as empty; an empty text has no tokens; ids are never special
tokens; repeated rows give repeated results; a very long text is one step of a task, some
hundred bytes of its memory a distinct pre-token and four a token; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from dailylake.llm.common import chunks

#: Text bytes whose pre-tokens are replayed together; a task takes some fifty times that.
REPLAYED = 6 << 20
#: The same where a task carries whole rows along and its worker has served other stages.
REPLAYED_BESIDE = 1 << 20
#: Pieces whose ids a task keeps at a time, and the characters of the longest of them.
KNOWN, LONGEST = 100_000, 40
#: Bytes of memory (about) of the pieces that a task of ``digests`` keeps; beyond that it starts over.
MET = 160 << 20

ENCODED = "doc_id long, token_ids array<int>, n_tokens long"
DIGESTED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id from a rank file (bounded by the vocabulary); read on the driver."""
    with open(path, "rb") as f:
        ranks = {int(i): base64.b64decode(t) for t, i in (line.split() for line in f if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


class Vocabulary:
    """Token bytes, and the merged id of every pair of tokens that makes a token."""

    SHIFT = 20

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.texts = [b"%d" % i for i in range(len(tokens))]
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)])
        self.find = regex.compile(pattern).findall
        keys, merged = array("q"), array("i")
        for i, t in enumerate(tokens):
            for k in range(1, len(t)):
                a, b = self.ids.get(t[:k]), self.ids.get(t[k:])
                if a is not None and b is not None:
                    keys.append(a << self.SHIFT | b)
                    merged.append(i)
        order = np.argsort(np.frombuffer(keys, np.int64))
        self.pair_keys = np.frombuffer(keys, np.int64)[order]
        self.pair_ids = np.frombuffer(merged, np.int32)[order]
        self.byte_pairs = self.lookup(self.byte_ids[:, None], self.byte_ids[None, :])

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids of token pairs; -1 where the pair makes no token."""
        keys = left.astype(np.int64) << self.SHIFT | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ids[at], -1)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of every word: all merges of all words, in rank order.

        ``index`` maps a rank to the places whose pair had it when they were entered;
        places whose pair has changed since (``pair`` has the present one) are passed over.
        """
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        data = np.frombuffer(b"".join(words), np.uint8)
        token = self.byte_ids[data]
        after = np.arange(1, n + 1)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[ends - sizes] = -1
        pair = np.full(n, -1, np.int32)  # merged id of the pair that starts at a place
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        odd: list[np.ndarray] = []

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, own in zip(ranks[np.concatenate([[0], cuts])].tolist() if len(ranks) else (), np.split(places, cuts)):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(heap, rank)
                index[rank].append(own)

        inner = np.flatnonzero(after >= 0)
        pair[inner] = self.byte_pairs[data[inner], data[inner + 1]]
        inner = np.flatnonzero(pair >= 0)
        enter(inner, pair[inner])
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank)
            places = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            places = places[pair[places] == rank]
            if (after[places[:-1]] == places[1:]).any():  # a run such as aaa: from the left, without overlap
                kept, taken = [], -1
                for i in places.tolist():
                    if i != taken:
                        kept.append(i)
                        taken = int(after[i])
                places = np.array(kept)
            if not len(places):
                continue
            right = after[places]
            token[places], token[right] = rank, -1
            pair[places] = pair[right] = -1
            after[places] = follow = after[right]
            before[follow[follow >= 0]] = places[follow >= 0]
            lead = before[places]
            starts = np.concatenate([places[follow >= 0], lead[lead >= 0]])
            pair[starts] = found = self.lookup(token[starts], token[after[starts]])
            starts, found = starts[found >= 0], found[found >= 0]
            if (found <= rank).any():
                odd.append(starts[found <= rank])
            enter(starts, found)
        alive = token >= 0
        flat = token[alive].tolist()
        cuts = np.cumsum(alive)[ends - 1].tolist()
        out = [flat[a:b] for a, b in zip([0, *cuts], cuts)]
        if odd:  # here a merge made a pair of no higher rank, so the order within the word matters
            for w in np.unique(np.searchsorted(ends, np.concatenate(odd), side="right")).tolist():
                out[w] = self.replay_one(words[w])
        return out

    def replay_one(self, word: bytes) -> list[int]:
        """The same for one word, always the lowest rank first, leftmost among equals."""
        token = [int(self.byte_ids[b]) for b in word]
        after = [*range(1, len(token)), -1]
        before = [*range(-1, len(token) - 1)]

        def rank_of(i: int, j: int) -> int | None:
            rank = int(self.lookup(np.array([token[i]]), np.array([token[j]]))[0])
            return None if rank < 0 else rank

        heap = [(r, i, i + 1) for i in range(len(token) - 1) if (r := rank_of(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, j = heapq.heappop(heap)
            if token[i] < 0 or after[i] != j or rank_of(i, j) != rank:
                continue
            token[i], token[j] = rank, -1
            k, p = after[j], before[i]
            after[i] = k
            if k >= 0:
                before[k] = i
                if (new := rank_of(i, k)) is not None:
                    heapq.heappush(heap, (new, i, k))
            if p >= 0 and (new := rank_of(p, i)) is not None:
                heapq.heappush(heap, (new, p, i))
        return [t for t in token if t >= 0]


#: A space before white space or the end of a text; one after other white space. (Apart they are found faster.)
_SPACE_ODD, _ODD_SPACE = re.compile(r" (?:\s|$)"), re.compile(r"[^\S ] ")


class _Numbers(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _split(vocab: Vocabulary, texts: list[str | None], numbers: _Numbers | None = None) -> tuple[list[np.ndarray], list[str | tuple[str]]]:
    """For each text the numbers of its pieces, and by number the pieces that ``numbers`` didn't have before.

    A piece is the text between two single spaces (with the space before it) where neither
    side of the space is white space: no pre-token crosses such a space, so pieces can be
    split into pre-tokens each by itself. Texts with other white space around a space are
    split into pre-tokens as a whole.
    """
    numbers = _Numbers() if numbers is None else numbers
    before = len(numbers)
    rows = []
    for text in texts:
        text = text or ""
        if text[:1] == " " or _SPACE_ODD.search(text) or _ODD_SPACE.search(text):
            keys = [(w,) for w in vocab.find(text)]
        else:  # a piece is numbered by its text after the space, other pre-tokens as a tuple
            first, *keys = text.split(" ")
            keys[:0] = [(w,) for w in vocab.find(first)]
        rows.append(np.fromiter(map(numbers.__getitem__, keys), np.int32, len(keys)))
    return rows, list(islice(numbers, before, None))


def encode_texts(vocab: Vocabulary, texts: list[str | None]) -> tuple[list[np.ndarray], list[list[int]]]:
    """For each text the numbers of its pieces, and the token ids of each piece."""
    rows, keys = _split(vocab, texts)
    return rows, _encode_pieces(vocab, keys)


def encode_again(vocab: Vocabulary, texts: list[str | None], known: dict[str | tuple[str], array]) -> tuple[list[np.ndarray], list[array]]:
    """The same, with the ids of short pieces taken from ``known`` and kept there for the next texts."""
    rows, keys = _split(vocab, texts)
    found = [known.get(k) for k in keys]
    new = [i for i, ids in enumerate(found) if ids is None]
    for i, ids in zip(new, _encode_pieces(vocab, [keys[i] for i in new])):
        found[i] = array("i", ids)
        if len(keys[i] if isinstance(keys[i], str) else keys[i][0]) <= LONGEST:
            if len(known) >= KNOWN:
                known.clear()
            known[keys[i]] = found[i]
    return rows, found


def _encode_pieces(vocab: Vocabulary, keys: list[str | tuple[str]]) -> list[list[int]]:
    """Token ids of distinct pieces."""
    pieces = [k[0] if isinstance(k, tuple) else " " + k for k in keys]
    words = _Numbers()
    spread = [list(map(words.__getitem__, vocab.find(p))) if isinstance(k, tuple) else None for k, p in zip(keys, pieces)]
    plain = [i for i, s in enumerate(spread) if s is None]
    tokens = vocab.find("".join([pieces[i] for i in plain]))
    own = np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)).tolist()
    last = np.searchsorted(np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens))), np.cumsum(np.fromiter((len(pieces[i]) for i in plain), np.int64, len(plain)))) + 1
    start = 0
    for i, end in zip(plain, last.tolist()):
        spread[i] = own[start:end]
        start = end
    known = [vocab.ids.get(w.encode()) for w in words]
    replayed = iter(vocab.replay([w.encode() for w, i in zip(words, known) if i is None]))
    by_word = [[i] if i is not None else next(replayed) for i in known]
    return [by_word[s[0]] if len(s) == 1 else [t for w in s for t in by_word[w]] for s in spread]


class _Met:
    """The pieces that a task has met, and by their numbers what they are encoded to."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.numbers = _Numbers()
        self.lengths: list[int] = []
        self.ids: list[bytes] = []
        self.back: list[bytes] = []
        self.size = 0

    def numbers_of(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text the numbers of its pieces; those not met before are encoded, and their ids decoded."""
        rows, new = _split(self.vocab, texts, self.numbers)
        words, tokens = self.vocab.texts, self.vocab.tokens
        for ids in _encode_pieces(self.vocab, new):
            self.lengths.append(len(ids))
            self.ids.append(b" ".join([words[t] for t in ids]))
            self.back.append(b"".join([tokens[t] for t in ids]))
            self.size += 200 + len(self.ids[-1]) + 2 * len(self.back[-1])
        return rows


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``token_ids``, ``n_tokens`` of every row, as the rank file's encoder gives them."""
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = None
        for part in chunks(batches, limit=REPLAYED):
            vocab = vocab or Vocabulary(tokens.value, pattern)
            rows, pieces = encode_texts(vocab, part.column(1).to_pylist())
            lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
            counts = [int(lengths[r].sum()) for r in rows]
            offsets = np.concatenate([[0], np.cumsum(counts)])
            values = np.fromiter((t for r in rows for i in r.tolist() for t in pieces[i]), np.int32, int(offsets[-1]))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([part.column(0).combine_chunks(), ids, pa.array(counts, pa.int64())], ["doc_id", "token_ids", "n_tokens"])

    return _texts(docs, id_col, text_col).mapInArrow(task, ENCODED)


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode again; per row the number of ids and the hashes of ids and decoded bytes."""
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = met = None
        for part in chunks(batches, limit=REPLAYED):
            vocab = vocab or Vocabulary(tokens.value, pattern)
            met = met if met and met.size <= MET else _Met(vocab)
            rows = met.numbers_of(part.column(1).to_pylist())
            counts, ids_sha, back_sha = [], [], []
            for r in rows:
                own = r.tolist()
                counts.append(sum(map(met.lengths.__getitem__, own)))
                ids_sha.append(hashlib.sha256(b" ".join(map(met.ids.__getitem__, own))).hexdigest())
                back_sha.append(hashlib.sha256(b"".join(map(met.back.__getitem__, own))).hexdigest())
            columns = [part.column(0).combine_chunks(), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs, id_col, text_col).mapInArrow(task, DIGESTED)


def with_tokens(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` and ``token_ids``, ``n_tokens`` and ``decodes``: whether decoding the
    ids gave the text again. Columns of these names are replaced."""
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    names = ("token_ids", "n_tokens", "decodes")
    own = docs.select([c for c in docs.columns if c.lower() not in names])
    at = own.columns.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = None
        known: dict[str | tuple[str], array] = {}
        for part in chunks(batches, at, REPLAYED_BESIDE):
            vocab = vocab or Vocabulary(tokens.value, pattern)
            texts = part.column(at).to_pylist()
            rows, pieces = encode_again(vocab, texts, known)
            ids = [b"".join([pieces[i] for i in r.tolist()]) for r in rows]
            right = [b"".join([vocab.tokens[t] for t in memoryview(i).cast("i")]) == (t or "").encode() for i, t in zip(ids, texts)]
            offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])])
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            del texts, rows, pieces, ids
            yield pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in part.columns), listed, pa.array(np.diff(offsets)), pa.array(right)], [*part.column_names, *names])

    schema = StructType([*own.schema.fields, *StructType.fromDDL("token_ids array<int>, n_tokens long, decodes boolean").fields])
    return own.mapInArrow(task, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id`` and the bytes (``data``) that the ids of ``token_ids`` stand for; null ids give none."""
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = tokens.value
            data = [b"".join([known[t] for t in ids or ()]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "token_ids").mapInArrow(task, "doc_id long, data binary")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: digests of every document under the public 50k rank file."""
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
