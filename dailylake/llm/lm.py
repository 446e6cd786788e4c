"""Document probability from a subword lattice.

A word's probability is the sum over all its segmentations into pieces of an existing
vocabulary, by the forward recursion in log space. The vocabulary's scores (ranks) give the
first weights of the pieces; their expected counts in the training words, each as often as it
occurs (forward and backward over the same lattice), then re-weight them. The pieces
themselves stay as they are. Pieces that begin a word and pieces inside one are two
distributions, and a word ends after each piece with a learned probability, so the
probabilities of all words sum to at most one. A text is its words, each after a decision to go
on, and then its end: ``P = e * prod((1 - e) * lattice(w))`` with ``e = (texts + 1) / (tokens + 2)``
of the training rows. Nothing but the lattice tells one word from another.

Words reach their values without a row for each word of each document: a task turns some
megabytes of text into a bundle (its distinct words, and the documents as numbers into
them). Only the words of bundles are shuffled, to be counted and scored, and come back to
their bundle, whose size bounds the group.

Edge cases: a null text counts as empty and has the end token only; a null id is not held
out; repeated rows count and are answered as often as they occur; with no training rows N
and V are 0, the base follows its formula and the score is the lattice's with the
vocabulary's own weights; a very long text is one row of a bundle, held whole by a task; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.llm.common import chunks, materialize
from dailylake.llm.langid import held_out

MOD, REST = 7, 2
#: Passes over all distinct training words that re-weight the pieces.
ROUNDS = 2
#: Weight, in words, of the vocabulary's own scores beside the expected counts.
PRIOR = 200.0
#: Scores from here down mark pieces without a rank.
UNSCORED = -1e8
START = "▁".encode()
#: Bytes of a word, its start mark included, whose probabilities a double can hold without logs.
SHORT = 40
BUNDLE_BYTES = 20 << 20
LN10 = math.log(10)

SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def read_pieces(path: str) -> list[tuple[bytes, float]]:
    """Piece bytes and scores of a sentencepiece file (bounded by the vocabulary)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            out.append((bytes([int(model.id_to_piece(i)[3:5], 16)]), -math.inf))
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            score = model.get_score(i)
            out.append((model.id_to_piece(i).encode(), score if score > UNSCORED else -math.inf))
    return out


def first_weights(pieces: list[tuple[bytes, float]]) -> dict[bytes, float]:
    """Probabilities from the scores, which are ranks (0, -1, ...): in inverse proportion to the rank.

    Every single byte has a small weight, so every word has a segmentation.
    """
    lowest = min((s for _, s in pieces if s > -math.inf), default=0.0)
    raw = {bytes([b]): 0.1 / (10 - lowest) for b in range(256)}
    raw[START] = 1 / (10 - lowest)
    for piece, score in pieces:
        raw[piece] = max(raw.get(piece, 0.0), 1 / (10 - (score if score > -math.inf else 10 * lowest)))
    return raw


class Lattice:
    """Log probabilities of first and inner pieces; every prefix of a piece is a key, None if it is no piece."""

    def __init__(self, weights: dict[bytes, float], stop: float):
        self.stop = stop
        self.tables: list[dict[bytes, float | None]] = []
        self.plain: list[dict[bytes, float | None]] = []  # the same without logs, for short words
        for inner in (False, True):
            own = {p: w for p, w in weights.items() if p.startswith(START) != inner}
            total = math.log(sum(own.values()))
            table: dict[bytes, float | None] = {}
            for p in own:
                for k in range(1, len(p)):
                    table.setdefault(p[:k], None)
            table |= {p: math.log(w) - total for p, w in own.items() if w > 0}
            self.tables.append(table)
            self.plain.append({p: None if w is None else math.exp(w) for p, w in table.items()})

    def arcs(self, text: bytes) -> list[tuple[int, int, bytes, float]]:
        """Pieces along the text as (from, to, piece, log probability), by their start."""
        out = []
        n = len(text)
        get, extra = self.tables[0].get, 0.0
        for i in range(n):
            for j in range(i + 1, n + 1):
                piece = text[i:j]
                p = get(piece, 0.0)  # log probabilities are below 0: 0 is no prefix
                if p is None:
                    continue
                if p == 0.0:
                    break
                out.append((i, j, piece, p + extra))
            if not i:
                get, extra = self.tables[1].get, math.log1p(-self.stop)
        return out

    @staticmethod
    def forward(arcs: list, n: int, exp=math.exp, log1p=math.log1p) -> list[float]:
        """For each place the log of the summed probability of all ways to it."""
        alpha = [-math.inf] * (n + 1)
        alpha[0] = 0.0
        for i, j, _, p in arcs:
            p += alpha[i]
            old = alpha[j]
            if old >= p:
                if old > -math.inf:
                    alpha[j] = old + log1p(exp(p - old))
            else:
                alpha[j] = p + log1p(exp(old - p))
        return alpha

    def log_probability(self, word: bytes) -> float:
        """Natural log of the sum over all segmentations (arcs and forward recursion in one)."""
        text = START + word
        n = len(text)
        exp, log1p, nowhere = math.exp, math.log1p, -math.inf
        alpha = [nowhere] * (n + 1)
        alpha[0] = 0.0
        get, extra = self.tables[0].get, 0.0
        for i in range(n):
            here = alpha[i]
            if here > nowhere:
                here += extra
                for j in range(i + 1, n + 1):
                    p = get(text[i:j], 0.0)
                    if p is None:
                        continue
                    if p == 0.0:
                        break
                    p += here
                    old = alpha[j]
                    alpha[j] = old + log1p(exp(p - old)) if old >= p else p + log1p(exp(old - p))
            if not i:
                get, extra = self.tables[1].get, log1p(-self.stop)
        return alpha[n] + math.log(self.stop)

    def expect(self, word: bytes, into: dict[bytes, float], times: float = 1.0) -> None:
        """Add the expected count of each piece in the word's segmentations, for a word that occurs ``times``.

        Shares below e^-30 of a word are left out: they can't change a sum of doubles."""
        text = START + word
        n = len(text)
        if n <= SHORT and self._expect_short(text, into, times):
            return
        arcs = self.arcs(text)
        alpha = self.forward(arcs, n)
        # the backward recursion is the forward one over the reversed arcs
        beta = self.forward([(n - j, n - i, piece, p) for i, j, piece, p in reversed(arcs)], n)
        whole = alpha[n]
        for i, j, piece, p in arcs:
            share = alpha[i] + p + beta[n - j] - whole
            if share > -30:
                into[piece] = into.get(piece, 0.0) + times * math.exp(share)


    def _expect_short(self, text: bytes, into: dict[bytes, float], times: float) -> bool:
        """The same recursions without logs; false if the numbers get too small for them."""
        n = len(text)
        alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
        alpha[0] = beta[n] = 1.0
        arcs = []
        get, on = self.plain[0].get, 1.0
        for i in range(n):
            here = alpha[i] * on
            if here > 0.0:
                for j in range(i + 1, n + 1):
                    p = get(text[i:j], -1.0)
                    if p is None:
                        continue
                    if p < 0.0:
                        break
                    arcs.append((i, j, text[i:j], p * on))
                    alpha[j] += here * p
            if not i:
                get, on = self.plain[1].get, 1.0 - self.stop
        if alpha[n] < 1e-250:
            return False
        part = times / alpha[n]
        for i, j, piece, p in reversed(arcs):
            after = p * beta[j]
            beta[i] += after
            into[piece] = into.get(piece, 0.0) + alpha[i] * after * part
        return True


def pack(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.astype(np.int32).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.int32)


def bundles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``bundle``, its distinct ``words``, their counts in training rows, and its documents."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = (context.partitionId() if context else 0) << 32
        for n, rows in enumerate(chunks(batches, limit=BUNDLE_BYTES)):
            numbers: dict[bytes, int] = {b"": 0}  # the end token; no word is empty
            held = rows.column(2).to_numpy()
            ids, counts, sizes = [], [], []
            for text in rows.column(1):
                own: dict[bytes, int] = {}
                for w in (text.as_py() or "").encode("utf-8", "replace").lower().split():
                    own[w] = own.get(w, 0) + 1
                own[b""] = 1
                at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int32, len(own))
                order = np.argsort(at)
                ids.append(at[order])
                counts.append(np.fromiter(own.values(), np.int32, len(own))[order])
                sizes.append(len(own))
            at, tf = np.concatenate(ids), np.concatenate(counts)
            taught = ~np.repeat(held, sizes)
            learned = np.bincount(at[taught], tf[taught], len(numbers)).astype(np.int64)
            words = pa.array(list(numbers), pa.binary()).cast(pa.string())
            one = lambda a, kind: pa.array([a], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part + n]), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), one(learned, pa.int64()),
                 pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())), one(held, pa.bool_()), one(np.array(sizes, np.int32), pa.int32()),
                 pa.array([pack(np.concatenate([np.diff(x, prepend=0) for x in ids]))], pa.binary()), pa.array([pack(tf)], pa.binary())],
                ["bundle", "words", "learned", "doc_ids", "held", "sizes", "numbers", "counts"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held_out(id_col, MOD, REST).alias("held"))
    return own.mapInArrow(
        task, "bundle long, words array<string>, learned array<long>, doc_ids array<long>, held array<boolean>, sizes array<int>, numbers binary, counts binary")


def reweigh(words: DataFrame, weights: dict[bytes, float], stop: float, prior: dict[bytes, float]) -> tuple[dict[bytes, float], float]:
    """Weights of the pieces and the stopping probability from one pass over the distinct training words.

    ``words``: ``word`` and ``n``, how often it occurs.
    """
    shared = words.sparkSession.sparkContext.broadcast((weights, stop))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        found: dict[bytes, float] = {}
        n = 0
        for batch in batches:
            for w, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lattice.expect(w.encode(), found, times)
                n += times
        if n:
            found[b""] = n  # the number of words
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.float64())], ["piece", "n"])

    rows = words.mapInArrow(task, "piece binary, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # a row for each piece of the vocabulary
    counts = {bytes(r.piece): r.n for r in rows}
    n = counts.pop(b"", 0.0)
    if not n:
        return weights, stop
    total = sum(prior.values())
    return {p: counts.get(p, 0.0) + PRIOR * w / total for p, w in prior.items()}, n / max(n + 1e-9, sum(counts.values()))


def score(docs: DataFrame, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts, base score and the lattice's log10 probability of every row."""
    spark = docs.sparkSession
    packed = materialize(bundles(docs, id_col, text_col), "bundles")
    cells = packed.select("bundle", F.posexplode(F.arrays_zip("words", "learned"))).select(
        "bundle", F.col("pos").alias("number"), F.col("col.words").alias("word"), F.col("col.learned").alias("n"))
    counts = materialize(cells.groupBy("word").agg(F.sum("n").alias("n")), "counts")
    facts = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0), F.sum(F.when(F.col("word") == "", F.col("n")))).first()
    tokens, kinds, texts = (int(x or 0) for x in facts)
    end = (texts + 1) / (tokens + 2)
    prior = first_weights(read_pieces(pieces_path))
    weights, stop = prior, 0.3
    taught = counts.where("n > 0 and word <> ''")
    for _ in range(ROUNDS):
        weights, stop = reweigh(taught, weights, stop, prior)
    shared = spark.sparkContext.broadcast((weights, stop))

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in batches:
            p = [math.log1p(-end) + lattice.log_probability(w.encode()) if w else math.log(end) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, "p"])

    valued = materialize(counts.mapInArrow(value, "word string, n long, p double"), "words")
    back = cells.select("bundle", "number", "word").join(valued, "word").select(F.col("bundle").alias("of"), "number", "n", "p")

    def add_up(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=[x.split()[0] for x in SCORED.split(", ")])
        row = left.iloc[0]
        order = np.argsort(right["number"].to_numpy())
        n, p = right["n"].to_numpy()[order], right["p"].to_numpy()[order]
        steps, tf = unpack(row["numbers"]), unpack(row["counts"])
        length = np.asarray(row["sizes"], np.int64)
        starts = np.concatenate([[0], np.cumsum(length)[:-1]])
        at = np.cumsum(steps.astype(np.int64))
        at -= np.repeat(at[starts] - steps[starts], length)  # a document's steps start from 0
        add = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every document has the end token
        base = np.log10((n + 1.0) / (tokens + 1.0 * (kinds + 1)))
        return pd.DataFrame({
            "doc_id": pd.array(row["doc_ids"], dtype="Int64"), "held_out": np.asarray(row["held"], bool), "n_tokens": add(tf.astype(np.int64)),
            "n_known": add(np.where(n[at] > 0, tf, 0).astype(np.int64)), "train_tokens": tokens, "base_score": add(tf * base[at]), "score": add(tf * p[at]) / LN10})

    packs = packed.select("bundle", "doc_ids", "held", "sizes", "numbers", "counts")
    return packs.groupBy("bundle").cogroup(back.groupBy("of")).applyInPandas(add_up, SCORED)


def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: base score and lattice score of every document."""
    import public_tokenizers

    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
