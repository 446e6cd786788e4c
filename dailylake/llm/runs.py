"""Periodic runs of words by sparse diagonal matching.

A run is a stretch of consecutive words whose smallest period is ``q`` (words ``q`` apart are
identical), of at least ``min_words`` words and ``min_copies * q`` words, that no neighbouring
word extends with that period. ``collapse`` keeps a run's first period and drops the rest.

The method follows the matches of a word with its earlier occurrences along diagonals of equal
lag: a match that continues the diagonal of its lag adds one to that diagonal's length, and a
diagonal that ends long enough is a run. Letting every earlier occurrence of a frequent word
open a diagonal costs the square of its count, so the diagonals are taken by size class of the
lag. Class ``k`` (1, 2, 4, ...) holds the lags above ``k / 2`` up to ``k``, and its symbols are
the ``k`` words from a position on. Inside a run of period ``q <= k`` two equal symbols lie a
multiple of ``q`` apart, so a symbol's nearest earlier occurrence is on the run's diagonal and
no other need be followed: one match a symbol, and a run of period ``q`` is exactly one
unbroken diagonal of lag ``q``, because it has over ``k`` symbols that match. A symbol that
occurs once in its document can't be part of a larger one that recurs, so only positions with
repeated symbols go on to the next class; prose is mostly gone after two or three. The work is
the number of those positions, times a sort.

Edge cases: words are the maximal stretches of characters other than space and U+0009 to
U+000D; null and empty texts have no words and no runs; null ids and repeated rows are documents
like any other; of runs of one length the smallest start, then the smallest period counts as
longest; a very long text is taken whole, at some hundred bytes of a task's memory a word;
an empty table gives an empty result; other columns of the input pass unused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.llm.common import chunks, table

MIN_WORDS, MIN_COPIES = 6, 4
RUNS = "array<struct<start:long,length:long,period:long>>"
_SPACES = r"[\x20\x09-\x0D]+"
#: Text bytes whose words a task holds at a time.
HELD_BYTES = 4 << 20


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in a row, and the offsets of each text's words among them."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    real = pc.greater(pc.binary_length(lists.values), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return lists.values.filter(real), before[lists.offsets.to_numpy()]


def diagonals(words: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS, min_copies: int = MIN_COPIES) -> np.ndarray:
    """Runs of the documents ``words[offsets[d]:offsets[d + 1]]`` as rows (start in ``words``, length, period)."""
    n = len(words)
    end = np.repeat(offsets[1:], np.diff(offsets))
    at = np.arange(n)
    symbol = np.unique(words, return_inverse=True)[1] + end * (n + 1) if n else np.zeros(0, np.int64)
    found, k = [np.zeros((0, 3), np.int64)], 1
    while len(at):
        order = np.argsort(symbol, kind="stable")
        again = symbol[order[1:]] == symbol[order[:-1]]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:][again]] = (at[order[1:]] - at[order[:-1]])[again]
        # diagonals of this class: neighbouring positions that match at one lag
        match = np.flatnonzero((lag > k // 2) & (lag <= k))
        if len(match):
            where, q = at[match], lag[match]
            opens = np.flatnonzero(np.concatenate([[True], (np.diff(where) != 1) | (np.diff(q) != 0)]))
            closes = np.append(opens[1:], len(where)) - 1
            q = q[opens]
            length = where[closes] - where[opens] + k + q
            long_enough = length >= np.maximum(min_words, min_copies * q)
            found.append(np.stack([where[opens] - q, length, q], axis=1)[long_enough])
        # the next class's symbols: two symbols of this one side by side, both repeated
        repeated = np.zeros(len(at), bool)
        repeated[order[1:][again]] = True
        repeated[order[:-1][again]] = True
        rank = np.zeros(len(at), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(~again)])
        number = np.full(n, -1, np.int64)
        number[at[repeated]] = rank[repeated]
        at = at[repeated]
        at = at[at + 2 * k <= end[at]]
        at = at[number[at + k] >= 0]
        symbol = number[at] * (n + 1) + number[at + k]
        k *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: pa.Array, offsets: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Each document's words without the repeats of its runs, joined by one space."""
    n = len(words)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(cover)[:n] == 0
    before = np.concatenate([[0], np.cumsum(kept)])
    lists = pa.ListArray.from_arrays(pa.array(before[offsets], pa.int32()), words.filter(pa.array(kept)))
    return pc.binary_join(lists, " ")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_copies: int = MIN_COPIES) -> DataFrame:
    """``doc_id``, the ``runs`` by start (word numbers from 0) and the ``collapsed`` text of every row."""
    if min_copies < 4:
        raise ValueError("runs of fewer than four copies are not told apart by size class")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for part in chunks(batches, limit=HELD_BYTES):
            words, offsets = split_words(part.column(1).combine_chunks())
            numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            runs = diagonals(numbers, offsets, min_words, min_copies)
            first = np.searchsorted(runs[:, 0], offsets)
            own = runs[:, 0] - np.repeat(offsets[:-1], np.diff(first))
            rows = pa.StructArray.from_arrays([pa.array(c) for c in (own, runs[:, 1], runs[:, 2])], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).combine_chunks(), pa.ListArray.from_arrays(pa.array(first, pa.int32()), rows), collapsed(words, offsets, runs)],
                ["doc_id", "runs", "collapsed"])

    own = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return own.mapInArrow(task, f"doc_id long, runs {RUNS}, collapsed string")


def _longest(runs: Column) -> Column:
    keyed = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short")))
    return F.array_max(keyed)


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where one document in ten becomes periodic from some word on.

    With h = crc32 of the decimal id and h % 10 = 0, the p words from word a on are repeated to
    the end of the text (g = h // 10, a = g % n, p = 1 + (n - a) // (3 + g % 8)).
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    own = own.withColumn("words", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", _SPACES), "")))
    own = own.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    own = own.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)")))
    own = own.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    tail = "flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int)))"
    periodic = F.expr(f"array_join(slice(concat(slice(words, 1, a), {tail}), 1, n), ' ')")
    return own.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(periodic).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one, and the hashes of all runs and of the collapsed text."""
    top = found.select("*", _longest(F.col("runs")).alias("top"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.back")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.short")).alias("period"), F.expr("1000 * top.length div -top.short").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the periodic runs of every document, one in ten made periodic first."""
    return digests(find(planted(table(spark, sf_dir, "documents"))))
