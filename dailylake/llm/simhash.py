"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most ``max_bits`` bits
share at least ``8 - max_bits`` of them, position by position: the guaranteed minimum of
matches. The inverted index holds, for every choice of that many positions, the bytes found
there. Two fingerprints meet in a posting list exactly if they reach the minimum, and in
``C(m, minimum)`` lists if they share ``m`` bytes, so the tally of lists is the tally of
bytes. Members of a list differ in the other ``max_bits`` bytes only, so a list holds at
most ``256 ** max_bits`` distinct fingerprints, however many documents there are. Inside a
list, links are found by probing: each member looks up the fingerprints within the bit
distance among the members, so work grows with the members and not with their pairs; a list
gives a spanning forest of its links, and components of the whole graph follow from those.

Exact copies meet first (one fingerprint each). Documents come back by a join with the
table of fingerprints.

Edge cases: null and empty texts have fingerprint zero, linked like any other; a null id
stays and takes no part in the minimum; repeated rows give repeated results; a very long
text is hashed whole, by one task, at some tens of bytes of its memory a word; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.llm.common import chunks, materialize
from dailylake.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
_LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set (bit 0 first); eight bits a pass."""
    counts = np.zeros(64, np.int64)
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & _LANES
        for part in np.split(lanes, range(255, len(lanes), 255)) if len(lanes) > 255 else [lanes]:
            total = int(part.sum(dtype=np.uint64))  # up to 255 ones in each byte: no carry
            for byte in range(8):
                counts[byte * 8 + shift] += total >> (8 * byte) & 255
    return counts


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned 64-bit number."""
    parts = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        hashes = np.array([digest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = [0, *(ends[:n - 1] + 1).tolist()]
        hashes = np.fromiter([digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1:].tolist())], np.uint64, n)
    if n < 2048:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        bits = bit_counts(hashes)
    return int(np.packbits(bits * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint as a signed long) and ``text_hash`` of every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            fps = np.array([fingerprint(t.as_py(), words) for t in part.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0).combine_chunks(), pa.array(fps.view(np.int64)), part.column(2).combine_chunks()], ["doc_id", "fp", "text_hash"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return own.mapInArrow(task, "doc_id long, fp long, text_hash long")


def _forest(members: np.ndarray, positions: tuple[int, ...], max_bits: int) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of one posting list; ``positions`` are the bytes that may differ."""
    where = {int(m): i for i, m in enumerate(members)}
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    flips = [1 << (8 * p + b) for p in positions for b in range(8)]
    masks = [sum(c) for k in range(1, max_bits + 1) for c in itertools.combinations(flips, k)]
    for i, m in enumerate(members.tolist()):
        if len(members) <= len(masks):  # a short list: compare with the later members
            rest = members[i + 1:]
            near = (i + 1 + np.flatnonzero(np.bitwise_count(rest ^ np.uint64(m)) <= max_bits)).tolist()
        else:
            near = [j for j in (where.get(m ^ x) for x in masks) if j is not None and j > i]
        for j in near:
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield m, int(members[j])


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a``-``b`` between distinct fingerprints ``fp`` whose closure is that of all links."""
    choices = list(itertools.combinations(range(8), 8 - max_bits))
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255)
    lists = []
    for n, kept in enumerate(choices):
        mask = sum(255 << (8 * p) for p in kept)
        signed = mask - (1 << 64) if mask >> 63 else mask
        lists.append(F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("shared")))
    postings = distinct.select("fp", F.explode(F.array(*lists)).alias("key")).select("key.choice", "key.shared", "fp")
    sums = postings.groupBy("choice", "shared").agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.count("*").alias("n"))
    sums = materialize(sums.where("n > 1"), "lists")
    pairs = sums.where("n = 2").where(F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= max_bits).select(F.col("low").alias("a"), F.col("high").alias("b"))
    long = sums.where("n > 2").select("choice", "shared")
    members = postings.join(long, ["choice", "shared"]).groupBy("choice", "shared").agg(F.collect_list("fp").alias("fps"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for choice, fps in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.sort(fps.values.to_numpy().view(np.uint64))
                free = tuple(p for p in range(8) if p not in choices[choice])
                if found := list(_forest(own, free, max_bits)):
                    ab = np.array(found, np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])

    return pairs.union(members.select("choice", "fps").mapInArrow(task, "a long, b long")).distinct()


def _rooted(own: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, its smallest id ``first``, and the ``root`` of its group, for the fingerprints of ``own``."""
    distinct = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct, max_bits))
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    own = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    rooted = _rooted(own, max_bits)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(smallest, "root").select("fp", "component_id")
    return own.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group, with its columns as they are.

    The row with the smallest id stays (null ids come last, the smaller hash of the text
    decides between rows of one id); of rows with equal id and text, any one.
    """
    own = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    rows = own.groupBy("fp", "doc_id", "text_hash").agg(F.count("*").alias("n")).join(_rooted(own, max_bits).select("fp", "root"), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n")
    kept = materialize(rows.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("llm_id"), F.col("k.text_hash").alias("llm_text"), (F.col("k.n") > 1).alias("llm_again")), "kept")
    key = docs[id_col].cast("long").eqNullSafe(F.col("llm_id")) & (F.xxhash64(docs[text_col]) == F.col("llm_text"))
    single = docs.join(kept.where("not llm_again"), key, "left_semi")
    again = docs.join(kept.where("llm_again"), key).dropDuplicates(["llm_id", "llm_text"])
    return single.select(*docs.columns).union(again.select(*docs.columns))


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: near-duplicate groups of all documents (3-word shingles, 2 bits)."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
