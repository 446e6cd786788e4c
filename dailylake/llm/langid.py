"""Language identification with language-bitmask n-gram filters.

Learning counts character trigrams by language over all training rows. A language contains a
trigram if its share of the language's trigrams is at least ``MIN_SHARE`` (so a language has
at most ``1 / MIN_SHARE`` of them) and ``MIN_RATIO`` of the highest share that any language
has. The filter is a Bloom filter with one bit slice for each language: a slot holds a
bitmask of languages, and a trigram's languages are the AND of its slots, so one probe
returns all languages that contain it. A text is decided by the popcount of its trigrams
in each slice, corrected by the slice's false-positive rate (its fill to the power of the
number of probes). The filter has ``SLOTS`` slots whatever the corpus holds, so it can be
collected and broadcast.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, and so is every
text if nothing could be learned; a text whose trigrams are in no language gets the language
with most training rows, score 0; ties go the same way, then to the smaller name; null
languages teach nothing; repeated rows count and are answered as often as they occur; a very
long text is one step of a task, at some fifty bytes of its memory a character; more languages
than ``MOST`` are an error; an empty table gives an empty result; other columns of the input are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.llm.common import chunks, materialize

SLOTS = 1 << 21
PROBES = 3
MIN_SHARE = 1e-6
MIN_RATIO = 0.25
UNKNOWN = "und"
#: Languages in one word of a bitmask.
WORD = 32
#: Languages that are learned at most: the masks, on the driver and broadcast, take 8 MB for each 32.
MOST = 512
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@cache
def _letters() -> np.ndarray:
    """For each code point the lower-case letter, or a space where it is no letter."""
    low = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low[i] = ord(lc) if len(lc := c.lower()) == 1 else i
    return low


def trigrams(text: str | None) -> np.ndarray:
    """Trigrams of the lower-cased words, with a space at either end; 21 bits a character."""
    if not text:
        return np.empty(0, np.int64)
    c = _letters()[np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
    letter = c != 32
    c = c[letter | np.concatenate([[True], letter[:-1]])]  # one space between words
    if c[-1] != 32:
        c = np.append(c, 32)
    grams = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
    return grams[c[1:-1] != 32]


def slots(grams: np.ndarray) -> np.ndarray:
    """The slots of every trigram, one row for each probe."""
    mixed = grams.astype(np.uint64)
    mixed = mixed ^ mixed >> np.uint64(29)
    return ((mixed[None, :] * _ODD[:, None]) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def held_out(id_col: str, mod: int = 4, rest: int = 2) -> Column:
    """Whether crc32 of the id as text leaves this remainder (a null id: as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod == rest


class Filter:
    """The languages, and for each slot the bitmasks of those that set it."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        bits = [(masks[i // WORD] >> np.uint32(i % WORD)) & np.uint32(1) for i in range(len(languages))]
        self.false = np.array([float(b.mean()) ** PROBES for b in bits])

    def decide(self, text: str | None) -> tuple[str, float]:
        grams = trigrams(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        at = slots(grams)
        hits = np.zeros(len(self.languages))
        for word in range(len(self.masks)):
            found = self.masks[word][at[0]]
            for probe in range(1, PROBES):
                found = found & self.masks[word][at[probe]]
            for i in range(word * WORD, min(len(self.languages), (word + 1) * WORD)):
                hits[i] = np.count_nonzero(found & np.uint32(1 << (i % WORD)))
        true = np.maximum(0, (hits / len(grams) - self.false) / np.maximum(1e-9, 1 - self.false))
        best = int(true.argmax())
        return self.languages[best], float(true[best] / true.sum()) if true.sum() > 0 else 0.0


def count_trigrams(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang``, ``gram``, ``n`` over all rows with a language."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, limit=6 << 20):  # a trigram takes eight times its character
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1)):
                by.setdefault(lang, []).append(trigrams(text.as_py()))
            for lang, found in by.items():
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])

    own = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return own.mapInArrow(task, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Filter:
    """Count, choose each language's trigrams, and gather the filter's slots."""
    found = docs.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).cast("string").alias("lang")).count()
    rows = found.limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} values of {lang_col}: the filter's masks would outgrow the driver; map them to languages first")
    names = [r.lang for r in sorted(rows, key=lambda r: (-r["count"], r.lang))]
    masks = np.zeros((-(-len(names) // WORD), SLOTS), np.uint32)
    if not names:
        return Filter(names, masks)
    spark = docs.sparkSession
    number = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "lang string, i int")
    counts = materialize(count_trigrams(docs, lang_col, text_col), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # MOST rows at most, as the numbers: broadcast
    shares = counts.join(F.broadcast(totals), "lang").join(F.broadcast(number), "lang").select("gram", "i", (F.col("n") / F.col("total")).alias("share"))
    top = shares.groupBy("gram").agg(F.max("share").alias("top"))
    kept = shares.join(top, "gram").where(f"share >= {MIN_SHARE} and share >= {MIN_RATIO} * top").select("gram", "i")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.column(1).to_numpy()
            at = slots(batch.column(0).to_numpy())
            for probe in at:
                yield pa.RecordBatch.from_arrays([pa.array(probe), pa.array(i // WORD), pa.array(np.left_shift(1, (i % WORD).astype(np.int64)))], ["slot", "word", "bit"])

    found = kept.mapInArrow(task, "slot long, word int, bit long").groupBy("slot", "word").agg(F.bit_or("bit").alias("mask")).toArrow()
    masks[found["word"].to_numpy(), found["slot"].to_numpy()] = found["mask"].to_numpy().astype(np.uint32)
    return Filter(names, masks)


def predict(docs: DataFrame, known: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((known.languages, known.masks))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filter(*shared.value)
        for part in chunks(batches):
            found = [own.decide(t.as_py()) for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0).combine_chunks(), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    own = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return own.mapInArrow(task, "doc_id long, lang_pred string, score double")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: learn from the rows that aren't held out, answer for all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = learn(docs.where(~held_out("doc_id")))
    out = predict(docs, known)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
