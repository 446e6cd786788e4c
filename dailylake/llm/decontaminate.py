"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item's text is contained in a document if the document has at least ``threshold`` of
the item's distinct word shingles. Items are partitioned by size (powers of two of their
shingle count), and each partition has its own sketch size: the item's smallest shingle
hashes, so many that a document may miss all shingles the threshold lets it miss and still
hold one of them. A sketch thus grows with the items of its partition and not with the
documents, and no contained item is lost, however long the document. Documents are searched
by their shingle hashes; a pair is a candidate if it meets enough of the sketch for the
threshold, and only candidates are verified, by the shingles themselves.

Everything is DataFrame functions. The sketches are broadcast if their counted rows are few,
and else joined by a shuffle; so are the candidates.

Edge cases: a text is lower-cased and cut into runs of letters and digits; an item with fewer
words than a shingle is one shingle, all its words, and is searched in the documents' shingles
of that many words, so it is found inside longer documents too; a text without words (or null)
has none and is never in a pair; a very long document is cut into shingles by one task, some
hundred bytes for a word; empty tables have no pairs; repeated items or rows give one pair; every text of an item id, null ids
included, is an item by itself, and a document has the id if it contains one of its texts;
a null id is an id of its own; other columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailylake.llm.common import materialize

WORDS = 5
THRESHOLD = 0.8
#: Rows (of two or three numbers) that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingles(text: Column, n: int = WORDS) -> Column:
    """The distinct shingles as strings."""
    def cut(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - (n - 1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) > 0, F.array_distinct(many)).otherwise(F.array().cast("array<string>"))

    return _bound(words_of(text), cut)


def shingle_hashes(text: Column, n: int = WORDS) -> Column:
    """The distinct shingles as hashes of their words' hashes; equal shingles have equal hashes."""
    def cut(h: Column) -> Column:
        whole = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)]))
        return F.when(F.size(h) > 0, F.array_distinct(F.slice(whole, 1, F.greatest(F.lit(1), F.size(h) - (n - 1))))).otherwise(F.array().cast("array<long>"))

    return _bound(F.transform(words_of(text), lambda w: F.xxhash64(w)), cut)


def sketches(items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """``item_id``, ``item_hash`` (of the text), ``hash`` of each item's sketch, and ``least``, the hits that a candidate needs.

    An item of ``size`` shingles may miss ``size - ceil(threshold * size)`` of them. The
    sketch size of a partition is that of its largest possible member, and one more.
    """
    own = items.select("item_id", F.xxhash64("text").alias("item_hash"), F.explode(shingle_hashes(F.col("text"), n)).alias("hash")).distinct()
    item = Window.partitionBy("item_id", "item_hash")
    own = own.withColumn("size", F.count("*").over(item)).withColumn("place", F.row_number().over(item.orderBy("hash")))
    missed = lambda size: size - F.ceil(size * threshold - 1e-9)
    top = F.pow(F.lit(2.0), F.floor(F.log2("size")) + 1) - 1
    own = own.withColumn("length", F.least(F.col("size"), missed(top) + 1))
    return own.where("place <= length").select("item_id", "item_hash", "hash", (F.col("length") - F.least(missed(F.col("size")), F.col("length") - 1)).cast("int").alias("least"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """Pairs of a document (``doc_id`` and ``text_hash``) and an item with at least the threshold.

    ``docs``: doc_id, text; ``items``: item_id, text. An id with several texts may have
    several pairs with a document, of different ``n_shingles``. Items of fewer than ``n``
    words are searched by their own number of words, each number that occurs in a pass.
    """
    docs = docs.select(F.col("doc_id"), F.col("text"), F.xxhash64("text").alias("text_hash"))
    items = items.select(F.col("item_id"), F.col("text")).distinct().withColumn("item_hash", F.xxhash64("text"))
    items = items.withColumn("words", F.least(F.lit(n), F.size(words_of(F.col("text")))))
    lengths = sorted(r["words"] for r in items.where("words > 0").select("words").distinct().collect())  # n at most
    found = [_contained(docs, items.where(F.col("words") == k).drop("words"), threshold, k) for k in lengths or [n]]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _contained(docs: DataFrame, items: DataFrame, threshold: float, n: int) -> DataFrame:
    """:func:`contained` by shingles of ``n`` words."""
    sketch = materialize(sketches(items, threshold, n), "sketches")
    found = docs.select("doc_id", "text_hash", F.explode(shingle_hashes(F.col("text"), n)).alias("hash")).join(_few(sketch), "hash")
    hits = found.groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(F.countDistinct("hash").alias("hits"), F.first("least").alias("least"))
    candidates = materialize(hits.where("hits >= least").select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), F.col("item_id").alias("of_item"), F.col("item_hash").alias("of_item_text")), "candidates")
    whole = items.select("item_id", "item_hash", shingles(F.col("text"), n).alias("wanted"))
    pairs = docs.join(_few(candidates), F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text"))).select("doc_id", "text_hash", "of_item", "of_item_text", shingles(F.col("text"), n).alias("own"))
    pairs = pairs.join(whole, F.col("of_item").eqNullSafe(F.col("item_id")) & (F.col("of_item_text") == F.col("item_hash")))
    verified = pairs.select("doc_id", "text_hash", "item_id", F.size("wanted").cast("long").alias("n_shingles"), F.size(F.array_intersect("wanted", "own")).cast("long").alias("n_shared"))
    return verified.where(F.col("n_shared") >= F.col("n_shingles") * threshold - 1e-9).distinct()


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns as they are."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    bad = materialize(contained(own, items, threshold, n).select(F.col("doc_id").alias("llm_id"), F.col("text_hash").alias("llm_text")).distinct(), "contaminated")
    return docs.join(_few(bad), docs[id_col].eqNullSafe(F.col("llm_id")) & (F.xxhash64(docs[text_col]) == F.col("llm_text")), "left_anti")


def best_pairs(pairs: DataFrame) -> DataFrame:
    """One row for a document id and an item id: the text that the document holds most of, then the longest."""
    pairs = pairs.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    best = pairs.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shingles", "n_shared")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_shingles", "best.n_shared", "best.containment")


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: every document with every benchmark item that it contains."""
    return best_pairs(contained(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


CONTAMINATION_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, text FROM (SELECT DISTINCT doc_id, text FROM documents)),
items AS (SELECT row_number() OVER () AS t, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
doc_words AS (SELECT d, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM docs),
item_words AS (SELECT t, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM items),
item_grams AS (
  SELECT DISTINCT t, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT t, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
doc_grams AS (
  SELECT DISTINCT d, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT d, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc_words, (SELECT DISTINCT k FROM item_grams) WHERE len(w) >= k)),
sizes AS (SELECT t, count(*) AS n_shingles FROM item_grams GROUP BY t),
shared AS (SELECT d, t, count(*) AS n_shared FROM item_grams JOIN doc_grams USING (k, g) GROUP BY d, t),
pairs AS (
  SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
  FROM shared JOIN sizes USING (t) JOIN docs USING (d) JOIN items USING (t) WHERE n_shared >= 0.8 * n_shingles - 1e-9)
SELECT doc_id, item_id, n_shingles, n_shared, containment FROM pairs
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY containment DESC, n_shingles DESC) = 1
"""
