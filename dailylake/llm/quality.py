"""Quality and toxicity by hierarchical empirical Bayes.

Evidence of a document: two logistic regressions (good, toxic) over the presence of words,
symbol runs and shape bins, fitted on at most ``SAMPLE`` labelled documents (one row for each
id), those of the smallest hash of the id. Evidence of its place: the expected number of good documents by host and by
path below it, aggregated over all rows. A site's rate is shrunk toward its parent's (path
toward host, host toward all) with a prior strength that the method of moments takes from
the spread between sites, so sparse sites stay near the global prior. A document's log odds
move by the difference of its path's posterior and the global rate.

For ``documents`` the host is ``source`` and the path below it ``lang``.

Edge cases: a null text counts as empty; null hosts or paths form a site of their own; label
rows without id, label or document don't count, and an id with several label rows has their
mean; of the rows of a labelled id the one of the smallest features is learned from; with
no labels, or labels of one kind, the odds are those of the labels alone (even for none), and
even odds reject nothing; a very long text is read whole, its distinct words held by one task;
an empty table gives an empty result; repeated rows count and are answered as often as they occur; other
columns pass unchanged through ``keep`` and are ignored by ``judge``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.llm.common import chunks, materialize

#: Labelled rows that the classifiers are fitted on, at most.
SAMPLE = 20_000
#: Size of the feature space, and how many features a classifier uses at most.
FEATURES = 1 << 18
CHOSEN = 2_000
HEADS = ("quality", "toxic")
#: Sites that are broadcast at most (about 100 bytes each); beyond, the join shuffles.
BROADCAST_SITES = 200_000

_SYMBOLS = re.compile(r"[^\w\s]+")


def _number(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % FEATURES


class Features:
    """Feature numbers of texts; ``only`` limits them to the chosen ones."""

    KNOWN = 400_000  # words whose numbers are kept at a time

    def __init__(self, only: set[int] | None = None):
        self.only, self.known = only, {}

    def _of(self, token: str) -> tuple[int, ...]:
        symbols = _SYMBOLS.findall(token)
        word = _SYMBOLS.sub("", token)
        found = {_number("w:" + word)} | {_number("s:" + s) for s in symbols}
        own = tuple(found if self.only is None else found & self.only)
        if len(self.known) >= self.KNOWN:
            self.known.clear()
        self.known[token] = own
        return own

    def __call__(self, text: str | None) -> set[int]:
        words = (text or "").split()
        found: set[int] = set()
        distinct = set(words)
        for w in {w.lower() for w in distinct}:
            own = self.known.get(w)
            found.update(self._of(w) if own is None else own)
        n = max(1, len(words))
        again = sum(map(str.__eq__, words, words[1:]))
        upper = sum(map(str.isupper, words))
        level = lambda x: 0 if not x else 1 + int(9.999 * x / n)
        shapes = {_number(f"b:again:{level(again)}"), _number(f"b:upper:{level(upper)}"), _number(f"b:distinct:{level(len(distinct))}"), _number(f"b:length:{n.bit_length()}")}
        return found | (shapes if self.only is None else shapes & self.only)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def fit_head(rows: list[np.ndarray], y: np.ndarray, chosen: np.ndarray, steps: int = 300, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights of the chosen features and the intercept; the odds of the labels if they are of one kind."""
    weights, bias = np.zeros(len(chosen)), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if not len(y) or y.min() == y.max() or not len(chosen):
        return weights, bias
    own = [np.searchsorted(chosen, r[np.isin(r, chosen)]) for r in rows]
    at = np.concatenate(own).astype(np.int64)
    row = np.repeat(np.arange(len(own)), [len(o) for o in own])
    mean, square = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for t in range(1, steps + 1):  # Adam over all rows
        z = np.bincount(row, weights[at], len(y)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        slope = np.append(np.bincount(at, error[row], len(chosen)) / len(y) + penalty * weights, error.mean())
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        move = 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def choose(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Features whose rates differ most between the two kinds of rows (z above 4, ``CHOSEN`` at most).

    ``counts``: for each feature its rows of kind 0 and 1; ``n``: all rows of either kind.
    """
    rate = counts.sum(axis=1) / max(1, n.sum())
    spread = np.sqrt(np.maximum(1e-12, rate * (1 - rate) * (1 / max(1, n[0]) + 1 / max(1, n[1]))))
    z = np.abs(counts[:, 1] / max(1, n[1]) - counts[:, 0] / max(1, n[0])) / spread
    z[counts.sum(axis=1) < 5] = 0
    best = np.argsort(-z, kind="stable")[:CHOSEN]
    return np.sort(best[z[best] > 4])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> dict[str, tuple[np.ndarray, np.ndarray, float]]:
    """For each head the chosen features, their weights and the intercept."""
    taught = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(*[F.avg(h).alias(h) for h in HEADS])
    known_ids = docs.select(F.col(id_col).alias("id")).distinct()
    taught = taught.where(" and ".join(f"{h} is not null" for h in HEADS)).join(known_ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(taught), "id").select("quality", "text", "toxic", "id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for part in chunks(batches):
            found = [sorted(features(t.as_py())) for t in part.column(1)]
            y = [pa.array(np.asarray(part.column(c).to_numpy()) >= 0.5) for c in (0, 2)]
            yield pa.RecordBatch.from_arrays([part.column(3).combine_chunks(), pa.array(found, pa.list_(pa.int32())), *y], ["id", "found", *HEADS])

    each = rows.withColumn("id", F.xxhash64("id")).mapInArrow(task, "id long, found array<int>, quality boolean, toxic boolean")
    rows = materialize(each.groupBy("id").agg(F.min("found").alias("found"), *[F.first(h).alias(h) for h in HEADS]).drop("id"), "taught")
    cells = rows.select(F.explode("found").alias("feature"), *HEADS).groupBy("feature").agg(
        *[F.sum((F.col(h) == F.lit(bool(k))).cast("long")).alias(f"{h}{k}") for h in HEADS for k in (0, 1)]).toArrow()
    known = {}
    chosen = {}
    for h in HEADS:
        counts = np.zeros((FEATURES, 2))
        for k in (0, 1):
            counts[cells["feature"].to_numpy(), k] = cells[f"{h}{k}"].to_numpy()
        n = rows.agg(F.count_if(~F.col(h)), F.count_if(h)).first()
        chosen[h] = choose(counts, np.array(n, float))
    wanted = F.array(*[F.lit(int(i)) for i in sorted(set().union(*(c.tolist() for c in chosen.values())))]).cast("array<int>")
    small = rows.select(F.array_intersect("found", wanted).alias("found"), *HEADS).toArrow()
    found = [np.asarray(f.values.to_numpy(zero_copy_only=False), np.int64) for f in small["found"]]
    for h in HEADS:
        y = np.asarray(small[h].to_numpy(), float)
        known[h] = (chosen[h], *fit_head(found, y, chosen[h]))
    return known


def evidence(docs: DataFrame, known: dict, text_col: str = "text") -> Column:
    """The log odds of both heads (a struct) for the text of a row, from the document alone."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("quality double, toxic double")
    def odds(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        heads = {h: (dict(zip(c.tolist(), w.tolist())), b) for h, (c, w, b) in shared.value.items()}
        features = Features({i for weights, _ in heads.values() for i in weights})
        for part in texts:
            found = [features(t) for t in part]
            yield pd.DataFrame({h: [b + sum(weights.get(i, 0.0) for i in f) for f in found] for h, (weights, b) in heads.items()}, columns=list(HEADS), dtype=float)

    return odds(F.col(text_col).cast("string"))


def _prior(sites: DataFrame, head: str, rate: float) -> float:
    """Prior strength, in documents: what the spread between site means leaves beyond chance."""
    r = sites.where("n > 1").agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * (F.col(head) / F.col("n") - rate) ** 2).alias("s")).first()
    if not r["k"] or r["k"] < 2 or not 0 < rate < 1:
        return 1e6
    chance = rate * (1 - rate)
    between = max(1e-6 * chance, (r["s"] - r["k"] * chance) / r["n"])
    return float(min(1e6, max(1.0, chance / between - 1)))


def site_rates(scored: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Posterior rates by ``host`` and ``path``, and the global rates.

    ``scored``: host, path and both log odds of every row.
    """
    p = lambda h: 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col(h)))))
    paths = materialize(scored.groupBy("host", "path").agg(F.count("*").alias("n"), *[F.sum(p(h)).alias(h) for h in HEADS]), "sites")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", *HEADS)])
    all_rows = hosts.agg(*[F.sum(c).alias(c) for c in ("n", *HEADS)]).first()
    rates = {h: min(1 - 1e-6, max(1e-6, (all_rows[h] or 0.5) / (all_rows["n"] or 1))) for h in HEADS}
    upper = hosts.select(F.col("host").alias("of"), *[((F.col(h) + rates[h] * _prior(hosts, h, rates[h])) / (F.col("n") + _prior(hosts, h, rates[h]))).alias(f"host_{h}") for h in HEADS])
    own = {h: _prior(paths, h, rates[h]) for h in HEADS}
    lower = paths.join(upper, paths.host.eqNullSafe(upper.of)).select("host", "path", "n", *[f"host_{h}" for h in HEADS], *[((F.col(h) + F.col(f"host_{h}") * own[h]) / (F.col("n") + own[h])).alias(f"path_{h}") for h in HEADS])
    return materialize(lower, "rates"), rates


def _judged(docs: DataFrame, scored: DataFrame, host: Column, path: Column) -> DataFrame:
    """``scored`` (with the struct ``llm_odds``) and ``llm_site``, ``llm_quality``, ``llm_toxic``, ``llm_keep``."""
    sites, rates = site_rates(docs.select(host.alias("host"), path.alias("path"), *[F.col(f"llm_odds.{h}").alias(h) for h in HEADS]))
    sites = sites.select(F.struct(*sites.columns).alias("llm_site"))
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    joined = scored.join(sites, host.eqNullSafe(F.col("llm_site.host")) & path.eqNullSafe(F.col("llm_site.path")))
    moved = lambda h: F.col(f"llm_odds.{h}") + _logit(F.col(f"llm_site.path_{h}")) - float(np.log(rates[h] / (1 - rates[h])))
    for h in HEADS:
        joined = joined.withColumn(f"llm_{h}", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), moved(h))))))
    return joined.withColumn("llm_keep", ~((F.col("llm_quality") < 0.5 - 1e-9) | (F.col("llm_toxic") > 0.5 + 1e-9)))


def _text(name: str | None) -> Column:
    return F.col(name).cast("string") if name else F.lit(None).cast("string")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``doc_id``, ``quality``, ``toxicity`` (posterior), ``host_quality``, ``path_quality``, ``kept`` of every row."""
    known = fit(docs, labels, id_col=id_col, text_col=text_col)
    scored = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), _text(host_col).alias("host"), _text(path_col).alias("path"), evidence(docs, known, text_col).alias("llm_odds")), "odds")
    out = _judged(scored, scored, scored["host"], scored["path"])
    return out.select("doc_id", F.col("llm_quality").alias("quality"), F.col("llm_toxic").alias("toxicity"), F.col("llm_site.host_quality").alias("host_quality"), F.col("llm_site.path_quality").alias("path_quality"), F.col("llm_keep").alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are good and not toxic, with their columns as they are.

    The rows are written once with their odds, so a text meets the classifier once.
    """
    known = fit(docs, labels, id_col=id_col, text_col=text_col)
    scored = materialize(docs.withColumn("llm_odds", evidence(docs, known, text_col)), "scored")
    return _judged(scored, scored, _text(host_col), _text(path_col)).where("llm_keep").select(*docs.columns)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: both judgements of every document."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
