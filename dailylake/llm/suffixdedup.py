"""Repeated passages by longest-previous-factor arrays over a sparse suffix order.

A passage is a string of ``length`` bytes that starts at more than one place. Suffixes that
share their first ``length`` bytes must meet in one task, so every such window is dealt by an
anchor that depends on the window alone: its ``GRAM``-byte gram of smallest hash. Neighbouring
windows share their anchor and form a run, some hundred windows long, and only runs are
shuffled (numbers, no text):

1. Runs of one anchor gram that are alike in all their bytes are copies as a whole.
2. Of the runs that are left, only those whose gram occurs elsewhere can hold a passage. One
   run of each kind is cut out of its text and sent to its gram. There the windows' suffixes
   are sorted, adjacent ones give the longest common prefixes, and previous and next smaller
   positions in suffix order give each window's longest previous factor (and, with positions
   reversed, the longest next factor).
3. Grams with more than ``BUCKET`` kinds of runs go on by blocks of windows and, where a block
   is left open, by window: windows of equal bytes are one class of the suffix order, counted
   by partial aggregation, and the class's smallest position is the first copy. So a passage
   in a third of all documents is no task's burden.

``keep="none"`` removes every copy, ``keep="first"`` all but the first in the order of id and
place. Passages never cross documents. Equality in steps 1 and 3 is that of 128-bit hashes.

Edge cases: a null text counts as empty; a text shorter than a passage loses nothing;
repeated rows are copies of each other (``keep="first"`` can't tell rows apart that are alike
in id and text: they stay or go together); a null id sorts first; a very long text is one step of a task, at
some eighty bytes of its memory for each of its own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.llm.common import chunks, materialize

LENGTH = 400
GRAM = 50
#: Kinds of runs of one gram that a task sorts together at most.
BUCKET = 512
#: Windows of a block, for grams with more kinds: about the root of a run's windows, so that
#: blocks and the windows of those left open are as many.
BLOCK = 10
#: Windows that are sorted at a time; whole grams, so BUCKET runs more at most.
SORTED = 20_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Words of a passage that ``repeated`` names, and of the grams that deal its windows.
WORDS = 51
WORD_GRAM = 16
#: Text bytes that one step of that search holds at a time: some ten numbers a word.
WORD_BYTES = 3 << 20
_STEPS = (0xD1342543DE82EF95, 0x2545F4914F6CDD1D)
_HIGH = np.uint64(0xFFFFFFFF00000000)

RUNS = "doc_id long, th long, at int, wide int, lead int, gram long, s1 long, s2 long"


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (8 at least) at every place."""
    n = len(data) - gram + 1
    words = np.lib.stride_tricks.as_strided(np.frombuffer(data, np.uint8), (len(data) - 7, 8), (1, 1)).copy().view(np.uint64)[:, 0]
    h = np.zeros(n, np.uint64)
    for o in sorted({*range(0, gram - 7, 8), gram - 8}):
        h = (h ^ words[o:o + n]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def _anchors(h: np.ndarray, n: int) -> np.ndarray:
    """For every window of ``n`` grams the place of the one of smallest hash."""
    m = len(h)
    value = (h & _HIGH) | np.arange(m, dtype=np.uint64)  # the place decides between equals: leftmost
    blocks = np.concatenate([value, np.full(-m % n, np.iinfo(np.uint64).max)]).reshape(-1, n)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = m - n + 1
    return (np.minimum(right[:windows], left[n - 1:n - 1 + windows]) & ~_HIGH).astype(np.int64)


def runs(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of every run, its anchor, and the anchor's gram hash."""
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none, none, none
    h = gram_hashes(data, gram)
    anchor = _anchors(h, length - gram + 1)
    cut = np.flatnonzero(np.diff(anchor)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(anchor) - 1]])
    return first, last, anchor[first], h[anchor[first]].view(np.int64)


def previous_factors(order: list[int], shared: list[int]) -> list[int]:
    """For each position the longest prefix it shares with a smaller one.

    ``order``: positions in suffix order; ``shared[k]``: common prefix of the k-th suffix with
    the one before. The nearest smaller positions on either side in suffix order suffice.
    """
    best = [0] * len(order)
    for positions, prefix in ((order, shared), (order[::-1], [0, *shared[:0:-1]])):
        stack: list[tuple[int, int]] = []  # smaller positions, each with its prefix to the one below
        for p, s in zip(positions, prefix):
            while stack and stack[-1][0] > p:
                s = min(s, stack.pop()[1])
            if stack and s > best[p]:
                best[p] = s
            stack.append((p, s))
    return best


def factors(spans: list[bytes], length: int) -> tuple[list[int], list[int]]:
    """Longest previous and next factors (up to ``length``) of all windows of the spans, in order."""
    windows = [s[i:i + length] for s in spans for i in range(len(s) - length + 1)]
    order = sorted(range(len(windows)), key=windows.__getitem__)
    shared = [0] * len(order)
    whole = 8 * length
    number = int.from_bytes
    for k in range(1, len(order)):
        a, b = windows[order[k - 1]], windows[order[k]]
        shared[k] = length if a == b else (whole - (number(a) ^ number(b)).bit_length()) // 8
    previous = previous_factors(order, shared)
    top = len(order) - 1
    following = previous_factors([top - p for p in order], shared)[::-1]
    return previous, following


def _reach(parts: list[bytes]) -> list[int]:
    """The longest prefix that each part shares with another one."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    best = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        n = min(len(parts[i]), len(parts[j]))
        a, b = parts[i][:n], parts[j][:n]
        shared = n if a == b else n - (7 + (int.from_bytes(a) ^ int.from_bytes(b)).bit_length()) // 8
        best[i], best[j] = max(best[i], shared), max(best[j], shared)
    return best


def candidates(spans: list[tuple[int, bytes]], length: int) -> list[tuple[int, int]]:
    """First and last window (last < first: none) of every run of one gram that may have an equal one.

    ``spans``: lead and bytes. Equal windows lie alike about the anchor, so a window takes no
    more bytes left of it, and none right of it, than the run shares with another one there.
    """
    before = _reach([data[:lead][::-1] for lead, data in spans])
    after = _reach([data[lead:] for lead, data in spans])
    return [(lead - b, lead + a - length) for (lead, _), b, a in zip(spans, before, after)]


def _stretches(flags: list[bool]) -> Iterator[tuple[int, int]]:
    """First and last of every stretch of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return zip(edges[::2].tolist(), (edges[1::2] - 1).tolist())


def all_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Every run of every document: place, width and lead (anchor's offset), gram, hash of its bytes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            out: list[list[np.ndarray]] = []
            for doc_id, th, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(1)):
                data = text.as_py()
                first, last, anchor, own = runs(data, length, gram)
                if len(first):
                    sums = b"".join([xxhash.xxh3_128_digest(data[a:b + length]) for a, b in zip(first.tolist(), last.tolist())])
                    s = np.frombuffer(sums, np.int64).reshape(-1, 2)
                    none = np.full(len(first), doc_id is None)
                    out.append([np.full(len(first), doc_id or 0), none, np.full(len(first), th), first, last - first, anchor - first, own, s[:, 0], s[:, 1]])
            if out:
                ids, none, th, *rest = (np.concatenate(c) for c in zip(*out))
                kinds = [pa.int32()] * 3 + [pa.int64()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=none), pa.array(th), *(pa.array(c, k) for c, k in zip(rest, kinds))], ["doc_id", "th", "at", "wide", "lead", "gram", "s1", "s2"])

    return docs.mapInArrow(task, RUNS)


def _same(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["of"]) & (left["th"] == right["of_th"])


def _sort_buckets(cut: DataFrame, length: int, first: bool) -> DataFrame:
    """Stretches of windows with copies, from the runs cut out of their texts; dealt by gram."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        windows = 0
        gram = None

        def solve() -> pa.RecordBatch:
            held.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
            own = [r for i, r in enumerate(held) if not i or r[:5] != held[i - 1][:5]]
            kept = {}
            for _, group in groupby(sorted(range(len(own)), key=lambda k: own[k][0]), key=lambda k: own[k][0]):
                places = list(group)
                for k, (a, b) in zip(places, candidates([own[k][4:] for k in places], length)):
                    if a <= b:
                        kept[k] = a, own[k][5][a:b + length]
            own = [(*own[k][:3], own[k][3] + a, data) for k, (a, data) in sorted(kept.items())]
            previous, following = factors([r[4] for r in own], length)
            rows, start = [], 0
            for r in own:
                n = len(r[4]) - length + 1
                flags = [p >= length or (not first and q >= length) for p, q in zip(previous[start:start + n], following[start:start + n])]
                rows += [(r[1], r[2], r[3] + a, r[3] + b + length) for a, b in _stretches(flags)]
                start += n
            columns = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["of", "of_th", "start", "end"])

        for batch in batches:
            columns = batch.to_pydict()
            for r in zip(*(columns[c] for c in ("gram", "doc_id", "th", "at", "lead", "data"))):
                if r[0] != gram and windows >= SORTED:
                    yield solve()
                    held, windows = [], 0
                gram = r[0]
                held.append(r)
                windows += len(r[5]) - length + 1
        if held:
            yield solve()

    return cut.repartition("gram").sortWithinPartitions("gram").mapInArrow(task, "of long, of_th long, start int, end int")


def _by_window(cut: DataFrame, length: int, first: bool) -> DataFrame:
    """The same for grams with very many kinds of runs, without a task for the gram.

    A run is split into blocks of ``BLOCK`` neighbouring windows by their distance to the
    anchor. Equal windows lie in blocks of equal number and equal core (the bytes that all
    windows of the block share). Blocks alike in all their bytes are copies as a whole;
    of the others only those whose core occurs elsewhere go on window by window, and equal
    windows are counted.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows, sums = [], []
            columns = [batch.column(c).to_pylist() for c in ("gram", "doc_id", "th", "at", "lead", "data")]
            for gram, of, th, at, lead, data in zip(*columns):
                last = len(data) - length  # windows 0 to last, at distances lead - i
                start = 0
                while start <= last:
                    number = (lead - start) // BLOCK
                    end = min(last, lead - number * BLOCK)
                    core = lead - number * BLOCK  # the block's last window, had the run all of them
                    rows.append((gram, number, of, th, at, at + start, end - start))
                    sums.append(digest(data[core:core - BLOCK + 1 + length]) + digest(data[start:end + length]))
                    start = end + 1
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                s = np.frombuffer(b"".join(sums), np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*rows), kinds)), *(pa.array(s[:, k]) for k in range(4))], ["gram", "number", "of", "of_th", "run", "start", "wide", "c1", "c2", "s1", "s2"])

    own = materialize(cut.mapInArrow(blocks, "gram long, number int, of long, of_th long, run int, start int, wide int, c1 long, c2 long, s1 long, s2 long").distinct(), "blocks")
    core = ["gram", "number", "c1", "c2"]
    alike = [*core, "wide", "s1", "s2"]
    place = F.struct("of", "of_th", "start")
    kinds = materialize(own.groupBy(*alike).agg(F.count("*").alias("n"), F.min(F.struct("of", "of_th", "start", "run")).alias("earliest")), "block-kinds")
    copies = own.join(kinds.where("n > 1").select(*alike, "earliest"), alike)
    if first:
        copies = copies.where(place != F.struct("earliest.of", "earliest.of_th", "earliest.start"))
    copies = copies.select("of", "of_th", "start", (F.col("start") + F.col("wide") + length).alias("end"))
    shared = kinds.groupBy(*core).agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("open")).where("kinds > 1" if first else "kinds > 1 and open > 0")
    wanted = kinds.join(shared, core).groupBy(F.col("gram").alias("of_gram"), "earliest.of", "earliest.of_th", "earliest.run").agg(F.collect_list(F.struct("earliest.start", "wide")).alias("blocks"))
    texts = cut.join(wanted, cut["doc_id"].eqNullSafe(wanted["of"]) & (cut["gram"] == wanted["of_gram"]) & (cut["th"] == wanted["of_th"]) & (cut["at"] == wanted["run"]))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sums = [], []
            for of, th, run, data, parts in zip(*(batch.column(c).to_pylist() for c in range(5))):
                for part in parts:
                    for k in range(part["start"], part["start"] + part["wide"] + 1):
                        rows.append((of, th, k))
                        sums.append(xxhash.xxh3_128_digest(data[k - run:k - run + length]))
            if rows:
                s = np.frombuffer(b"".join(sums), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32()))), pa.array(s[:, 0]), pa.array(s[:, 1])], ["of", "of_th", "start", "w1", "w2"])

    single = materialize(texts.select("of", "of_th", "run", "data", "blocks").mapInArrow(windows, "of long, of_th long, start int, w1 long, w2 long").distinct(), "windows")
    classes = single.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(place).alias("earliest")).where("n > 1")
    found = single.join(classes, ["w1", "w2"])
    if first:
        found = found.where(place != F.col("earliest"))
    return copies.unionByName(found.select("of", "of_th", "start", (F.col("start") + length).alias("end")))


def passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "none") -> DataFrame:
    """Intervals ``start``-``end`` (bytes) to remove, by document (``of``, ``of_th``); they may overlap.

    ``docs``: doc_id, data (bytes), th (hash of the data).
    """
    first = keep == "first"
    own = materialize(all_runs(docs.select("doc_id", "data", "th"), length, gram), "runs")
    alike = ["gram", "lead", "wide", "s1", "s2"]
    kinds = materialize(own.groupBy(*alike).agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "at")).alias("earliest")), "kinds")
    copies = own.join(kinds.where("n > 1").select(*alike, "earliest"), alike)
    if first:
        copies = copies.where(F.struct("doc_id", "th", "at") != F.col("earliest"))
    copies = copies.select(F.col("doc_id").alias("of"), F.col("th").alias("of_th"), F.col("at").alias("start"), (F.col("at") + F.col("wide") + length).alias("end"))
    # grams with several kinds of runs, of which some aren't known to be copies
    shared = kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("open")).where("kinds > 1" if first else "kinds > 1 and open > 0")
    wanted = kinds.join(shared, "gram").select("earliest.*", "gram", "lead", "wide", (F.col("kinds") > BUCKET).alias("many"))
    lists = wanted.groupBy(F.col("doc_id").alias("of"), F.col("th").alias("of_th")).agg(F.collect_list(F.struct("gram", "at", "lead", "wide", "many")).alias("runs"))
    joined = docs.join(lists, _same(docs, lists)).select("doc_id", "th", "data", "runs")

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 2):
            for doc_id, th, data, wanted_runs in zip(*(part.column(c).to_pylist() for c in range(4))):
                rows = [(r["gram"], doc_id, th, r["at"], r["lead"], data[r["at"]:r["at"] + r["wide"] + length], r["many"]) for r in wanted_runs]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["gram", "doc_id", "th", "at", "lead", "data", "many"])

    cut = materialize(joined.mapInArrow(slices, "gram long, doc_id long, th long, at int, lead int, data binary, many boolean"), "cut")
    return copies.unionByName(_sort_buckets(cut.where("not many").drop("many"), length, first)).unionByName(_by_window(cut.where("many").drop("many"), length, first))


def word_sums(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number of every word of the texts, and prefix sums of its two hashes times powers of ``_STEPS``."""
    words = [t.split() for t in texts]
    of = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    digest = xxhash.xxh3_128_digest
    hashes = np.frombuffer(b"".join([digest(w) for t in words for w in t]), np.uint64).reshape(-1, 2)
    sums = np.zeros((2, len(of) + 1), np.uint64)
    for k, step in enumerate(_STEPS):
        np.cumsum(hashes[:, k] * _powers(step, len(of)), out=sums[k, 1:])
    return of, sums, np.stack([_powers(pow(step, -1, 1 << 64), len(of) + 1) for step in _STEPS])


def _powers(step: int, n: int) -> np.ndarray:
    out = np.full(n, step, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_runs(texts: list[bytes], words: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, Callable[[np.ndarray, np.ndarray], np.ndarray]]:
    """Text number, first and last window, anchor and its gram's hash of every run; a function hashes words from-to."""
    of, sums, back = word_sums(texts)

    def hashed(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[:, end] - sums[:, start]) * back[:, start]

    windows = np.arange(max(0, len(of) - words + 1))
    windows = windows[of[windows] == of[windows + words - 1]]
    if not len(windows):
        none = np.empty(0, np.int64)
        return none, none, none, none, none, hashed
    places = np.arange(len(of) - gram + 1)
    h = hashed(places, places + gram)[0] * _MIX
    h ^= h >> np.uint64(29)
    anchor = _anchors(h, words - gram + 1)[windows]
    cut = np.flatnonzero(np.diff(anchor)) + 1
    first, last = windows[np.concatenate([[0], cut])], windows[np.concatenate([cut - 1, [len(windows) - 1]])]
    at = anchor[np.concatenate([[0], cut])]
    return of[first], first, last, at, h[at].view(np.int64), hashed


def repeated(docs: DataFrame, words: int = WORDS, gram: int = WORD_GRAM) -> DataFrame:
    """``of``, ``of_th`` of every document with a passage of ``words`` words that another row has too.

    Words are split at ASCII white space, whose kind and number don't matter. ``docs`` as for
    ``passages``. Windows of words are dealt as those of bytes are: of the runs whose gram two
    texts share, those alike as a whole settle their texts, and only grams that a text not settled
    shares go on by window. A text is known by its 64-bit hash, a window by 128 bits.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, limit=WORD_BYTES):
            th = part.column(0).to_numpy()
            of, first, last, anchor, own, hashed = word_runs(part.column(1).to_pylist(), words, gram)
            if len(of):
                # the place of the anchor counts too: runs alike in it have equal windows at equal places
                s = hashed(first, last + words) + ((anchor - first).astype(np.uint64) + np.uint64(1)) * _MIX
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (th[of], own, *s.view(np.int64))], ["th", "gram", "s1", "s2"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, limit=WORD_BYTES):
            th = part.column(0).to_numpy()
            of, first, last, _, own, hashed = word_runs(part.column(1).to_pylist(), words, gram)
            keep = np.isin(own, np.unique(part.column(2).combine_chunks().flatten().to_numpy()))
            size = (last - first + 1)[keep]
            at = np.repeat(first[keep] - np.cumsum(size) + size, size) + np.arange(size.sum())
            w = hashed(at, at + words).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.repeat(th[of[keep]], size), *w)], ["th", "w1", "w2"])

    ids = materialize(docs.groupBy("th").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")), "texts")
    own = materialize(docs.select("th", "data").mapInArrow(task, "th long, gram long, s1 long, s2 long"), "word-runs")
    # grams of two texts at least; what follows is small beside all runs
    pairs = own.groupBy("gram").agg(F.min("th").alias("a"), F.max("th").alias("b")).where("a != b").select("gram")
    met = materialize(own.join(pairs, "gram", "left_semi"), "word-runs-met")
    alike = ["gram", "s1", "s2"]
    kinds = materialize(met.groupBy(*alike).agg(F.min("th").alias("th"), F.max("th").alias("other")), "word-kinds")
    whole = met.join(kinds.where("th != other").select(*alike), alike).select("th")
    copies = own.select("th").distinct().join(ids.where("n > 1").select("th"), "th", "left_semi")
    settled = materialize(whole.unionByName(copies).distinct(), "settled")
    open_kinds = kinds.where("th = other").join(settled, "th", "left_anti").select("gram").distinct()
    wanted = kinds.join(open_kinds, "gram", "left_semi").groupBy("th").agg(F.collect_set("gram").alias("grams"))
    lists = wanted.join(ids, "th").select(F.col("th").alias("of_th"), F.col("doc_id").alias("of"), "grams")
    joined = docs.join(lists, _same(docs, lists)).select("th", "data", "grams")
    single = materialize(joined.mapInArrow(windows, "th long, w1 long, w2 long").distinct(), "word-windows")
    classes = single.groupBy("w1", "w2").agg(F.count("*").alias("texts")).where("texts > 1").select("w1", "w2")
    found = settled.unionByName(single.join(classes, ["w1", "w2"]).select("th")).distinct()
    return docs.select("doc_id", "th").join(found, "th").select(F.col("doc_id").alias("of"), F.col("th").alias("of_th"))


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "none", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans`` of every row.

    ``repeated``: whether the text has a passage of over 50 words that another row has too; such a
    passage may be shorter than ``length`` bytes and then stays in ``kept``.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), data.alias("data"), F.xxhash64(data).alias("th"))
    found = passages(own, length, gram, keep)
    cuts = found.select("of", "of_th", F.struct("start", "end").alias("cut"), F.lit(False).alias("again"))
    marks = repeated(own).select("of", "of_th", F.lit(None).cast("struct<start:int,end:int>").alias("cut"), F.lit(True).alias("again"))
    lists = materialize(cuts.unionByName(marks).groupBy("of", "of_th").agg(F.collect_set("cut").alias("cuts"), F.max("again").alias("again")), "cuts")
    joined = own.join(lists, _same(own, lists), "left").select("doc_id", "data", "cuts", F.coalesce("again", F.lit(False)).alias("again"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            rows = []
            for text, cuts in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                kept, end, removed, spans = [], 0, 0, 0
                for c in sorted(cuts or (), key=lambda c: (c["start"], c["end"])):
                    if c["start"] > end or not spans:
                        kept.append(text[end:c["start"]])
                        spans += 1
                        end = c["start"]
                    if c["end"] > end:
                        removed += c["end"] - end
                        end = c["end"]
                rows.append((b"".join([*kept, text[end:]]), len(text), removed, spans))
            columns = zip(*rows)
            numbers = [pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column(0).combine_chunks(), *numbers, part.column(3).combine_chunks()], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "repeated"])

    return joined.mapInArrow(task, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, repeated boolean")


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: what is left of every document without passages of 400 bytes that occur elsewhere.

    ``text`` is that rest to be read: a character that a passage cuts through is U+FFFD there, while
    the hash is that of the bytes. ``n_bytes`` is the length of the input. ``repeated`` names the
    documents with a passage of over 50 words that another one has too, removed or not.
    """
    out = remove(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rest = F.make_valid_utf8(F.col("kept").cast("string"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), rest.alias("text"), "repeated")
