"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and
cues of identifiers. From each anchor a deterministic local parser expands to the boundaries
of the address or number and validates it. The kinds ``email ip card phone`` follow fixed
patterns, leftmost and non-overlapping per kind, and a failing match is dropped. Three more
kinds are added: ``account`` (an IBAN that passes mod 97, or the number after an account
cue), ``secret`` (the value after a credential cue) and ``uri`` (a scheme with user
information, or mailto).

Edge cases: a null text counts as empty and has no spans; repeated rows give repeated
results; offsets are code points, end exclusive; a very long text is scanned whole, its
anchors (some hundred bytes each) held by one task; an empty table gives an empty result; other
columns of the input pass unused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailylake.llm.common import chunks

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "secret", "uri")
SPANS = "array<struct<kind:string,start:long,end:long>>"

_ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "konto", "compte", "cuenta")
_SECRET_CUES = ("token", "password", "passwd", "secret", "api_key", "apikey", "api-key")

_RUN = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IBAN = re.compile(r"[ \t]*[:=#]?[ \t]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?: ?(?:no\.?|number|nr\.?))?[ \t]*[:=#]?[ \t]*([0-9](?:[ -]?[0-9]){5,19})(?![A-Za-z0-9])")
_SECRET = re.compile(r"[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9_+/=.-]{8,})")
_USERINFO = re.compile(r"[A-Za-z0-9._%+~-]+(?::[^\s/@:]*)?@[A-Za-z0-9.-]+(?::[0-9]+)?")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("://", "scheme"), ("mailto:", "mailto")):
        found.add_word(word, (kind, len(word)))
    for cues, kind in ((_ACCOUNT_CUES, "account"), (_SECRET_CUES, "secret")):
        for cue in cues:
            for form in (cue, cue.capitalize(), cue.upper()):
                found.add_word(form, (kind, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in text.split("."))


def _iban(text: str) -> bool:
    own = text.replace(" ", "")
    return 15 <= len(own) <= 34 and int("".join(str(int(c, 36)) for c in own[4:] + own[:4])) % 97 == 1


def _emails(text: str, anchors: list[int]) -> Iterator[tuple[int, int]]:
    end = 0
    for at in anchors:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and at >= end and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end


def _ips(text: str, digits: list[int]) -> Iterator[tuple[int, int]]:
    end = 0
    for at in digits:
        if at < end:
            continue
        if m := _IP.match(text, at):
            end = m.end()
            if _octets(m.group()):
                yield at, end
        else:
            end = _RUN.match(text, at).end()


def _cards(text: str, digits: list[int]) -> Iterator[tuple[int, int]]:
    end = 0
    for at in digits:
        if at >= end and (m := _CARD.match(text, at)):
            end = m.end()
            own = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(own) <= 19 and luhn(own):
                yield at, end


def _phones(text: str, anchors: list[int]) -> Iterator[tuple[int, int]]:
    end = 0
    for at in anchors:
        if at >= end and (m := _PHONE.match(text, at)):
            end = m.end()
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                yield at, end


def _after_cue(text: str, cues: list[tuple[int, int]], parsers: tuple) -> Iterator[tuple[int, int]]:
    end = 0
    for start, stop in cues:
        if start < end or start and text[start - 1] in _WORD:
            continue
        for pattern, valid in parsers:
            if (m := pattern.match(text, stop)) and valid(m.group(1)):
                end = m.end(1)
                yield m.start(1), end
                break


def _uris(text: str, anchors: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    end = 0
    for start, stop, kind in anchors:
        if kind == "scheme":
            while start > end and text[start - 1] in _WORD:
                start -= 1
            if start == stop - 3:
                continue
        if start >= end and (m := _USERINFO.match(text, stop)):
            end = m.end()
            yield start, end


def find_spans(text: str, cues: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind in the order of ``KINDS``, then by start."""
    by: dict[str, list] = {"digit": [], "at": [], "plus": [], "account": [], "secret": [], "uri": []}
    for last, (kind, n) in cues.iter(text):
        if n == 1:
            by[kind].append(last)
        elif kind in ("scheme", "mailto"):
            by["uri"].append((last + 1 - n, last + 1, kind))
        else:
            by[kind].append((last + 1 - n, last + 1))
    found = {
        "email": _emails(text, by["at"]), "ip": _ips(text, by["digit"]), "card": _cards(text, by["digit"]), "phone": _phones(text, by["plus"]),
        "account": _after_cue(text, by["account"], ((_IBAN, _iban), (_ACCOUNT, bool))),
        "secret": _after_cue(text, by["secret"], ((_SECRET, lambda v: any(c.isdigit() for c in v)),)),
        "uri": _uris(text, by["uri"]),
    }
    return [(kind, a, b) for kind in KINDS for a, b in found[kind]]


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the array of ``spans`` (kind, start, end) of every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in chunks(batches):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t or "", cues)] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0).combine_chunks(), pa.array(spans, kind)], ["doc_id", "spans"])

    own = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return own.mapInArrow(task, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with personal data in the text replaced; null texts stay null.

    ``chars_col``, where the table has it, is set to the new length.
    """

    @F.pandas_udf("string")
    def clean(texts):
        cues = automaton()
        return texts.map(lambda t: None if t is None else redact_text(t, find_spans(t, cues)))

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    if chars_col and chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.length(text_col).cast(kind))
    return out.select(docs.columns)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as a string."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE_KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the spans of personal data in every document."""
    return digests(find(spark.read.parquet(f"{sf_dir}/documents.parquet")))
