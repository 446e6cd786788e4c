"""Anchor expansion against the plain patterns, edge cases, redaction."""

import hashlib
import random
import re

from dailylake.llm import pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


VALID = {
    "email": lambda t: True,
    "ip": lambda t: all(int(p) <= 255 for p in t.split(".")),
    "card": lambda t: 16 <= len(x := re.sub("[ -]", "", t)) <= 19 and _luhn(x),
    "phone": lambda t: 8 <= len(re.sub("[^0-9]", "", t)) <= 15,
}


def plain(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in PLAIN[k].finditer(text) if VALID[k](m.group())]


def test_base_spans_equal_the_patterns():
    cues, rng = pii.automaton(), random.Random(5)
    alphabets = ["a.@-", "0123456789. ", "4 -0", "+1 ().-5", "ab9@.+-: é٣", "12@a.b+ -"]
    n = 0
    for _ in range(30_000):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 60)))
        own = [s for s in pii.find_spans(text, cues) if s[0] in pii.BASE_KINDS]
        assert own == plain(text), text
        n += len(own)
    assert n > 2_000


def test_cards_and_octets():
    cues = pii.automaton()
    kinds = lambda t: [(k, t[a:b]) for k, a, b in pii.find_spans(t, cues)]
    assert kinds("x 4111 1111 1111 1111 y") == [("card", "4111 1111 1111 1111")]
    assert kinds("4111111111111112") == []
    assert kinds("1.2.3.4.5.6.7.8") == [("ip", "1.2.3.4"), ("ip", "5.6.7.8")]
    assert kinds("300.1.1.1 0255.0.0.1") == [("ip", "0255.0.0.1")]
    assert kinds("9" * 6000) == []


def test_added_kinds():
    cues = pii.automaton()
    kinds = lambda t: [(k, t[a:b]) for k, a, b in pii.find_spans(t, cues)]
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 32.") == [("account", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 33.") == []
    assert kinds('a token = "24be64439e3e49cf" b') == [("secret", "24be64439e3e49cf")]
    assert kinds("ftp://bob:pw@host.example/x") == [("email", "pw@host.example"), ("uri", "ftp://bob:pw@host.example")]
    assert kinds("no https://host.example/x here, tokens = many") == []


def test_query_digests(spark):
    rows = [(1, "Mail a.b@c.de or +1 (389) 555-5010 to 10.0.0.1"), (2, None), (3, ""), (3, ""), (4, "ü a@b.c"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", pii.F.lit(1))
    got = {r.doc_id: r for r in pii.digests(pii.find(df)).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 0, 1)
    want = "email:5:13,ip:38:46,phone:17:34"
    assert got[1].spans == want and got[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert got[4].spans == "email:2:7"
    assert got[2].base_sha256 == got[3].base_sha256 == got[None].base_sha256 == none and got[2].spans == ""
    assert pii.digests(pii.find(df)).count() == 6
    assert pii.digests(pii.find(df.limit(0))).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([(1, "to a@b.c now", 12, "k"), (2, None, None, None)], "doc_id long, text string, n_chars long, spans string")
    rows = pii.redact(df).orderBy("doc_id").collect()
    assert [r.asDict() for r in rows] == [{"doc_id": 1, "text": "to [EMAIL] now", "n_chars": 14, "spans": "k"}, {"doc_id": 2, "text": None, "n_chars": None, "spans": None}]
