"""Anchor expansion against plain patterns over whole texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import Row

from weftline.llm.pii import BASE, detect, digest, find_spans, iban_checks, luhn, redact, redacted

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """Leftmost matches that do not overlap, per kind; those that fail are dropped."""
    out = []
    for kind in BASE:
        for m in re.finditer(PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out.append((kind, m.start(), m.end()))
    return out


def base(text):
    order = {k: i for i, k in enumerate(BASE)}
    return sorted((s for s in find_spans(text) if s[0] in order), key=lambda s: (order[s[0]], s[1]))


@pytest.mark.parametrize("alphabet", ["12.+ -()", "a@.b-", "1.2+@a -", "0. 9-+(", "é1@.a\n"])
def test_same_as_patterns_on_random_texts(alphabet):
    rng = random.Random(alphabet)
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert base(text) == plain(text), text


def test_fixed_cases():
    text = "é a@b.co@d.e 1.2.3.4.5.6.7.8, 4111 1111-1111 1111, +49 (30) 123456, 999.1.1.1 +1 2"
    assert base(text) == plain(text)
    assert [s[0] for s in base(text)] == ["email", "ip", "ip", "card", "phone"]


def test_cued_spans():
    assert iban_checks("DE89 3704 0044 0532 0130 00")
    kinds = {k for k, _, _ in find_spans(
        "IBAN: DE89370400440532013000, passport no. C01234567, SSN 123-45-6789, "
        "Address: 12 Long Street, Old Town https://me:pw@host.example account 12345678"
    )}
    assert kinds >= {"iban", "passport", "ssn", "address", "url_login", "account"}
    assert not [s for s in find_spans("IBAN: DE89370400440532013001 and ssn 000-12-1234") if s[0] in ("iban", "ssn")]


def test_table_edge_cases(spark):
    rows = [
        Row(doc_id=1, text=None, key="x", found=1), Row(doc_id=2, text="", key="x", found=1),
        Row(doc_id=None, text="a@b.co", key=None, found=1), Row(doc_id=3, text="x " * 200_000 + "a@b.co", key="x", found=1),
        Row(doc_id=3, text="x " * 200_000 + "a@b.co", key="x", found=1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, found int")
    got = digest(docs).collect()
    assert len(got) == 5
    empty = next(r for r in got if r["doc_id"] == 1)
    assert empty["n_email"] == 0 and empty["spans"] == "" and empty["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert [r["spans"] for r in got if r["doc_id"] == 3] == ["email:400000:400006"] * 2
    assert detect(docs.limit(0)).count() == 0


def test_redaction(spark):
    text = "mail a@b.co or +49 30 1234567"
    assert redact(text, find_spans(text)) == "mail [EMAIL] or [PHONE]"
    docs = spark.createDataFrame([(1, text, 29), (2, None, None)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in redacted(docs).orderBy("doc_id").collect()] == [(1, "mail [EMAIL] or [PHONE]", 23), (2, None, None)]


@pytest.mark.parametrize("cue", ["Social Security: ", "SOCIAL security no. ", "social security ", "SSN=", "sSn: "])
def test_cues_in_any_case(cue):
    for before in ("", "İİ ", "é "):
        text = f"{before}{cue}123-45-6789."
        start = len(before) + len(cue)
        assert find_spans(text) == [("ssn", start, start + 11)]


def test_more_cues():
    assert [s[0] for s in find_spans("Kontonummer: 12345678 Pasaporte AB123456 Anschrift: 5 Lange Gasse, 80331 Ort")] == ["account", "passport", "address"]
