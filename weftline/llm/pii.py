"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in the whole text: at-signs, plus signs before a
digit, digits that touch a dot or another digit, schemes, and cues such as ``iban`` or
``passport``. From an anchor a local parser reads to both sides, checks what it found
and gives a span. The parsers are deterministic and look at the neighbourhood only.

Kinds: ``email``, ``ip``, ``card`` (Luhn), ``phone`` are found wherever they stand and never
overlap within a kind. ``iban`` (checksum), ``account``, ``passport``, ``ssn``, ``address``
and ``url_login`` need a cue and are added to those.

Null and empty texts have no span. Repeated rows are answered one by one. Columns but the
key and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import slices

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "account", "passport", "ssn", "address", "url_login")
Span = tuple[str, int, int]

_DIGITS = "0123456789"
_LOWER = {c: c + 32 for c in range(65, 91)}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_SPACED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Cues, all in lower case, and what to read behind them.
CUES = {
    "iban": "iban", "account": "account", "acct": "account", "konto": "account", "kontonummer": "account",
    "cuenta": "account", "compte": "account", "passport": "passport", "passeport": "passport", "pasaporte": "passport",
    "ssn": "ssn", "social security": "ssn", "address": "address", "adresse": "address", "anschrift": "address",
    "dirección": "address", "direccion": "address",
}
_BEHIND = r"(?:\s*(?:no|nr|number|num|id)\b\.?)?\s*[:#=]?\s*"
_READ = {
    "iban": re.compile(_BEHIND + r"([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})(?![A-Za-z0-9])", re.ASCII | re.I),
    "account": re.compile(_BEHIND + r"([0-9](?:[ -]?[0-9]){5,16})(?![0-9])", re.ASCII | re.I),
    "passport": re.compile(_BEHIND + r"([A-Za-z]{1,2}[0-9]{6,8})(?![A-Za-z0-9])", re.ASCII | re.I),
    "ssn": re.compile(_BEHIND + r"((?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])", re.ASCII | re.I),
    "address": re.compile(r"\s*[:=]\s*([0-9]{1,6}[A-Za-z]? [^\n,;]{3,80}(?:, ?[^\n,;]{2,60}){1,3})", re.ASCII | re.I),
    "url_login": re.compile(r"([^\s/:@]{1,128}:[^\s/@]{1,128})@[A-Za-z0-9.-]", re.ASCII),
}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    """Anchors and how many characters after the first one they end."""
    held = ahocorasick.Automaton()
    held.add_word("@", ("@", 0))
    held.add_word("://", ("url_login", 0))
    for a in _DIGITS:
        held.add_word("+" + a, ("+", 1))
        held.add_word(a + ".", ("d", 1))
        for middle in ("", " ", "-"):
            for b in _DIGITS:
                held.add_word(a + middle + b, ("dd", len(middle) + 1))
    for cue in CUES:
        held.add_word(cue, (CUES[cue], 0))
    held.make_automaton()
    return held


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def iban_checks(value: str) -> bool:
    plain = value.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _is_digit(c: str) -> bool:
    return "0" <= c <= "9"


class _Reader:
    """Spans of one text, anchor by anchor from left to right."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans: list[Span] = []
        self.email_end = self.dotted_end = self.spaced_end = self.phone_end = 0

    def email(self, at: int) -> None:
        """``at`` is the place of an at-sign. The local part stops at the last address."""
        if at < self.email_end:
            return
        start = at
        while start > self.email_end and self.text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(self.text, at + 1) if start < at else None
        if found:
            self.spans.append(("email", start, found.end()))
            self.email_end = found.end()

    def dotted(self, at: int) -> None:
        """``at`` is a digit before a dot: every four numbers of the chain are one address."""
        if at < self.dotted_end:
            return
        start = at
        while start > self.dotted_end and _is_digit(self.text[start - 1]):
            start -= 1
        chain = _DOTTED.match(self.text, start)
        self.dotted_end = chain.end()
        numbers = chain.group().split(".")
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in four):
                self.spans.append(("ip", start, start + size))
            start += size + 1

    def spaced(self, at: int) -> None:
        """``at`` is the first of two neighbouring digits of a chain."""
        if at < self.spaced_end:
            return
        chain = _SPACED.match(self.text, at)
        self.spaced_end = chain.end()
        digits = chain.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            self.spans.append(("card", at, chain.end()))

    def phone(self, at: int) -> None:
        """``at`` is a plus sign before a digit."""
        if at < self.phone_end:
            return
        found = _DIALLED.match(self.text, at)
        if found:
            self.phone_end = found.end()
            if 9 <= sum(map(_is_digit, found.group())) <= 15:
                self.spans.append(("phone", at, found.end()))

    def cued(self, kind: str, end: int) -> None:
        """Read behind a cue that ends before ``end``."""
        found = _READ[kind].match(self.text, end)
        if found and (kind != "iban" or iban_checks(found.group(1))):
            self.spans.append((kind, found.start(1), found.end(1)))


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by start, then kind. Offsets are code points, ends exclusive."""
    reader = _Reader(text)
    # cues count in any case; a few letters beyond ASCII change their length in lower case
    folded = text.lower()
    if len(folded) != len(text):
        folded = text.translate(_LOWER)
    for end, (what, back) in _automaton().iter(folded):
        if what == "@":
            reader.email(end)
        elif what == "+":
            reader.phone(end - back)
        elif what == "d":
            if end + 1 < len(text) and _is_digit(text[end + 1]):
                reader.dotted(end - back)
        elif what == "dd":
            reader.spaced(end - back)
        else:
            reader.cued(what, end + 1)
    order = {k: i for i, k in enumerate(BASE + ADDED)}
    return sorted(set(reader.spans), key=lambda s: (s[1], order[s[0]], s[2]))


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlaps merge into the first."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: the key and ``found``, an array of (kind, start, end)."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = pc.fill_null(part.column("text"), "").to_pylist()
                found = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(found, shape)], names=["key", "found"])

    out = source.mapInArrow(run, f"key {kind}, found array<struct<kind: string, start: long, end: long>>")
    return out.withColumnRenamed("key", key)


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts by base kind, the hash of the base spans, and all spans, from ``detect``."""
    found = detect(docs, key, text)

    def of(kind: str) -> Column:
        return F.filter("found", lambda s: s["kind"] == kind)

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base, rest = F.concat(*map(of, BASE)), F.concat(*map(of, ADDED))
    count = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        key, *count, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.concat(base, rest)).alias("spans")
    )


def redacted(docs: DataFrame, text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """The same rows with personal data in ``text`` replaced; ``size``, if there, follows the text."""

    @F.pandas_udf("string")
    def clean(values):
        return values.map(lambda t: t if t is None else redact(t, find_spans(t)))

    out = docs.withColumn(text, clean(text))
    return out.withColumn(size, F.length(text).cast(docs.schema[size].dataType)) if size in docs.columns else out
