"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone removes only spaces)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def has_text(text: Column) -> Column:
    """True for a string with something in it; null counts as nothing."""
    return F.coalesce(~is_blank(text), F.lit(False))


def universal_newlines(text: Column) -> Column:
    """``\\r\\n`` and a lone ``\\r`` become ``\\n``, as when a text file is opened."""
    return F.regexp_replace(text, "\r\n?", "\n")


def decode_utf8_ignore(data: Column) -> Column:
    """UTF-8 bytes to text, malformed bytes dropped.

    ``make_valid_utf8`` marks each malformed part with U+FFFD. A genuine U+FFFD
    is the byte run EF BF BD, which no malformed part can contain, so the bytes
    are cut there, each piece is repaired, and the marks are put back.
    """
    raw = F.decode(data, "ISO-8859-1")
    repaired = F.transform(
        F.split(raw, "\u00ef\u00bf\u00bd"),
        lambda piece: F.replace(
            F.make_valid_utf8(F.encode(piece, "ISO-8859-1").cast("string")),
            F.lit("\ufffd"),
            F.lit(""),
        ),
    )
    as_is = data.cast("string")
    return F.when(F.is_valid_utf8(as_is), as_is).otherwise(
        F.array_join(repaired, "\ufffd")
    )


def text_hash(text: Column) -> Column:
    """MD5 of the UTF-8 text as 16 bytes, half the width of the hex form."""
    return F.unhex(F.md5(text))


def suffix(path: Column) -> Column:
    """Lower-case file extension with its dot, empty when there is none."""
    return F.lower(F.regexp_extract(path, r"(?<=[^/])(\.[^./]+)$", 1))


def name_number(path: Column, stem: str) -> Column:
    """The number N of a path whose last part is exactly ``<stem>-N``, else null."""
    digits = F.regexp_extract(path, rf"(?:^|/){stem}-(\d+)/?$", 1)
    return F.nullif(digits, F.lit("")).cast("bigint")
