"""Texts of an Arrow batch as numpy arrays: bytes, words and rolling hashes.

Tasks work on slices of about ``SLICE_BYTES`` of text, so their memory follows the slice
(or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20

_U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, name: str) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < n:
        steps = np.full(max(n, 2 * SLICE_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        held = np.cumprod(steps, dtype=np.uint64)
        # a single huge text does not leave its table behind
        if n <= 4 * SLICE_BYTES:
            _powers[name] = held
    return held[:n]


class Rolling:
    """Hashes of any byte ranges, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[data] * _power(_BASE, n, "base"), out=self.sums[1:])
        self.inverse = _power(pow(_BASE, -1, 1 << 64), n + 1, "inverse")

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + end.astype(_U64) - start.astype(_U64))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    total = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(total):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and where each begins. Null is empty."""
    held = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(held):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = held.buffers()
    at = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def lower_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Like ``raw_bytes``, in lower case."""
    return raw_bytes(pc.utf8_lower(pc.fill_null(texts, "")))


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for Latin letters, which keeps every byte where it was."""
    out = _FOLD[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.zeros(0, np.int64)
    second = data[after]
    out[after[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]] += 32
    return out


_WORD = np.zeros(256, dtype=bool)
for _first, _last in ((48, 57), (65, 90), (95, 95), (97, 122), (0x80, 0xFF)):
    _WORD[_first : _last + 1] = True
_LETTER = _WORD.copy()
_LETTER[48:58] = _LETTER[95] = False
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _without_marks(flags: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Take the punctuation of U+0080-00BF, U+2000-2FFF and U+3000-303F out of the words."""
    n = len(data)
    for lead, width in ((0xC2, 2), (0xE2, 3), (0xE3, 3)):
        at = np.flatnonzero(data == lead)
        if len(at) and lead == 0xE3:
            at = at[data[np.minimum(at + 1, n - 1)] == 0x80]
        for k in range(width if len(at) else 0):
            flags[np.minimum(at + k, n - 1)] = False
    return flags


def word_flags(data: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a word: letters, digits, underscore."""
    return _without_marks(_WORD[data], data)


def letter_flags(data: np.ndarray) -> np.ndarray:
    return _without_marks(_LETTER[data], data)


def solid_flags(data: np.ndarray) -> np.ndarray:
    """Whether each byte is anything but ASCII white space."""
    return ~_BLANK[data]


def runs(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags, and each text's first run; no run crosses texts."""
    first = flags.copy()
    first[1:] &= ~flags[:-1]
    last = flags.copy()
    last[:-1] &= ~flags[1:]
    inner = offsets[:-1][offsets[:-1] < len(flags)]
    first[inner] = flags[inner]
    inner = offsets[1:][offsets[1:] > 0] - 1
    last[inner] = flags[inner]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte position, 0 to the end, how many code points begin before it."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring bounds."""
    total = np.zeros(len(values) + 1, dtype=np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo the divisor. A null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % divisor


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that no other column is read or clashes."""
    return docs.select(*columns)
