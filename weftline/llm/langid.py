"""Language identification by bit-sliced Bloom filters of n-grams.

A slot of the filter holds one bit per language. An n-gram of bytes has ``HASHES`` slots; the
AND of them is the set of languages that contain it. For each text the hits of every
language are counted, what false positives add is taken off, and the best language wins.

Null texts, empty texts and texts without a letter are ``und`` with score 0, as is
everything when no language was learned. Ties go to the first language in order of names.
Repeated rows are answered one by one; columns but the key and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import fold, letter_flags, raw_bytes, slices, sums_between

#: Training uses about this many texts of a language at most, picked by a hash of the key.
SAMPLE = 4000
#: An n-gram belongs to a language if it stands in this share of its training texts.
SHARE = 0.01
#: No language keeps more n-grams than this, the most frequent first.
GRAMS = 30_000
#: More languages than this are an error: the filter is held whole by every task.
LANGUAGES = 1024
#: A text is in a language if that contains this share of the text's n-grams.
COVERAGE = 0.5
WIDTHS = (3, 4)
SLOT_BITS = 18
HASHES = 3

_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass
class LanguageFilter:
    """``masks``: slot by slot the languages, 64 to a plane. ``false``: each language's rate
    of false positives."""

    languages: list[str]
    masks: list[np.ndarray]
    false: np.ndarray


def _grams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each width the packed n-grams that touch a letter, and the text bounds in them.

    Whatever is no letter counts as a blank. N-grams do not cross texts.
    """
    letters = letter_flags(data)
    clean = np.where(letters, fold(data), np.uint8(32)).astype(np.uint64)
    out = []
    for width in WIDTHS:
        n = len(clean) - width + 1
        if n <= 0:
            out.append((np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)))
            continue
        packed = clean[:n].copy()
        for k in range(1, width):
            packed |= clean[k : k + n] << np.uint64(8 * k)
        keep = letters[1 : n + 1].copy()  # the second byte is a letter
        for end in offsets[1:-1]:
            keep[max(0, end - width + 1) : end] = False
        at = np.flatnonzero(keep)
        out.append((packed[at] | np.uint64(width << 56), np.searchsorted(at, offsets)))
    return out


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    return [((grams * odd) >> np.uint64(64 - SLOT_BITS)).astype(np.intp) for odd in _ODD[:HASHES]]


def _count_grams(batches):
    """(lang, gram, texts): in how many of a slice's texts of a language an n-gram stands."""
    for batch in batches:
        for part in slices(batch, "text"):
            langs = np.array(part.column("lang").to_pylist(), dtype=object)
            data, offsets = raw_bytes(part.column("text"))
            for packed, bounds in _grams(data, offsets):
                for lang in sorted(set(langs)):
                    own = [np.unique(packed[bounds[i] : bounds[i + 1]]) for i in np.flatnonzero(langs == lang)]
                    grams, counts = np.unique(np.concatenate(own), return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [lang] * len(grams), "gram": grams.view(np.int64), "texts": counts},
                        schema=_GRAM_SCHEMA,
                    )


_GRAM_SCHEMA = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("texts", pa.int64())])


def learn_languages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
    share: float = SHARE, most: int = GRAMS,
) -> LanguageFilter:
    """Learn the filter from rows with a text and a language.

    Which n-grams stand in how many texts is counted by Spark. What reaches the driver is
    at most ``most`` n-grams of a language.
    """
    known = docs.select(
        F.xxhash64(key).alias("place"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where("text is not null and lang is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("rows"))
    if len(sizes.limit(LANGUAGES + 1).collect()) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    rate = F.broadcast(sizes)
    place = (F.col("place").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30)))
    picked = known.join(rate, "lang").where(place * F.col("rows") < sample)
    counts = (
        picked.select("text", "lang").mapInArrow(_count_grams, "lang string, gram long, texts long")
        .groupBy("lang", "gram").agg(F.sum("texts").alias("texts"))
        .join(rate, "lang")
        .where(F.col("texts") >= F.least(F.col("rows"), F.lit(sample)) * share)
    )
    # at most n-grams of a text / share for a language: a list of that size is bounded
    best = F.reverse(F.array_sort(F.collect_list(F.struct("texts", "gram"))))
    ranked = counts.groupBy("lang").agg(F.slice(best, 1, most)["gram"].alias("grams"))
    found = {r["lang"]: np.array(r["grams"], dtype=np.int64).view(np.uint64) for r in ranked.collect()}
    return build_filter(found)


def build_filter(grams: dict[str, np.ndarray]) -> LanguageFilter:
    """Put every language's n-grams into the slots; measure each false-positive rate."""
    languages = sorted(grams)
    width = next(w for w in (8, 16, 32, 64) if len(languages) <= w or w == 64)
    planes = max(1, -(-len(languages) // width))
    masks = [np.zeros(1 << SLOT_BITS, dtype=f"u{width // 8}") for _ in range(planes)]
    false = np.zeros(len(languages))
    for i, name in enumerate(languages):
        plane, bit = divmod(i, width)
        for slot in _slots(grams[name]):
            masks[plane][slot] |= masks[plane].dtype.type(1 << bit)
        filled = (masks[plane] >> masks[plane].dtype.type(bit)) & masks[plane].dtype.type(1)
        false[i] = float(filled.mean()) ** HASHES
    return LanguageFilter(languages, masks, false)


def hits(model: LanguageFilter, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text and language the n-grams it contains, false positives taken off; and
    the number of n-grams of each text."""
    texts, width = len(offsets) - 1, model.masks[0].dtype.itemsize * 8
    found = np.zeros((texts, len(model.languages)))
    total = np.zeros(texts)
    for packed, bounds in _grams(data, offsets):
        size = np.diff(bounds)
        total += size
        slots = _slots(packed)
        for plane, mask in enumerate(model.masks):
            both = mask[slots[0]]
            for slot in slots[1:]:
                both &= mask[slot]
            for i in range(plane * width, min(len(model.languages), (plane + 1) * width)):
                bit = (both >> both.dtype.type(i - plane * width)) & both.dtype.type(1)
                seen = sums_between(bit, bounds)
                found[:, i] += np.maximum(0, (seen - size * model.false[i]) / max(1e-9, 1 - model.false[i]))
    return found, total


def judge(model: LanguageFilter, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and coverage of each text."""
    data, offsets = raw_bytes(texts)
    n = len(offsets) - 1
    names, score, covers = ["und"] * n, np.zeros(n), np.zeros(n)
    if not model.languages:
        return names, score, covers
    found, total = hits(model, data, offsets)
    best = found.argmax(1)
    top = found[np.arange(n), best]
    rest = np.partition(found, -2, axis=1)[:, -2] if found.shape[1] > 1 else np.zeros(n)
    letters = letter_flags(data)
    plain = sums_between(letters & (data < 128), offsets) > 0
    # beyond ASCII the flags know letters by range, and only Unicode says what is one
    for i in np.flatnonzero(plain | (sums_between(data >= 128, offsets) > 0)):
        if plain[i] or any(map(str.isalpha, texts[int(i)].as_py())):
            names[i] = model.languages[best[i]]
            score[i] = top[i] / (top[i] + rest[i]) if top[i] else 0.0
            covers[i] = min(1.0, top[i] / total[i]) if total[i] else 0.0
    return names, score, covers


def identify(docs: DataFrame, model: LanguageFilter, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: the key, ``lang_pred``, ``score`` and ``coverage``.

    ``score`` is the winner's share of the hits of the two best languages, 0 to 1;
    ``coverage`` the share of the text's n-grams that the winner contains.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                names, score, covers = judge(model, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(names, pa.string()), pa.array(score), pa.array(covers)],
                    names=["key", "lang_pred", "score", "coverage"],
                )

    out = source.mapInArrow(run, f"key {kind}, lang_pred string, score double, coverage double")
    return out.withColumnRenamed("key", key)


def accepted(docs: DataFrame, model: LanguageFilter, text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """The rows whose text is in a learned language, all columns as they are."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                names, _, covers = judge(model, part.column(text))
                keep = [n != "und" and c >= coverage for n, c in zip(names, covers, strict=True)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
