"""Collocations: phrases whose words stand together more often than apart, by counting quotient filters.

N-grams of word ids are packed into one number, which is permuted by an invertible mixing
and cut into a quotient and the full remainder. A filter keeps sorted remainders, the quotients as
one bit vector, and byte counters, so it loses nothing and takes about half the room of its
keys. Tasks fill filters per language, cut them into ranges of quotients and send each
range to its own group, where the sorted filters of all tasks merge. As numbers are
mixed, ranges are alike in size whatever the words are, and a phrase costs one entry of a
filter however often it occurs.

Words below ``least`` occurrences are in no candidate and have no id. The ``NARROW`` most
frequent others, broadcast, have dense ids, so a phrase of them is at most 54 bits. Phrases with
a word beyond those are kept in filters of 64 bits a word: hashes of the words, which are
checked to be different for all words of the corpus and salted anew until they are. Three words
are only counted where both pairs in them may be frequent, by a bitmap of fixed size; it lets
some others pass, and those fall to the exact counts.

Null texts are empty, a null language is ``und``; a language without candidates has no
rows. Repeated rows count like any others, words of any length are whole, equal scores go by
count and then by the phrase in byte order. Only the text and the language are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.blocks import Rolling, mix, raw_bytes, runs, slices
from weftline.llm.spelling import LOWER, UPPER
from weftline.llm.store import written

#: Words with dense ids: at most so many, of at most so many bytes; they are broadcast.
NARROW = 1 << 18
NARROW_BYTES = 128
#: Bits of a bitmap of frequent words or pairs, which is broadcast: 8 MB.
GATE_BITS = 26
#: Entries a task holds before it sends its filters, and entries of one merging group, about.
HELD = 1 << 19
GROUP = 1 << 19
SLICE = 2 << 20
#: Phrases of a language are ranked in so many parts before the best of all parts are.
DEALS = 64
_CHUNK_BITS = 13

_SPACE, _BREAK, _FOLD = np.zeros(256, bool), np.zeros(256, bool), np.arange(256, dtype=np.uint8)
_SPACE[[0x20, 0x09]] = True
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD[65:91] += 32
_ONE, _TWO = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

Limbs = list[np.ndarray]


def _ones(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def permute(x: np.ndarray, width: int) -> np.ndarray:
    """An invertible mixing of numbers of ``width`` bits, at least 2."""
    ones, half = _ones(width), np.uint64((width + 1) // 2)
    for factor in (_ONE, _TWO):
        x = (x * np.uint64(factor)) & ones
        x = x ^ (x >> half)
    return x


def unpermute(x: np.ndarray, width: int) -> np.ndarray:
    ones, half = _ones(width), np.uint64((width + 1) // 2)
    for factor in (_TWO, _ONE):
        x = x ^ (x >> half)
        x = (x * np.uint64(pow(factor, -1, 1 << 64))) & ones
    return x


def _other(limbs: Limbs) -> np.ndarray:
    out = np.zeros(len(limbs[0]), np.uint64)
    for at, limb in enumerate(limbs[1:], 1):
        out ^= mix(limb + np.uint64(at))
    return out


def to_fingerprint(limbs: Limbs, width: int) -> Limbs:
    """Numbers mixed into the first limb, invertibly; the others stay."""
    first = limbs[0] ^ (_other(limbs) & _ones(width)) if len(limbs) > 1 else limbs[0]
    return [permute(first, width), *limbs[1:]]


def from_fingerprint(limbs: Limbs, width: int) -> Limbs:
    first = unpermute(limbs[0], width)
    return [first ^ (_other(limbs) & _ones(width)) if len(limbs) > 1 else first, *limbs[1:]]


def _shift(x: np.ndarray, by: int) -> np.ndarray:
    return x >> np.uint64(by) if by < 64 else np.zeros_like(x)


def summed(limbs: Limbs, counts: np.ndarray) -> tuple[Limbs, np.ndarray]:
    """Sorted different keys with their counts added up."""
    # a stable sort merges runs that are sorted already
    order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
    limbs, counts = [x[order] for x in limbs], counts[order]
    if not len(counts):
        return limbs, counts
    first = np.ones(len(counts), bool)
    first[1:] = np.any([x[1:] != x[:-1] for x in limbs], axis=0)
    at = np.flatnonzero(first)
    return [x[at] for x in limbs], np.add.reduceat(counts, at)


def pack_filter(limbs: Limbs, counts: np.ndarray, width: int) -> bytes:
    """A counting quotient filter of sorted different fingerprints, the first limb of ``width`` bits."""
    size = len(counts)
    quotient = min(width, max(0, size.bit_length() - 1))
    rest = width - quotient
    bits = np.zeros(size + (1 << quotient), np.uint8)
    bits[_shift(limbs[0], rest).astype(np.int64) + np.arange(size)] = 1
    low = (limbs[0] & _ones(rest)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (rest + 7) // 8]
    small, large = np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255].astype("<i8")
    parts = [np.packbits(bits), low, *[x.astype("<u8") for x in limbs[1:]], small, large]
    return struct.pack("<QBB", size, width, len(limbs)) + b"".join(p.tobytes() for p in parts)


def unpack_filter(data: bytes) -> tuple[Limbs, np.ndarray]:
    size, width, number = struct.unpack_from("<QBB", data)
    at = struct.calcsize("<QBB")
    quotient = min(width, max(0, size.bit_length() - 1))
    rest = width - quotient

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    bits = np.unpackbits(take("u1", (size + (1 << quotient) + 7) // 8), count=size + (1 << quotient))
    upper = (np.flatnonzero(bits) - np.arange(size)).astype(np.uint64)
    low = np.zeros((size, 8), np.uint8)
    low[:, : (rest + 7) // 8] = take("u1", size * ((rest + 7) // 8)).reshape(size, -1)
    first = low.view("<u8").reshape(-1).astype(np.uint64)
    if rest < 64:
        first = first | (upper << np.uint64(rest))
    limbs = [first, *[take("<u8", size).astype(np.uint64) for _ in range(number - 1)]]
    counts = take("u1", size).astype(np.int64)
    counts[counts == 255] = take("<i8", int((counts == 255).sum()))
    return limbs, counts


@dataclass
class Coding:
    """What a task needs to number words: the narrow words in order of their ids, the salt of
    the wide codes and the bitmap of those that are frequent (nothing if all are narrow)."""

    narrow: pa.Array
    salt: int
    wide: np.ndarray | None
    gate_bits: int

    @property
    def bits(self) -> int:
        return max(1, (len(self.narrow) - 1).bit_length())


def word_code(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    return mix(Rolling(data)(starts, ends) ^ np.uint64(salt * _ONE & (1 << 64) - 1))


def _seeds(languages: list[str]) -> np.ndarray:
    return mix(np.array([zlib.crc32(language.encode()) for language in languages], np.uint64))


def _slot(limbs: Limbs, seeds: np.ndarray, bits: int) -> np.ndarray:
    """Place of a fingerprint in a bitmap; ``seeds`` tells languages apart."""
    mixed = mix(limbs[0] ^ _other(limbs) ^ seeds ^ np.uint64(len(limbs)))
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _hits(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


class _Tokens:
    """Words of some texts: their texts, ids (-1 if not narrow), and which follow the one before in one piece."""

    def __init__(self, texts: pa.Array, coding: Coding) -> None:
        data, offsets = raw_bytes(texts)
        data = _FOLD[data]
        breaks = _BREAK[data]
        solid = ~(breaks | _SPACE[data])
        starts, ends, first = runs(solid, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        places = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=places[1:])
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[solid])])
        self.ids = pc.fill_null(pc.index_in(words, value_set=coding.narrow), -1).to_numpy().astype(np.int64)
        before = np.cumsum(breaks, dtype=np.int32)
        self.follows = np.zeros(len(starts), bool)
        if len(starts):
            self.follows[1:] = before[starts[1:]] == before[starts[:-1]]
            self.follows[first[:-1][first[:-1] < len(starts)]] = False
        self.usable = self.ids >= 0
        self.codes = None
        if coding.wide is not None:
            self.codes = word_code(data, starts, ends, coding.salt)
            self.usable = self.usable | _hits(coding.wide, (self.codes >> np.uint64(64 - coding.gate_bits)).astype(np.int64))

    def grams(self, n: int, bits: int, allowed: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, Limbs, int]]:
        """For narrow and wide n-grams: the places of their first words, fingerprints, and the width of the first limb."""
        number = len(self.ids) - n + 1
        if number <= 0:
            return
        good = np.ones(number, bool) if allowed is None else allowed[:number].copy()
        dense = np.ones(number, bool)
        for k in range(n):
            good &= self.usable[k : k + number]
            dense &= self.ids[k : k + number] >= 0
            if k:
                good &= self.follows[k : k + number]
        at = np.flatnonzero(good & dense)
        key = np.zeros(len(at), np.uint64)
        for k in range(n):
            key = (key << np.uint64(bits)) | self.ids[at + k].astype(np.uint64)
        yield at, to_fingerprint([key], n * bits), n * bits
        if self.codes is not None:
            at = np.flatnonzero(good & ~dense)
            yield at, to_fingerprint([self.codes[at + k] for k in range(n)], 64), 64


_FILTER = "lang string, wide boolean, part long, filter binary"


def filters(
    docs: DataFrame, n: int, coding: Broadcast, gate: Broadcast | None, part_bits: int, held: int = HELD
) -> DataFrame:
    """Sorted filters of the n-grams of (lang, text), cut into ranges of quotients."""

    def rows(language: str, wide: bool, limbs: Limbs, counts: np.ndarray, width: int) -> Iterator[dict]:
        bits = min(part_bits, width)
        bounds = np.searchsorted(_shift(limbs[0], width - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        bounds[-1] = len(counts)
        for part in np.flatnonzero(np.diff(bounds)).tolist():
            a, b = bounds[part], bounds[part + 1]
            first = limbs[0][a:b] & _ones(width - bits)
            packed = pack_filter([first, *[x[a:b] for x in limbs[1:]]], counts[a:b], width - bits)
            yield {"lang": language, "wide": wide, "part": part, "filter": packed}

    shape = pa.schema([("lang", pa.string()), ("wide", pa.bool_()), ("part", pa.int64()), ("filter", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coding.value
        allowed = gate.value if gate is not None else None
        open_filters: dict[tuple[str, bool, int], list] = {}
        size = 0

        def send() -> Iterator[pa.RecordBatch]:
            for (language, wide, width), parts in open_filters.items():
                limbs = [np.concatenate(x) for x in zip(*[p[0] for p in parts], strict=True)]
                limbs, counts = summed(limbs, np.concatenate([p[1] for p in parts]))
                yield pa.RecordBatch.from_pylist(list(rows(language, wide, limbs, counts, width)), shape)
            open_filters.clear()

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                languages = part.column("lang").dictionary_encode()
                names = languages.dictionary.to_pylist()
                words = _Tokens(part.column("text"), known)
                spoken = languages.indices.to_numpy()[words.text]
                passes = None
                if allowed is not None:
                    frequent = np.zeros(len(words.ids), bool)
                    seeds = _seeds(names)[spoken]
                    for at, limbs, _ in words.grams(2, known.bits):
                        frequent[at] = _hits(allowed, _slot(limbs, seeds[at], known.gate_bits))
                    passes = frequent.copy()
                    passes[:-1] &= frequent[1:]
                for at, limbs, width in words.grams(n, known.bits, passes):
                    mine = spoken[at]
                    for number in np.unique(mine).tolist():
                        which = mine == number
                        found = summed([x[which] for x in limbs], np.ones(int(which.sum()), np.int64))
                        open_filters.setdefault((names[number], len(limbs) > 1, width), []).append(found)
                        size += len(found[1])
                if size >= held:
                    yield from send()
                    size = 0
        yield from send()

    return docs.mapInArrow(run, _FILTER)


def merged(found: DataFrame, n: int, coding: Broadcast, part_bits: int, least: int) -> DataFrame:
    """N-grams with ``least`` or more occurrences, from the filters of all tasks.

    (lang, words, codes, f, slot): words of narrow n-grams, codes of wide ones, and the place in a bitmap.
    """
    shape = pa.schema(
        [("lang", pa.string()), ("words", pa.list_(pa.string())), ("codes", pa.list_(pa.int64())), ("f", pa.int64()), ("slot", pa.int64())]
    )

    def run(key: tuple, table: pa.Table) -> pa.Table:
        language, wide, part = (k.as_py() for k in key)
        known = coding.value
        width = 64 if wide else n * known.bits
        bits = min(part_bits, width)
        parts = [unpack_filter(f) for f in table.column("filter").to_pylist()]
        limbs = [np.concatenate(x) for x in zip(*[p[0] for p in parts], strict=True)]
        limbs, counts = summed(limbs, np.concatenate([p[1] for p in parts]))
        kept = counts >= least
        limbs, counts = [x[kept] for x in limbs], counts[kept]
        if bits:
            limbs[0] = limbs[0] | np.uint64(part << (width - bits))
        slots = _slot(limbs, _seeds([language]), known.gate_bits)
        plain = from_fingerprint(limbs, width)
        size = len(counts)
        places = np.arange(size + 1, dtype=np.int32) * n
        if wide:
            codes = pa.ListArray.from_arrays(places, pa.array(np.stack(plain, 1).reshape(-1).view(np.int64)))
            words = pa.nulls(size, pa.list_(pa.string()))
        else:
            ids = [(plain[0] >> np.uint64(known.bits * (n - 1 - k))) & _ones(known.bits) for k in range(n)]
            flat = known.narrow.take(pa.array(np.stack(ids, 1).reshape(-1).astype(np.int64))).cast(pa.string())
            words, codes = pa.ListArray.from_arrays(places, flat), pa.nulls(size, pa.list_(pa.int64()))
        return pa.Table.from_arrays([pa.array([language] * size, pa.string()), words, codes, pa.array(counts), pa.array(slots)], schema=shape)

    return found.groupBy("lang", "wide", "part").applyInArrow(
        run, "lang string, words array<string>, codes array<long>, f long, slot long"
    )


def bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """A bitmap with the places in column ``slot`` set; put together in chunks, of one fixed total size."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << _CHUNK_BITS, np.uint8)
        flags[table.column("slot").to_numpy() & ((1 << _CHUNK_BITS) - 1)] = 1
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pa.Table.from_pydict({"chunk": [key[0].as_py()], "flags": [packed]}, pa.schema([("chunk", pa.int64()), ("flags", pa.binary())]))

    chunks = slots.select(F.shiftright("slot", _CHUNK_BITS).alias("chunk"), "slot").distinct()
    out = np.zeros(max(1, (1 << bits) >> 3), np.uint8)
    step = (1 << _CHUNK_BITS) >> 3
    for row in chunks.groupBy("chunk").applyInArrow(run, "chunk long, flags binary").collect():
        part = np.frombuffer(row["flags"], np.uint8)
        out[row["chunk"] * step : (row["chunk"] + 1) * step] = part[: len(out)]
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of (lang, text)."""
    words = F.regexp_extract_all("text", F.lit("([^ \\t.,;:!?\\n\\x0B\\f\\r]+)"), F.lit(1))
    return docs.select("lang", F.explode(words).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("f"))


def _coded(words: DataFrame, salt: int, bits: int) -> DataFrame:
    """(word, code, slot) of (word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "word"):
                data, offsets = raw_bytes(part.column("word"))
                codes = word_code(data, offsets[:-1], offsets[1:], salt)
                slots = (codes >> np.uint64(64 - bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("word"), pa.array(codes.view(np.int64)), pa.array(slots)], names=["word", "code", "slot"]
                )

    return words.select("word").mapInArrow(run, "word string, code long, slot long")


def _number(counts: DataFrame, least: int, narrow: int, gate_bits: int) -> tuple[Coding, DataFrame | None]:
    """The coding of words, and (code, word) of those that occur in wide n-grams, if there are any."""
    total = counts.groupBy("word").agg(F.sum("f").alias("total"), F.max("f").alias("most"))
    frequent = total.where(F.col("most") >= least)
    short = frequent.where(F.octet_length("word") <= NARROW_BYTES)
    top = short.orderBy(F.desc("total"), "word").limit(narrow).select("word").toArrow()
    words = pa.concat_arrays(top.column("word").chunks).cast(pa.binary()) if top.num_rows else pa.array([], pa.binary())
    if frequent.count() <= len(words):
        return Coding(words, 0, None, gate_bits), None
    salt = 1
    while True:
        coded = written(_coded(total, salt, gate_bits), "codes")
        if coded.groupBy("code").agg(F.count("*").alias("words")).where("words > 1").isEmpty():
            break
        salt += 1
    known = coded.join(frequent.select("word"), "word")
    return Coding(words, salt, bitmap(known.select("slot"), gate_bits), gate_bits), known.select("code", "word")


def _in_words(grams: DataFrame, n: int, known: DataFrame | None) -> DataFrame:
    """(lang, w1 ... wn, f, slot): codes turned into words."""
    names = [f"w{k + 1}" for k in range(n)]
    narrow = grams.where("codes is null").select("lang", *[F.col("words")[k].alias(w) for k, w in enumerate(names)], "f", "slot")
    if known is None:
        return narrow
    wide = grams.where("codes is not null")
    for k, name in enumerate(names):
        wide = wide.withColumn("code", F.col("codes")[k]).join(known.withColumnRenamed("word", name), "code")
    return narrow.unionByName(wide.select("lang", *names, "f", "slot"))


def _score(a: str, left: str, right: str) -> Column:
    """Whole numbers of 38 digits: exact for counts up to 10^16."""

    def exact(name: str) -> str:
        return f"cast({name} as decimal(38, 0))"

    return F.expr(f"({exact(a)} * {exact(a)} * 1000000) div ({exact(left)} * {exact(right)})")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, share: int = 50, top: int = 2000,
    narrow: int = NARROW, gate_bits: int = GATE_BITS, group: int = GROUP, held: int = HELD,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` best phrases of two or three words of every language.

    A phrase occurs ``least`` times or more, and none that contains it has ``share`` percent of its occurrences.
    """
    spark = docs.sparkSession
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), folded.alias("text"))
    counts = written(word_counts(source), "words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    all_words = counts.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    part_bits = max(0, (all_words // group).bit_length())
    coding, known = _number(counts, least, narrow, gate_bits)
    sent = spark.sparkContext.broadcast(coding)
    plain = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))

    def grams(n: int, gate: Broadcast | None) -> DataFrame:
        found = merged(filters(plain, n, sent, gate, part_bits, held), n, sent, part_bits, least)
        return written(_in_words(written(found, "merged"), n, known), "grams")

    pairs = grams(2, None)
    gate = spark.sparkContext.broadcast(bitmap(pairs.select("slot"), gate_bits))
    triples = grams(3, gate)

    single = counts.where(F.col("f") >= least)

    def with_count(df: DataFrame, source: DataFrame, keys: dict[str, str], name: str) -> DataFrame:
        renamed = source.select("lang", *[F.col(k).alias(w) for w, k in keys.items()], F.col("f").alias(name))
        return df.join(renamed, ["lang", *keys])

    three = triples.withColumnRenamed("f", "a").drop("slot")
    three = with_count(three, single, {"w1": "word"}, "l1")
    three = with_count(three, pairs, {"w2": "w1", "w3": "w2"}, "r1")
    three = with_count(three, pairs, {"w1": "w1", "w2": "w2"}, "l2")
    three = with_count(three, single, {"w3": "word"}, "r2")
    three = three.select("*", _score("a", "l1", "r1").alias("s1"), _score("a", "l2", "r2").alias("s2"))
    first = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        *[F.when(first, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(d) for c, d in (("l", "l"), ("r", "r"), ("s", "score"))],
    )

    inside = triples.select("lang", "w1", "w2", "f").union(triples.select("lang", "w2", "w3", "f"))
    longest = inside.groupBy("lang", "w1", "w2").agg(F.max("f").alias("longer"))
    two = pairs.withColumnRenamed("f", "a").drop("slot").join(longest, ["lang", "w1", "w2"], "left")
    two = two.where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer")
    two = with_count(with_count(two, single, {"w1": "word"}, "l"), single, {"w2": "word"}, "r")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))

    # a language may hold most phrases: parts of it are ranked first
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    dealt = two.unionByName(three).withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(DEALS)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
