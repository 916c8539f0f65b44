"""Counting quotient filters against plain counts, and collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from weftline.llm.collocations import (
    collocations,
    from_fingerprint,
    pack_filter,
    permute,
    summed,
    to_fingerprint,
    unpack_filter,
    unpermute,
)


@pytest.mark.parametrize("width", [2, 3, 17, 36, 54, 63, 64])
def test_permutation_is_invertible(width):
    rng = np.random.default_rng(width)
    x = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2) >> np.uint64(64 - width)
    y = permute(x, width)
    assert (unpermute(y, width) == x).all() and (y >> np.uint64(width - 1) <= 1).all()
    limbs = [x, x * np.uint64(7), x + np.uint64(1)]
    back = from_fingerprint(to_fingerprint(limbs, width), width)
    assert all((a == b).all() for a, b in zip(limbs, back, strict=True))
    if width < 18:
        assert len(np.unique(permute(np.arange(1 << width, dtype=np.uint64), width))) == 1 << width


@pytest.mark.parametrize(("width", "limbs"), [(2, 1), (9, 1), (40, 1), (64, 1), (64, 2), (64, 3), (0, 1), (3, 2)])
def test_filters_lose_nothing_and_merge(width, limbs):
    rng = random.Random(width + limbs)
    counts, parts = Counter(), []
    for size in (1, 2, 500, 3000):
        shard = Counter()
        for _ in range(size):
            key = (rng.randrange(1 << width) if width < 20 else rng.getrandbits(width) >> rng.choice([0, width - 8]),)
            shard[key + tuple(rng.randrange(4) for _ in range(limbs - 1))] += rng.choice([1, 1, 2, 254, 255, 256, 10**12])
        counts += shard
        keys = sorted(shard)
        columns = [np.array([k[i] for k in keys], np.uint64) for i in range(limbs)]
        packed = pack_filter(columns, np.array([shard[k] for k in keys]), width)
        found, n = unpack_filter(packed)
        assert [tuple(map(int, k)) for k in zip(*found, strict=True)] == keys and n.tolist() == [shard[k] for k in keys]
        parts.append((found, n))
    keys = [np.concatenate([p[0][i] for p in parts]) for i in range(limbs)]
    found, n = summed(keys, np.concatenate([p[1] for p in parts]))
    assert dict(zip(zip(*[x.tolist() for x in found], strict=True), n.tolist(), strict=True)) == dict(counts)


def test_filters_are_compact():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 54, 100_000, dtype=np.uint64))
    packed = pack_filter([keys], np.ones(len(keys), np.int64), 54)
    assert len(packed) < 7 * len(keys)


def brute(rows, least, share, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) == 3 and p in (q[:2], q[1:]) and 100 * m >= share * a for q, m in counts.items() if m >= least):
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


ROWS = [("en", None), (None, ""), ("en", "a"), ("x", " \t.,"), ("de", "ÄB äb äB"), ("en", "one two\nthree four")]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "of", "new", "york", "New", "é", "ß", "𝒳", "a b", "x" * 200, "the\x1fend", "#"] + [f"w{i}" for i in range(60)]
    rows = list(ROWS)
    for i in range(200):
        words = [rng.choice(vocabulary[: rng.choice([5, 13, 73])]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\r\n", " ,"]) for w in words)
        rows.append((rng.choice(["en", "en", "en", None, "und", "de"]), text))
    return rows + [rows[-1]] * 30


@pytest.mark.parametrize(
    "options",
    [{}, {"narrow": 6}, {"narrow": 1, "gate_bits": 13, "held": 50}, {"group": 100, "held": 200}, {"narrow": 20, "group": 64, "gate_bits": 16, "top": 7}],
)
def test_same_as_brute_force(spark, options):
    rows = corpus(len(options))
    docs = spark.createDataFrame([Row(lang=k, text=t, word="no", f=1) for k, t in rows], "lang string, text string, word string, f int")
    got = sorted(tuple(r) for r in collocations(docs.repartition(5), **options).collect())
    expected = brute(rows, 10, 50, options.get("top", 2000))
    assert got == expected and any(" " in r[2].replace(" ", "", 1) for r in expected)


def test_exact_beyond_64_bits(spark):
    text = "left right " * 300_000
    rows = [("en", text)] * 4
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = {r["phrase"]: r for r in collocations(docs).collect()}
    a = 4 * 300_000
    assert got["left right left"]["a"] == a - 4 and "left right" not in got
    cuts = [10**6 * (a - 4) ** 2 // (a * (a - 4)), 10**6 * (a - 4) ** 2 // (a * a)]
    assert got["left right left"]["score"] == min(cuts)


def test_empty(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations(docs).collect() == []
