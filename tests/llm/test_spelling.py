"""Single edits by dense tiling against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import Row

from weftline.llm.spelling import frequent, nearest, typed_words, variants


def edit(a, b):
    """Whether exactly one inserted, deleted or replaced code point parts two words."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        near = sorted((-m, v) for v, m in counts.items() if edit(v, w))
        form = near[0][1] if near and -near[0][0] >= 5 * n else None
        out[w] = [form, None, n, len(near), counts[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {w: tuple(row) for w, row in out.items()}


def count(rows):
    words = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def answer(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


@pytest.mark.parametrize(("alphabet", "block", "task", "tile"), [("ab", 40, 64, 8), ("abé", 16, 4096, 128), ("aÿ", 2048, 16384, 3)])
def test_same_as_brute_force(spark, alphabet, block, task, tile):
    rng = random.Random(alphabet)
    counts = {}
    for _ in range(500):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 11)))
        counts[word] = rng.choice([5, 6, 7, 25, 30, 35, 150, 180, 900, 5000])
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert answer(variants(words, block=block, task=task, tile=tile)) == brute(counts)


def test_words_and_slips(spark):
    rng = random.Random(5)
    stems = ["Straße", "naïveté", "colour", "color×s", "parlement", "Parlament", "ÉTUDES", "études", "zebras"]
    rows = [(i, " ".join(rng.choice(stems) for _ in range(40)) + rng.choice([" ", "1", "_"])) for i in range(300)]
    rows += [(None, "colour colour étudesx"), (7, None), (8, ""), (8, "12 34"), rows[0], rows[0], (9, "x" * 300_000), (10, "𝒳colour𝒴")]
    docs = spark.createDataFrame([Row(doc_id=k, text=t, word="no", n=1) for k, t in rows], "doc_id long, text string, word string, n int")
    counted = frequent(typed_words(docs))
    expected = count(rows)
    assert {r["word"]: r["n"] for r in counted.collect()} == expected
    found = answer(variants(counted))
    assert found == brute(expected)
    assert any(row[0] for row in found.values())


def test_very_long_words(spark):
    long = "ab" * 10_000
    counts = {long: 5, long[:-1]: 50, long + "c": 5, long[:9] + "x" + long[10:]: 9, long[::-1]: 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    near = {r["word"]: (r["n_near"], r["near"]) for r in nearest(words).collect()}
    assert near[long] == (3, long[:-1]) and near[long + "c"] == (1, long) and near[long[:-1]][0] >= 1
    assert {w for w in counts if any(edit(w, v) for v in (long,))} <= set(near)


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert variants(frequent(typed_words(docs))).collect() == []
