"""Held-out accuracy of the learned operators, their exact parts by brute force, odd rows."""

import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm.blocks import raw_bytes
from weftline.llm.langid import (
    HASHES,
    SLOT_BITS,
    _grams,
    _slots,
    build_filter,
    hits,
    identify,
    judge,
    learn_languages,
)
from weftline.llm.quality import learn_quality, sampled, score_quality, train
from weftline.llm.toxicity import _Chunks, learn_toxicity, marginals, score_toxicity

rng = random.Random(6)
WORDS = {g: ["".join(rng.choice(s) for _ in range(rng.randrange(1, 4))) for _ in range(300)] for g, s in {
    "xx": ["ka", "mo", "ri", "tu", "sel"], "yy": ["pré", "eau", "ion", "qué", "bla"], "zz": ["sch", "ung", "ein", "über", "tz"],
}.items()}


def prose(lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


ODD = [(9001, None), (9002, ""), (9003, "123 -- 456"), (9004, "ka mo " * 60_000), (9005, "ka"), (9005, "ka"), (None, "x")]


def odd(spark):
    return spark.createDataFrame([(*r, 1, "a") for r in ODD], "doc_id long, text string, score int, key string")


def test_language(spark):
    rows = [(i, prose(g, rng.randrange(5, 80)), g) for i, g in enumerate(rng.choices(list(WORDS), k=900))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn_languages(docs.where("doc_id % 3 <> 1"))
    got = {r["doc_id"]: r["lang_pred"] for r in identify(docs.where("doc_id % 3 = 1"), model).collect()}
    assert np.mean([got[i] == g for i, _, g in rows if i % 3 == 1]) > 0.98
    answers = [(r["doc_id"], r["lang_pred"], r["score"]) for r in identify(odd(spark), model).collect()]
    assert len(answers) == len(ODD) and all(0 <= s <= 1 for _, _, s in answers)
    assert {k for k, g, _ in answers if g == "und"} == {9001, 9002, 9003}
    none = learn_languages(docs.limit(0))
    assert {r["lang_pred"] for r in identify(odd(spark), none).collect()} == {"und"}
    assert identify(odd(spark).limit(0), model).count() == 0


def test_letters_of_any_script():
    """Letters by Unicode, also where no n-gram is known; marks, digits and symbols are none."""
    model = build_filter({"a": np.arange(5, dtype=np.uint64), "b": np.arange(9, dtype=np.uint64)})
    letters = ["µ", "ª", "ⰀⰁⰂ", "ⲁⲃ", "々", "ℂℝ", "x", "é", "Ж", "中", "1ª", "12 ℝ"]
    others = ["", None, "×÷", "…—“”", "١٢٣", "😀", "12 345", "№", "₿", "̀", "〇"]
    names, score, _ = judge(model, pa.array(letters + others))
    assert all(n in ("a", "b") for n in names[: len(letters)]) and set(names[len(letters) :]) == {"und"}
    assert ((score >= 0) & (score <= 1)).all()


def test_masks_equal_plain_hash_sets():
    """The bit-sliced filter against one set of slots for each language."""
    rng = np.random.default_rng(3)
    grams = {f"l{i:02}": rng.integers(0, 1 << 62, 300, dtype=np.uint64) for i in range(70)}
    model = build_filter(grams)
    texts = ["the cat sat", "", "a über straße 12", "zzz " * 50]
    data, offsets = raw_bytes(pa.array(texts))
    found, total = hits(model, data, offsets)
    for t in range(len(texts)):
        own = [g for packed, at in _grams(data, offsets) for g in packed[at[t] : at[t + 1]]]
        assert total[t] == len(own)
        for i, name in enumerate(model.languages):
            plain = [set(s.tolist()) for s in _slots(grams[name])]
            union = set().union(*plain)
            want = sum(all(int(s[0]) in union for s in _slots(np.array([g]))) for g in own)
            false = (len(union) / (1 << SLOT_BITS)) ** HASHES
            sizes = [len([1 for g in packed[at[t] : at[t + 1]]]) for packed, at in _grams(data, offsets)]
            assert found[t, i] <= want + 1e-9 and found[t, i] >= want - false * sum(sizes) - 1e-9


def test_a_step_of_descent_lowers_the_loss():
    """One text with label 1 and one with label 0, against numerical slopes of the same loss."""
    ids = [np.array([1, 2, 3], np.int32), np.array([3, 4], np.int32)] * 20
    counts = [np.array([1, 2, 1], np.float32), np.array([1, 1], np.float32)] * 20
    model = train(ids, counts, np.array([1, 0] * 20))
    weights = model.projected()
    bias = model.bias[1] - model.bias[0]
    logit = [float((weights[i] * c).sum() / c.sum() + bias) for i, c in zip(ids[:2], counts[:2], strict=True)]
    assert logit[0] > 0 > logit[1]


def test_more_languages_than_bits():
    grams = {f"l{i:03}": np.random.default_rng(i).integers(0, 1 << 62, 50, dtype=np.uint64) for i in range(150)}
    model = build_filter(grams)
    assert len(model.masks) == 3 and model.languages == sorted(grams)


def test_quality(spark):
    rows = []
    for i in range(600):
        text, good = prose(rng.choice(list(WORDS)), rng.randrange(5, 80)), i % 3
        rows.append((i, text if good else text.replace(" ", "%% "), int(good > 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = learn_quality(docs.where("doc_id % 4 <> 2"))
    got = {r["doc_id"]: r["score"] for r in score_quality(docs.where("doc_id % 4 = 2"), model).collect()}
    assert np.mean([(got[i] >= 0.7) == bool(y) for i, _, y in rows if i % 4 == 2]) > 0.97
    answers = score_quality(odd(spark), model).collect()
    assert len(answers) == len(ODD) and all(0 <= r["score"] <= 1 for r in answers)
    assert len({r["score"] for r in answers if r["doc_id"] in (9001, 9002)}) == 1
    nothing = score_quality(odd(spark), learn_quality(docs.limit(0))).collect()
    assert {r["score"] for r in nothing if r["doc_id"] in (9001, 9002)} == {0.5}


def test_quality_features_reach_the_driver_in_pieces(spark):
    """57 MB of features of 200 long texts; the first vectors take 12 MB for a moment."""
    words = F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda x: F.hex(F.xxhash64("id", x)))
    docs = spark.range(200).select(
        F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"), (F.col("id") % 2).alias("label")
    )
    pieces = sampled(docs, "doc_id", 5000).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in pieces) <= 64 and sum(r["count"] for r in pieces) == 200
    tracemalloc.start()
    try:
        model = learn_quality(docs)
        assert tracemalloc.get_traced_memory()[1] < 30e6
    finally:
        tracemalloc.stop()
    assert model.prior == 0.5


@pytest.mark.parametrize("sizes", [[1], [3, 0, 5], [70, 1, 130, 0, 64]])
def test_marginals_are_exact(sizes):
    draw = np.random.default_rng(len(sizes))
    moves = draw.normal(size=(2, 2))
    scores = draw.normal(size=sum(sizes)) * 2
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    got = marginals(scores, firsts, moves)
    for a, b in itertools.pairwise(firsts):
        n = b - a
        if not n:
            continue
        e, m = np.stack([np.ones(n), np.exp(scores[a:b])], axis=1), np.exp(moves)
        ahead, back = np.zeros((n, 2)), np.ones((n, 2))
        ahead[0] = m[0] * e[0]
        for t in range(1, n):
            ahead[t] = (ahead[t - 1] @ m) * e[t]
            ahead[t] /= ahead[t].sum()
        for t in range(n - 2, -1, -1):
            back[t] = m @ (e[t + 1] * back[t + 1])
            back[t] /= back[t].sum()
        want = ahead * back
        assert np.allclose(got[a:b], want[:, 1] / want.sum(axis=1))
    assert _Chunks(firsts).valid.sum() == sum(sizes)


def test_toxicity(spark):
    bad = ["scoundrel", "réfiend", "réfiendish"]
    rows = []
    for i in range(900):
        words = prose(rng.choice(list(WORDS)), rng.randrange(5, 150)).split()
        for _ in range(rng.randrange(1, 4) if i % 5 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = learn_toxicity(docs.where("doc_id % 3 <> 1"))
    texts = {i: t for i, t, _ in rows}
    got = {r["doc_id"]: r for r in score_toxicity(docs.where("doc_id % 3 = 1"), model).collect()}
    assert np.mean([(got[i]["score"] >= 0.7) == bool(y) for i, _, y in rows if i % 3 == 1]) > 0.97
    spans = [(texts[i][int(s.split(":")[0]) : int(s.split(":")[1])]) for i, r in got.items() for s in r["offsets"].split(",") if s]
    assert set(spans) <= set(bad) and len(spans) > 40
    answers = score_toxicity(odd(spark), model).collect()
    assert len(answers) == len(ODD) and all(0 <= r["score"] <= 1 for r in answers)
    assert {r["score"] for r in score_toxicity(odd(spark), learn_toxicity(docs.limit(0))).collect()} == {0.5}
