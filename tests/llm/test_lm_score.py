"""Scores against counts in dictionaries."""

import math
import random
import re
from collections import Counter

import pytest

from weftline.llm import lm_score
from weftline.llm.lm_score import ALPHA, score, squeeze, unsqueeze


def brute(rows, order):
    docs = [re.findall(r"\w+", (t or "").lower()) for _, t in rows]
    grams = lambda d: Counter(tuple(d[i : i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1))
    every, total = sum((grams(d) for d in docs), Counter()), sum(map(len, docs))
    out = []
    for (key, _), d in zip(rows, docs, strict=True):
        rest = every.copy()
        rest.subtract(grams(d))
        left, value = total - len(d), 0.0
        for p in range(len(d)):
            history = min(p, order - 1)
            for n in range(history + 1, 0, -1):
                gram = tuple(d[p - n + 1 : p + 1])
                if rest[gram] > 0:
                    value += math.log(rest[gram] / (rest[gram[:-1]] if n > 1 else left)) + (history + 1 - n) * math.log(ALPHA)
                    break
            else:
                value += (history + 1) * math.log(ALPHA) - math.log(left + 1)
        out.append((key, len(d), value))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_same_as_dictionaries(spark, order):
    rng = random.Random(order)
    words = ["the", "of", "Été", "a1", "b_2", *(f"w{i}" for i in range(40))]
    weights = [30, 20, 10, 5, 5, *([1] * 40)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(40)))) for i in range(120)]
    rows += [(200, rows[3][1]), (200, rows[3][1]), (201, None), (202, ""), (None, "the of the of unseen"), (203, "the " * 5000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, tokens int")
    got = sorted(((r["doc_id"] or -1, r["tokens"], r["log_score"]) for r in score(docs, order=order, block_bytes=700).collect()))
    want = sorted(((k or -1, n, v) for k, n, v in brute(rows, order)))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-6 * max(1, abs(w[2])) for g, w in zip(got, want, strict=True))


def test_no_rows_and_packing(spark):
    assert score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    values = lm_score.np.array([0, 1, 1 << 40, -5])
    assert (unsqueeze(squeeze(values)) == values).all()
