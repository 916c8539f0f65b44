"""Pivot elimination against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm.topk_search import top_k


def brute(rows, k, scale=1024):
    fine = [(i, np.floor(scale * np.array(v, dtype=float)).astype(np.int64)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in fine:
        if q % 100 == 0:
            order = sorted((-int(v @ w), i) for i, w in fine if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("block", [50, 100_000])
def test_same_as_all_products(spark, block):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(5, 8))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 5] * (1 + i % 3) + 0.1 * rng.normal(size=8)]) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # ties
    rows += [(800, None), (801, [None] + rows[0][1][1:]), (900, [float("nan")] * 8), (901, [float("inf")] + [0.0] * 7), (902, [0.0] * 8)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, score string, rank int")
    got = top_k(table, F.col("vec_id") % 100 == 0, block=block, query_block=3, pivots=6)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10)


def test_rows_without_an_id_take_no_part(spark):
    big = 9007199254740993
    rows = [(0, [1.0, 0.0]), (None, [9.0, 9.0]), (big, [0.5, 0.5]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(table, F.col("vec_id") == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, big, 512 * 1024)]


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = top_k(table, F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 100, 512 * 1024), (100, 1, 0, 512 * 1024)]
    assert top_k(table.limit(0), F.lit(True)).count() == 0
    assert top_k(table, F.lit(False)).count() == 0
