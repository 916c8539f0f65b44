"""Exact top-k inner products by pivot-table elimination.

Vectors become integers, floor(scale * x). With one more component all of them get the same
norm, so that a larger inner product is a smaller distance and the triangle inequality holds.
A table keeps every vector's distance to each of many pivots; for a query, the greatest
difference of two distances to a pivot is a lower bound of the distance. A task evaluates
a block's vectors in the order of their bounds, until the next bound shows that no vector
that is left can enter the query's top k. Ties on the border are evaluated, so the result
is exact.

Queries and vectors are dealt into blocks that meet once each. Pivots come from a
bounded sample; they decide the speed, never the result. A block's best k go on;
no group holds more than k rows for each block, and these are cut down to k again in levels.

Vectors that are null, empty, hold null or non-finite components, or do not have the
common dimension (the most frequent one) take no part, nor do rows without an id; a component whose
scaled value passes 64 bits is an error. Equal ids are one query's own rows
and are left out of its candidates. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pivots, and vectors in a block of candidates and of queries.
PIVOTS = 64
BLOCK = 1024
QUERY_BLOCK = 4096


def whole_vectors(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, vec array<long>, squared norm) of the rows that take part."""
    parts = F.col(vector).cast("array<double>")
    fine = F.coalesce(
        F.size(vector) > 0, F.lit(False)
    ) & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        table.where(fine & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.transform(parts, lambda x: F.floor(x * scale)).alias("vec"))
        .withColumn("square", F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: a + x * x))
    )


def top_k(
    table: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10,
    scale: int = 1024, pivots: int = PIVOTS, block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``is_query``, its k best other rows."""
    held = whole_vectors(table, key, vector, scale)
    shapes = held.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("rows"), F.max("square").alias("square"))
    common = shapes.orderBy(F.desc("rows"), "dim").first()
    if common is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim, rows, most = common["dim"], common["rows"], common["square"]
    held = held.where(F.size("vec") == dim)
    asked = whole_vectors(table.where(is_query), key, vector, scale).where(F.size("vec") == dim)
    blocks, parts = max(1, -(-rows // block)), max(1, -(-asked.count() // query_block))
    chosen = held.orderBy(F.xxhash64("id"), "id", "vec").limit(pivots).select("vec").collect()
    pivot_rows = np.array([r["vec"] for r in chosen], dtype=np.int64)

    # every block of queries meets every block of vectors once
    vectors = _in_blocks(held, blocks).select(
        F.col("number").alias("block"), F.explode(_numbers(parts)).alias("part"),
        F.lit(False).alias("asked"), "ids", "vecs",
    )
    queries = _in_blocks(asked, parts).select(
        F.explode(_numbers(blocks)).alias("block"), F.col("number").alias("part"),
        F.lit(True).alias("asked"), "ids", "vecs",
    )

    def search(pair: pa.Table) -> pa.Table:
        sides = {row["asked"]: _unpacked(row, dim) for row in pair.to_pylist()}
        found = []
        if len(sides) == 2:
            found = search_block(*sides[True], *sides[False], pivot_rows, most, k)
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] or [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    best = vectors.union(queries).groupBy("block", "part").applyInArrow(search, "query_id long, vec_id long, score long")
    # the limit on the rank cuts to k rows in every task before the shuffle
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _in_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """One row for each block: its number, ids and vectors as bytes."""

    def run(table: pa.Table) -> pa.Table:
        vecs = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ids = table.column("id").to_numpy()
        return pa.table({
            "number": table.column("number")[:1], "ids": [ids.astype("<i8").tobytes()], "vecs": [vecs.astype("<i8").tobytes()],
        })

    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("number"), "id", "vec")
    return dealt.groupBy("number").applyInArrow(run, "number long, ids binary, vecs binary")


def _unpacked(row: dict, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vecs"], "<i8").reshape(-1, dim)


def distances(vectors: np.ndarray, pivots: np.ndarray, most: int) -> np.ndarray:
    """Distances of vectors to pivots, where the added component fills all norms up to ``most``."""
    fill = np.sqrt((most - (vectors * vectors).sum(axis=1)).astype(float))
    pivot_fill = np.sqrt((most - (pivots * pivots).sum(axis=1)).astype(float))
    inner = vectors.astype(float) @ pivots.T.astype(float) + np.outer(fill, pivot_fill)
    return np.sqrt(np.maximum(0.0, 2.0 * most - 2.0 * inner))


def search_block(
    own: np.ndarray, wanted: np.ndarray, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, most: int, k: int,
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, ids, scores) of the k best of a block for each query.

    A query's added component is 0: its squared distance to a vector x is
    |q|^2 + most - 2 q.x, so the distance falls as the inner product grows.
    """
    table = distances(vectors, pivots, most)
    square = (wanted * wanted).sum(axis=1).astype(float)
    to_pivot = np.sqrt(np.maximum(0.0, square[:, None] + most - 2.0 * (wanted.astype(float) @ pivots.T.astype(float))))
    # far more than rounding can do, so that no bound is too high
    slack = 1e-6 * np.sqrt(float(most) + square) + 1e-6
    found = []
    for i in range(len(own)):
        bound = np.abs(table - to_pivot[i]).max(axis=1) - slack[i]
        order = np.argsort(bound, kind="stable")
        best_id, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, max(64, 4 * k)
        while at < len(order):
            if len(best) == k and bound[order[at]] > np.sqrt(max(0.0, square[i] + most - 2.0 * float(best[-1]))):
                break
            part = order[at : at + step]
            at, step = at + step, step * 2
            part = part[ids[part] != own[i]]
            every_id = np.concatenate([best_id, ids[part]])
            every = np.concatenate([best, vectors[part] @ wanted[i]])
            top = np.lexsort((every_id, -every))[:k]
            best_id, best = every_id[top], every[top]
        found.append((np.full(len(best), own[i]), best_id, best))
    return found
