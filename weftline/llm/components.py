"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the same key. The minimum is combined before
the shuffle, and is written before the join: both sides then come straight from a shuffle,
and adaptive execution splits the partition of a node with very many neighbours (it does not
split one that comes from an aggregation). Nothing is collected; each round is written to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.store import written

#: Rounds grow with the logarithm of the longest path.
ROUNDS = 50


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node but the roots, from undirected edges; root is the least node.

    Edges with a null end and loops say nothing. No edges give no rows.
    """
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(f"{u} is not null and {v} is not null")
    edges = written(edges.where("u <> v").distinct(), "edges")
    before = _state(edges)
    for _ in range(ROUNDS):
        # only a neighbour below v can take its place
        below = written(edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("least")), "below")
        large = written(edges.join(below, "v", "left").select("u", F.coalesce("least", "v").alias("v")).distinct(), "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("least")), "least")
        small = large.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = written(small.union(least.select("u", "least")).distinct(), "edges")
        after = _state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
    raise RuntimeError(f"no fixed point in {ROUNDS} rounds")
