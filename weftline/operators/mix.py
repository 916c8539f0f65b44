"""Weighted interleaving of ordered sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.ranks import BUCKET_ROWS, with_rank, with_running

# Resolution of the arrival times; whole numbers add up to the same sum in any order.
TICKS = 1 << 20


def by_source(values: Mapping[str, float], source: Column) -> Column:
    """A constant per source, null for a source that is not listed."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.create_map(*pairs)[source]


def gap(key: Column, source: Column, share: Column, seed: int) -> Column:
    """An exponential waiting time of mean ``1 / share`` ticks, fixed by the row."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), source, key.cast("string")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    uniform = (bits.cast("double") + 0.5) / float(1 << 52)
    return F.ceil(-F.ln(uniform) / share * float(TICKS)).cast("bigint")


def interleave(
    df: DataFrame,
    weights: Mapping[str, float],
    key: str,
    source: str = "source",
    mode: str = "random",
    seed: int = 42,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Mix the sources in proportion to ``weights``; each keeps its own order.

    Adds ``k`` (0-based number inside the source) and the sort key ``(mix_key,
    mix_index)``. ``random`` gives every row an arrival time: merged by time,
    independent Poisson processes pick the next source independently with the given
    probabilities. ``quota`` spaces the rows evenly, for exact shares.

    The mixture stops with the first source that runs out. Sources that are not
    listed are left out; a listed source without rows gives an empty mixture.
    """
    if mode not in ("random", "quota"):
        raise ValueError(f"unknown mode {mode!r}")
    total = sum(weights.values())
    src = F.col(source)
    listed = df.filter(src.isin(*weights)).withColumns(
        {
            "mix_index": by_source({s: i for i, s in enumerate(weights)}, src),
            "_weight": by_source({s: float(w) for s, w in weights.items()}, src),
        }
    )
    one = F.lit(1).cast("bigint")
    if mode == "random":
        wait = gap(F.col(key), src, F.col("_weight") / total, seed)
        mixed = with_running(
            listed, key, {"k": one, "mix_key": wait}, by=[source], rows=rows
        ).withColumn("k", F.col("k") - 1)
        last_key = F.sum(wait)
    else:
        mixed = with_rank(listed, key, "k", by=[source], rows=rows).withColumn(
            "mix_key", (2 * F.col("k") + 1) / F.col("_weight")
        )
        last_key = (2 * F.count("*") - 1) / F.first("_weight")

    # where each source ends follows from sums over its rows, without their order
    ends = listed.groupBy("mix_index").agg(last_key.alias("mix_key"))
    cut = ends.agg(
        F.when(
            F.count("*") == len(weights), F.min(F.struct("mix_key", "mix_index"))
        ).alias("cut")
    ).scalar()
    return mixed.filter(F.struct("mix_key", "mix_index") <= cut).drop("_weight")


def mixture_position(
    mixed: DataFrame,
    weights: Mapping[str, float],
    mode: str = "random",
    name: str = "pos",
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add the 0-based place in the mixture.

    ``mix_key`` grows by a known amount per row of the mixture, so equal steps of it
    are buckets of about ``rows`` rows.
    """
    per_row = TICKS if mode == "random" else 2 / sum(weights.values())
    bucket = F.floor(F.col("mix_key") / (per_row * rows)).cast("bigint")
    return with_rank(mixed, ["mix_key", "mix_index"], name, bucket=bucket)


def mixture_report(
    mixed: DataFrame, weights: Mapping[str, float], source: str = "source"
) -> DataFrame:
    """``(source, n, share, target)`` for every source of the mixture."""
    total = sum(weights.values())
    counts = mixed.groupBy(source).agg(F.count("*").alias("n"))
    return counts.select(
        F.col(source).alias("source"),
        "n",
        (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("share"),
        (by_source({s: float(w) for s, w in weights.items()}, F.col(source)) / total).alias("target"),
    )
