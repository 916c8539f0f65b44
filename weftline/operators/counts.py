"""Counts over corpora, splits and training plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.ranks import div
from weftline.operators.tokens import Tokens


def doc_counts(df: DataFrame, path: str = "path") -> DataFrame:
    """``(path, n)`` and the total in a row whose path is null."""
    return df.rollup(path).agg(F.count("*").alias("n"), F.grouping(path).alias("is_total"))


def corpus_stats(
    df: DataFrame, tokens: Tokens, length: int, stride: int | None = None, text: str = "text"
) -> DataFrame:
    """Documents, characters and tokens of the joined corpus, and its examples.

    One space joins two documents; ``tokens`` gives the size of a document with its
    separator. One pass over the table, combined before the shuffle.
    """
    stride = stride or length
    separator = int(tokens.end is not None)
    sums = df.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(F.length(text).cast("bigint")), F.lit(0)).alias("_chars"),
        F.coalesce(F.sum(tokens.count()), F.lit(0)).alias("_tokens"),
    )
    joints = F.greatest(F.col("documents") - 1, F.lit(0))
    total = F.greatest(F.col("_tokens") - separator, F.lit(0))
    return sums.select(
        "documents",
        (F.col("_chars") + joints).alias("characters"),
        total.alias("tokens"),
        F.when(total >= length, div(total - length, stride) + 1)
        .otherwise(0)
        .cast("bigint")
        .alias("examples"),
    )


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n"))


def training_plan(
    df: DataFrame, batch_size: int, epochs: int, accumulation: int = 1, drop_last: bool = True
) -> DataFrame:
    """``(rows, batches, micro_steps, optimizer_steps)`` of a run over ``df``.

    The learning-rate schedule moves once per optimizer step; what is left of an
    epoch after the last full accumulation makes no step.
    """
    n = F.col("rows")
    per_epoch = div(n if drop_last else n + (batch_size - 1), batch_size)
    return df.agg(F.count("*").alias("rows")).select(
        "rows",
        per_epoch.alias("batches"),
        (per_epoch * epochs).alias("micro_steps"),
        (div(per_epoch, accumulation) * epochs).alias("optimizer_steps"),
    )
