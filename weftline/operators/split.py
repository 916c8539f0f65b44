"""Splits, shards, samplers and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.ranks import (
    BUCKET_ROWS,
    div,
    first_part,
    with_any_rank,
    with_rank,
)


def split_sequential(
    df: DataFrame, key: str, ratio: float = 0.9, rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``split``: ``train`` for the first ``int(n * ratio)`` rows, else ``val``.

    Only the first validation key is looked up; the rows themselves are not shuffled. Rows
    with that key are numbered if the cut goes through them.
    """
    train = first_part(df, key, int(df.count() * ratio), "_train", rows)
    return train.withColumn("split", F.when(F.col("_train"), "train").otherwise("val")).drop("_train")


def first_rows(df: DataFrame, key: str, n: int, rows: int = BUCKET_ROWS) -> DataFrame:
    """The first ``n`` rows in key order, as a filter on the key of row ``n``."""
    return first_part(df, key, n, "_first", rows).filter("_first").drop("_first")


def shard_rows(
    df: DataFrame, key: str, num_shards: int, index: int, rows: int = BUCKET_ROWS
) -> DataFrame:
    """Every ``num_shards``-th row in key order, from ``index`` on."""
    if not 0 <= index < num_shards:
        raise ValueError("index must be in [0, num_shards)")
    ranked = with_any_rank(df, key, "_rank", rows)
    return ranked.filter(F.pmod("_rank", F.lit(num_shards)) == index).drop("_rank")


def shuffle_key(key: Column, seed: int, epoch: int) -> Column:
    """A hash to sort by: a random order that a retried task finds again."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)), key.cast("string")))


def shuffle_epoch(
    df: DataFrame,
    key: str,
    seed: int = 42,
    epoch: int = 0,
    name: str = "rank",
    bucket_digits: int = 5,
) -> DataFrame:
    """Add the row's place in a full permutation of the table, new for each epoch.

    Buckets are leading hex digits of the hash, so they are even: with 5 digits
    about a million, hence 10,000 rows each in a table of ten billion.
    """
    hashed = df.withColumn("_shuffle", shuffle_key(F.col(key), seed, epoch))
    bucket = F.conv(F.substring("_shuffle", 1, bucket_digits), 16, 10).cast("bigint")
    return with_rank(hashed, ["_shuffle", key], name, bucket=bucket).drop("_shuffle")


def distributed_sampler(
    df: DataFrame,
    key: str,
    replicas: int,
    shuffle: bool = True,
    seed: int = 42,
    epoch: int = 0,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``replica`` and ``sample``; every replica gets the same number of rows.

    The order is filled up to a multiple of ``replicas`` by starting over from its
    first rows, then dealt out in turn.
    """
    if shuffle:
        ranked = shuffle_epoch(df, key, seed, epoch, "_rank")
    else:
        ranked = with_any_rank(df, key, "_rank", rows)
    total = df.agg(F.count("*")).scalar()
    padded = F.ceil(total / replicas).cast("bigint") * replicas
    places = F.sequence(F.col("_rank"), padded - 1, total)
    return (
        ranked.withColumn("_place", F.explode(places))
        .withColumns(
            {
                "replica": F.pmod("_place", F.lit(replicas)).cast("int"),
                "sample": div(F.col("_place"), replicas),
            }
        )
        .drop("_rank", "_place")
    )


def batches(
    ranked: DataFrame, size: int, drop_last: bool, rank: str = "rank"
) -> DataFrame:
    """Add ``batch_id`` to rows ranked from 0; ``drop_last`` drops a short last batch."""
    out = ranked.withColumn("batch_id", div(F.col(rank), size))
    if not drop_last:
        return out
    total = ranked.agg(F.count("*")).scalar()
    return out.filter(F.col("batch_id") < div(total, size))
