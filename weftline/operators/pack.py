"""Sequence packing: token arrays to rows of fixed length.

Both forms of packing are one job over *segments*. Batch packing makes one segment
of every ``batch_docs`` consecutive documents; corpus packing makes one segment of
the whole table. The steps:

1. From ``(key, token count)`` alone, find the rank of each document and the tokens
   of each piece (bucket x segment), hence where each piece starts in its segment.
2. Shuffle the text once, by bucket. Place each document, cut its tokens at the
   block borders, and put together every block that lies inside one piece; the
   bucket partitioning has already brought its parts together.
3. Blocks across the edge of a piece, about one per piece, are put together by a
   second shuffle of those few parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators.ranks import BUCKET_ROWS, bucket_offsets, div, with_bucket
from weftline.operators.tokens import Cut, Tokens


def _corpus_pieces(narrow: DataFrame) -> DataFrame:
    parts = narrow.groupBy("_bucket").agg(F.sum("_n").alias("tokens"))
    zero = F.lit(0).cast("bigint")
    return (
        parts.join(bucket_offsets(parts, (), ["tokens"]), "_bucket")
        .withColumn("total", parts.agg(F.sum("tokens")).scalar())
        .select(
            "_bucket",
            zero.alias("first_rank"),
            zero.alias("segment"),
            "total",
            F.col("_off_tokens").alias("seg_before"),
            zero.alias("bucket_before"),
            "tokens",
        )
    )


def _batch_pieces(narrow: DataFrame, batch_docs: int) -> DataFrame:
    docs = narrow.groupBy("_bucket").agg(F.count("*").alias("docs"))
    by_key = W.partitionBy("_bucket").orderBy("_key")
    parts = (
        narrow.withColumn("_rn", F.row_number().over(by_key) - 1)
        .join(bucket_offsets(docs, (), ["docs"]).hint("shuffle_hash"), "_bucket")
        .groupBy(
            "_bucket",
            F.col("_off_docs").alias("first_rank"),
            div(F.col("_rn") + F.col("_off_docs"), batch_docs).alias("segment"),
        )
        .agg(F.sum("_n").alias("tokens"))
    )
    in_segment = W.partitionBy("segment")
    before_in_segment = in_segment.orderBy("_bucket").rowsBetween(
        W.unboundedPreceding, -1
    )
    before_in_bucket = (
        W.partitionBy("_bucket").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    )
    zero = F.lit(0)
    return parts.select(
        "_bucket",
        "first_rank",
        "segment",
        F.sum("tokens").over(in_segment).alias("total"),
        F.coalesce(F.sum("tokens").over(before_in_segment), zero).alias("seg_before"),
        F.coalesce(F.sum("tokens").over(before_in_bucket), zero).alias("bucket_before"),
        "tokens",
    )


def _place(
    base: DataFrame, narrow: DataFrame, batch_docs: int | None, tail: int
) -> DataFrame:
    """Add to each document its segment, its token range there and its piece's range."""
    if batch_docs:
        pieces = _batch_pieces(narrow, batch_docs)
    else:
        pieces = _corpus_pieces(narrow)
    # one row per bucket, so that the join leaves the bucket partitioning alone;
    # a bucket has at most rows-per-bucket pieces
    pieces = pieces.groupBy("_bucket", "first_rank").agg(
        F.array_sort(
            F.collect_list(
                F.struct("segment", "total", "seg_before", "bucket_before", "tokens")
            )
        ).alias("_pieces")
    )
    by_key = W.partitionBy("_bucket").orderBy("_key")
    rows = base.withColumns(
        {
            "_rn": F.row_number().over(by_key) - 1,
            "_upto": F.sum("_n").over(by_key.rowsBetween(W.unboundedPreceding, 0)),
        }
    ).join(pieces.hint("shuffle_hash"), "_bucket")
    # the pieces of a bucket are consecutive segments
    segment = (
        div(F.col("_rn") + F.col("first_rank"), batch_docs)
        if batch_docs
        else F.lit(0).cast("bigint")
    )
    nth = (segment - F.col("_pieces")[0]["segment"]).cast("int")
    rows = rows.withColumn("_p", F.get("_pieces", nth))
    p = F.col("_p")
    start = p["seg_before"] - p["bucket_before"] + F.col("_upto") - F.col("_n")
    return rows.select(
        *[c for c in base.columns if c != "_key"],
        p["segment"].alias("segment"),
        start.alias("_start"),
        (start + F.col("_n")).alias("_stop"),
        (p["total"] - tail).alias("_total"),
        p["seg_before"].alias("_piece_start"),
        (p["seg_before"] + p["tokens"]).alias("_piece_stop"),
    )


def _pack(
    df: DataFrame,
    tokens: Tokens,
    key: str,
    length: int,
    stride: int,
    batch_docs: int | None,
    keep_short: bool,
    tail: int,
    bucket: Column | None,
    rows: int,
    sizes: DataFrame | None,
) -> DataFrame:
    def keyed(rows_in: DataFrame) -> DataFrame:
        return with_bucket(rows_in, key, (), bucket, rows).withColumns(
            {"_key": F.col(key), "_n": tokens.count().cast("bigint")}
        )

    base = keyed(df)
    narrow = base if sizes is None else keyed(sizes)
    docs = _place(base, narrow.select("_bucket", "_key", "_n"), batch_docs, tail)
    start, stop, total = F.col("_start"), F.col("_stop"), F.col("_total")

    blocks = F.when(total >= length, div(total - length, stride) + 1).otherwise(
        F.when(total > 0, 1).otherwise(0) if keep_short else F.lit(0)
    )
    first = F.when(start >= length, div(start - length, stride) + 1).otherwise(0)
    last = F.least(blocks - 1, div(stop - 1, stride))
    docs = docs.withColumns(
        {"_first": first.cast("bigint"), "_last": last.cast("bigint")}
    ).filter("_stop > _start and _first <= _last")

    def inner(k: Column) -> Column:
        return (k * stride >= F.col("_piece_start")) & (
            F.least(k * stride + length, total) <= F.col("_piece_stop")
        )

    def part(k: Column, cut: Cut) -> Column:
        low = F.greatest(start, k * stride)
        high = F.least(stop, k * stride + length, total)
        size = F.greatest(high - low, F.lit(0)).cast("int")
        return F.struct(
            k.alias("block"),
            inner(k).alias("inner"),
            low.alias("low"),
            size.alias("size"),
            cut((low - start).cast("int"), size).alias("piece"),
        )

    def parts(rows: DataFrame) -> DataFrame:
        numbers = F.sequence("_first", "_last")
        cuts = tokens.per_block(numbers, part)
        return rows.select("_bucket", "segment", F.inline(cuts)).filter("size > 0")

    def assemble(rows: DataFrame, *keys: str) -> DataFrame:
        in_order = F.array_sort(F.collect_list(F.struct("low", "piece")))
        return (
            rows.groupBy(*keys)
            .agg(in_order.alias("_parts"))
            .select(
                "segment", "block", tokens.join(F.col("_parts.piece")).alias("input_ids")
            )
        )

    whole = parts(docs).filter("inner")
    # a document with a block across an edge has it as its first or its last
    edge_docs = docs.filter(~(inner(F.col("_first")) & inner(F.col("_last"))))
    across = parts(edge_docs).filter("not inner")
    return assemble(whole, "_bucket", "segment", "block").unionByName(
        assemble(across, "segment", "block")
    )


def pack_batches(
    df: DataFrame,
    tokens: Tokens,
    key: str,
    length: int = 4096,
    batch_docs: int = 1000,
    drop_short: bool = False,
    bucket: Column | None = None,
    rows: int = BUCKET_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Pack every ``batch_docs`` consecutive documents on their own.

    The tail of a batch shorter than ``length`` is dropped. A batch that has fewer
    than ``length`` tokens in all gives one short row, unless ``drop_short``.

    ``sizes`` may name a table with the same keys that counts tokens more cheaply than
    ``df``. Returns ``(batch_id, block, input_ids, labels)``.
    """
    packed = _pack(
        df, tokens, key, length, length, batch_docs, not drop_short, 0, bucket, rows,
        sizes,
    )
    return packed.select(
        F.col("segment").alias("batch_id"),
        "block",
        "input_ids",
        F.col("input_ids").alias("labels"),
    )


def pack_corpus(
    df: DataFrame,
    tokens: Tokens,
    key: str,
    length: int = 2048,
    stride: int | None = None,
    bucket: Column | None = None,
    rows: int = BUCKET_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Windows of ``length`` at step ``stride`` over all documents in key order.

    The end marker of ``tokens``, if any, stands between documents and is left out
    after the last. Windows overlap when ``stride < length`` and leave gaps when it is
    larger; a shorter tail is dropped. Returns ``(seq_id, input_ids, labels)``.
    """
    packed = _pack(
        df,
        tokens,
        key,
        length,
        stride or length,
        None,
        False,
        int(tokens.end is not None),
        bucket,
        rows,
        sizes,
    )
    return packed.select(
        F.col("block").alias("seq_id"),
        "input_ids",
        F.col("input_ids").alias("labels"),
    )


def check_packed(df: DataFrame, length: int) -> DataFrame:
    """Rows, and rows that could not be stacked into one batch of width ``length``."""
    ids, labels = F.size("input_ids"), F.size("labels")
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(F.coalesce(ids != length, F.lit(True))).alias("bad_input_ids"),
        F.count_if(F.coalesce(labels != length, F.lit(True))).alias("bad_labels"),
        F.count_if(F.coalesce(ids != labels, F.lit(True))).alias("unequal"),
    )
