"""Whole jobs: files to a JSONL corpus, and sources to packed rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import text_hash
from weftline.operators.dedup import first_of_hash
from weftline.operators.mix import TICKS, interleave
from weftline.operators.pack import pack_batches
from weftline.operators.ranks import BUCKET_ROWS, div, with_rank
from weftline.operators.select import require_rows
from weftline.operators.split import distributed_sampler, split_sequential
from weftline.operators.tokens import EOS, ArrayTokens, ByteTokens, byte_count
from weftline.session import materialize, temporary_scratch
from weftline.sources.files import (
    ORDER,
    damaged_names,
    ingest_mixed_dir,
    read_csv_column,
    read_json,
    read_jsonl,
    read_parquet_column,
    read_text_files,
    skipped_files,
)
from weftline.sources.sinks import in_order, write_jsonl, write_split


def convert_directory(
    spark: SparkSession,
    directory: str,
    output: str,
    column: str = "text",
    train_ratio: float | None = None,
    recursive: bool = True,
    skip_damaged: bool = False,
) -> None:
    """Mixed files to ``output/data`` and, with a ratio, ``output/splits/split=train|val``.

    None means no split. Part files in the order of their names hold the corpus in the
    order of path and place in the file. With ``skip_damaged`` files that cannot be read
    are recorded in ``output/skipped``, as path and reason, and left out; else they are
    an error.
    """
    with temporary_scratch(spark):
        _convert(spark, directory, output, column, train_ratio, recursive, skip_damaged)


def _convert(
    spark: SparkSession,
    directory: str,
    output: str,
    column: str,
    train_ratio: float | None,
    recursive: bool,
    skip_damaged: bool,
) -> None:
    skip = []
    if skip_damaged:
        skipped_files(spark, directory, recursive).write.mode("overwrite").json(f"{output}/skipped")
        record = spark.read.schema("path string, reason string").json(f"{output}/skipped")
        skip = damaged_names(record)
    # parsed once; the steps below see the texts alone
    parsed = materialize(ingest_mixed_dir(spark, directory, column, recursive, skip=skip), "texts")
    texts = require_rows(parsed, f"no supported files with text in {directory}")
    # the place of a text is its key: numbers would cost one more shuffle of the texts
    corpus = texts.select(F.struct(*ORDER).alias("place"), "text")
    write_jsonl(in_order(corpus, "place"), f"{output}/data", mode="overwrite")
    if train_ratio is not None:
        write_split(split_sequential(corpus, "place", train_ratio), f"{output}/splits", order="place")


def convert_file(
    spark: SparkSession,
    path: str,
    output: str,
    kind: str,
    column: str = "text",
    delimiter: str = ",",
) -> None:
    """One file, or files of one kind, added to the JSON lines in ``output``.

    ``kind`` is ``txt``, ``csv``, ``json``, ``jsonl`` or ``parquet``.
    """
    read = {
        "txt": lambda: read_text_files(spark, path),
        "csv": lambda: read_csv_column(spark, path, column, delimiter),
        "json": lambda: read_json(spark, path, column),
        "jsonl": lambda: read_jsonl(spark, path, column),
        "parquet": lambda: read_parquet_column(spark, path, column),
    }
    if kind not in read:
        raise ValueError(f"unknown kind {kind!r}, expected one of {sorted(read)}")
    with temporary_scratch(spark):
        write_jsonl(read[kind](), output, mode="append")


def training_batches(
    df: DataFrame,
    key: str,
    batch_size: int,
    replicas: int = 1,
    shuffle: bool = True,
    drop_last: bool = True,
    seed: int = 42,
    epoch: int = 0,
) -> DataFrame:
    """Add ``replica``, ``sample`` and ``batch_id``: what each replica reads, in order.

    Training shuffles and drops a short last batch; validation reads in key order.
    """
    dealt = distributed_sampler(df, key, replicas, shuffle, seed, epoch)
    dealt = dealt.withColumn("batch_id", div(F.col("sample"), batch_size))
    if not drop_last:
        return dealt
    each = F.ceil(df.agg(F.count("*")).scalar() / replicas).cast("bigint")
    return dealt.filter(F.col("batch_id") < div(each, batch_size))


def place_mixture(
    df: DataFrame,
    weights: Mapping[str, float],
    key: str,
    source: str,
    text: str = "text",
    mode: str = "random",
    seed: int = 42,
    rows: int = BUCKET_ROWS,
    end: int | None = EOS,
) -> DataFrame:
    """``(key, pos, n_tokens)`` of every document that is left after mixing and dedup.

    Mixing, deduplication and numbering see a hash and a length in place of the text,
    a few dozen bytes per document. They look at them more than once, so these are
    written down, and the text is read and hashed once.
    """
    # names of its own, so that no key or source clashes with what mixing adds
    narrow = df.filter(F.col(source).isin(*weights)).select(
        F.col(key).alias("_doc"),
        F.col(source).alias("_source"),
        text_hash(F.col(text)).alias("hash"),
        byte_count(F.col(text), end is not None).alias("n_tokens"),
    )
    mixed = interleave(
        materialize(narrow, "narrow"), weights, "_doc", "_source", mode, seed, rows
    )
    kept = first_of_hash(mixed, "hash", ["mix_key", "mix_index"])
    kept = materialize(kept.select("_doc", "mix_key", "mix_index", "n_tokens"), "kept")
    per_row = TICKS if mode == "random" else 2 / sum(weights.values())
    bucket = F.floor(F.col("mix_key") / (per_row * rows)).cast("bigint")
    ranked = with_rank(kept, ["mix_key", "mix_index"], "pos", bucket=bucket)
    return ranked.select(F.col("_doc").alias(key), "pos", "n_tokens")


def mix_dedup_pack(
    df: DataFrame,
    weights: Mapping[str, float],
    key: str,
    source: str = "source",
    text: str = "text",
    length: int = 4096,
    batch_docs: int = 1000,
    mode: str = "random",
    seed: int = 42,
    drop_short: bool = False,
    rows: int = BUCKET_ROWS,
    tokenizer: Callable[[Column], Column] | None = None,
    end: int | None = EOS,
) -> DataFrame:
    """Weighted mixture, exact dedup over the mixture, tokens, packed batches.

    The places of the documents are worked out and written down first; the texts then
    move twice, once to meet their place and once into their bucket. Tokens are bytes,
    unless ``tokenizer`` makes an ``array<int>`` of the text; it runs once for each
    document that is left, and its ids are written down. ``end`` follows each document.
    """
    places = materialize(
        place_mixture(df, weights, key, source, text, mode, seed, rows, end), "places"
    )
    docs = df.select(key, text).join(places, key)
    if tokenizer is not None:
        ids = materialize(docs.select("pos", tokenizer(F.col(text)).alias("ids")), "ids")
        tokens = ArrayTokens(F.coalesce("ids", F.array().cast("array<int>")), end)
        return pack_batches(ids, tokens, "pos", length, batch_docs, drop_short, rows=rows)
    tokens = ByteTokens(F.col(text), end, size=F.col("n_tokens"))
    return pack_batches(
        docs, tokens, "pos", length, batch_docs, drop_short, rows=rows, sizes=places
    )
