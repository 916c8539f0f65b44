"""Text to token ids and back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from weftline.operators.ranks import dense_position

# Byte scheme: ids 0-255 are the UTF-8 bytes.
EOS = 256
PAD = 257
SPACE = 32

# What a broadcast vocabulary may hold: 32 MB of words at most.
BROADCAST_WORDS = 250_000
BROADCAST_WORD_BYTES = 128

# Blocks of rows to a partition of a shuffle.
BLOCKS = 16

# Ids that a Python tokenizer gathers before they leave the worker.
ENCODED_IDS = 1 << 20


def byte_tokens(text: Column) -> Column:
    """The UTF-8 bytes of the text as ``array<int>``, in the JVM.

    Read as ISO-8859-1 each byte is one character, whose code point is the byte.
    """
    chars = F.split(F.decode(text.cast("binary"), "ISO-8859-1"), "")
    ids = F.transform(chars, lambda c: F.ascii(c))
    return F.when(F.octet_length(text) == 0, F.array().cast("array<int>")).otherwise(ids)


def tokenize_bytes(text: Column) -> Column:
    """Byte ids with the end marker that separates documents."""
    return F.concat(byte_tokens(text), F.array(F.lit(EOS)))


def byte_count(text: Column, end_marker: bool = True) -> Column:
    """The number of tokens, without making them."""
    return F.octet_length(text).cast("bigint") + int(end_marker)


def detokenize_bytes(ids: Column) -> Column:
    """Byte ids to text; special ids are skipped, bytes cut mid-character repaired."""
    chars = F.transform(F.filter(ids, lambda t: t < 256), lambda t: F.char(t))
    data = F.encode(F.array_join(chars, ""), "ISO-8859-1")
    return F.make_valid_utf8(data.cast("string"))


Cut = Callable[[Column, Column], Column]


class Tokens:
    """The tokens of a row as packing needs them: counted, cut and joined.

    ``end`` is the id put after each document, None for none.
    """

    end: int | None

    def count(self) -> Column:
        """Tokens of the row, end marker included."""
        raise NotImplementedError

    def per_block(
        self, numbers: Column, part: Callable[[Column, Cut], Column]
    ) -> Column:
        """``part(k, cut)`` for each block number, where ``cut(offset, size)`` is a
        piece of the row's tokens."""
        raise NotImplementedError

    def join(self, pieces: Column) -> Column:
        """An array of pieces to ``array<int>``."""
        raise NotImplementedError


class ByteTokens(Tokens):
    """The byte scheme, cut and joined as text; ids are made once, per packed row.

    A piece is a string whose code points are the ids, so moving pieces about costs
    what moving the text costs.
    """

    def __init__(
        self, text: Column, end: int | None = EOS, size: Column | None = None
    ):
        """``size`` is the token count, for rows that already carry it."""
        self.text, self.end, self.size = text, end, size

    def count(self) -> Column:
        if self.size is not None:
            return self.size
        return byte_count(self.text, self.end is not None)

    def per_block(self, numbers, part):
        data = self.text.cast("binary")
        end = F.lit("" if self.end is None else chr(self.end))

        def cut(offset: Column, size: Column) -> Column:
            piece = F.decode(F.substring(data, offset + 1, size), "ISO-8859-1")
            at_end = offset + size > F.octet_length(self.text)
            return F.concat(piece, F.when(at_end, end).otherwise(""))

        return F.transform(numbers, lambda k: part(k, cut))

    def join(self, pieces):
        return F.transform(
            F.split(F.array_join(pieces, ""), ""), lambda c: F.ascii(c)
        )


class ArrayTokens(Tokens):
    """Any ``array<int>`` column, such as the output of a tokenizer."""

    def __init__(self, ids: Column, end: int | None = None):
        self.ids, self.end = ids, end

    def count(self) -> Column:
        return F.size(self.ids).cast("bigint") + int(self.end is not None)

    def per_block(self, numbers, part):
        ids = self.ids
        if self.end is not None:
            ids = F.concat(ids, F.array(F.lit(self.end)))

        def blocks(bound: Column) -> Column:
            def cut(offset: Column, size: Column) -> Column:
                return F.slice(bound, offset + 1, size)

            return F.transform(numbers, lambda k: part(k, cut))

        # the outer function only binds the ids to a name; written out inside the
        # inner one they would be made again for every block
        return F.transform(F.array(ids), blocks)[0]

    def join(self, pieces):
        return F.flatten(pieces)


def pad_id(pad: int | None, eos: int) -> int:
    """A tokenizer without a padding id pads with its end marker."""
    return eos if pad is None else pad


def truncate_pad(
    df: DataFrame,
    ids: str,
    length: int,
    pad: int | None = PAD,
    eos: int = EOS,
    mask_label: int | None = None,
) -> DataFrame:
    """Cut and pad ``ids`` to ``length``: ``input_ids``, ``attention_mask``, ``labels``.

    ``labels`` equal ``input_ids``; with ``mask_label`` padding gets that value.
    """
    kept = F.slice(ids, 1, length)
    used = F.size(kept)
    filler = F.lit(length) - used

    def padded(values: Column, fill: int) -> Column:
        return F.concat(values, F.array_repeat(F.lit(fill), filler))

    pad = pad_id(pad, eos)
    return df.select(
        *[c for c in df.columns if c != ids],
        padded(kept, pad).alias("input_ids"),
        padded(F.array_repeat(F.lit(1), used), 0).alias("attention_mask"),
        padded(kept, pad if mask_label is None else mask_label).alias("labels"),
    )


def tokenizer_udf(load: Callable[[], Callable[[str], list[int]]]):
    """A column function for any Python tokenizer.

    ``load`` builds the tokenizer and runs once per task, so a large model is not
    pickled with the plan; texts come in Arrow batches. Ids leave as soon as there are
    ``ENCODED_IDS`` of them, so that memory does not depend on the texts of a batch.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = load()
        for texts in batches:
            held, ends, size = [], [0], 0
            for text in texts:
                ids = tokenizer(text.as_py()) if text.is_valid else None
                ids = None if ids is None else np.asarray(ids, np.int32)
                held.append(ids)
                size += 0 if ids is None else len(ids)
                ends.append(size)
                if size >= ENCODED_IDS:
                    yield _id_lists(held, ends)
                    held, ends, size = [], [0], 0
            if held:
                yield _id_lists(held, ends)

    return encode


def _id_lists(held: list[np.ndarray | None], ends: list[int]) -> pa.Array:
    ids = [a for a in held if a is not None]
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    nulls = pa.array([a is None for a in held])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()), mask=nulls)


def words_of(text: Column) -> Column:
    return F.split(text, " ")


def build_vocab(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n, id)`` with ids by falling count, then by word.

    Counting combines before the shuffle, so frequent words are not hot. Half of a
    vocabulary has the same count, one; ids come from ``dense_position``, whose range
    partitions on ``(count, word)`` split such a run.
    """
    counts = (
        df.select(F.explode(words_of(F.col(text))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    return dense_position(counts, [F.col("n").desc(), F.col("word")], "id")


def _answered(
    dealt: DataFrame, asked: Column, vocab: DataFrame, key: str, on: str, value: str, broadcast_words: int
) -> DataFrame:
    """``(_asked, on, value)`` for the different words that a block of ``dealt`` has and ``vocab`` knows.

    The most frequent words (the lowest ids) of ordinary length are broadcast, which
    bounds that table whatever the vocabulary's size. Only what is not among them is
    joined by a shuffle; a word is asked for once in a block, so no join key is hot.
    """
    # the key is counted, and empty rows are kept, so that the rows are shuffled as they are and once for both uses
    words = dealt.select("_block", key, F.explode_outer(asked).alias(on))
    words = words.groupBy("_block", on).agg(F.count(key).alias("_n")).filter("_n >= 0")
    words = words.select(F.col("_block").alias("_asked"), on)
    in_head = (F.col("id") < broadcast_words) & (
        F.octet_length("word") <= BROADCAST_WORD_BYTES
    )
    head = vocab.filter(in_head).select(on, value)
    rest = vocab.filter(~in_head).select(on, value)
    looked_up = words.join(F.broadcast(head), on, "left")
    found = looked_up.filter(F.col(value).isNotNull())
    if rest.isEmpty():
        return found
    others = looked_up.filter(F.col(value).isNull()).drop(value)
    return found.unionByName(others.join(rest, on))


def _dealt(df: DataFrame) -> DataFrame:
    """Rows dealt to blocks, of which a task holds one at a time."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64(*df.columns), F.lit(parts * BLOCKS)).cast("int")
    return df.withColumn("_block", block).repartition("_block")


def _replaced(lists: pa.Array, known: pa.Array, values: pa.Array, unknown: int | None = None) -> pa.ListArray:
    """Lists with the value of each element that is known; others are ``unknown`` or left out."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    found = pc.take(values, pc.index_in(lists.flatten(), value_set=known))
    if unknown is not None:
        found = pc.fill_null(found, pa.scalar(unknown, found.type))
    kept = np.concatenate([[0], np.cumsum(found.is_valid().to_numpy(zero_copy_only=False), dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(kept[ends], pa.int32()), found.drop_null())


def tokenize_vocab(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    text: str = "text",
    unknown: int | None = None,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """``(key, ids)`` by looking every word up in ``vocab`` (a written table, best).

    Words that are not there get ``unknown``, or are left out when it is None. A null text
    has no ids. Every row has a row, also where keys repeat.
    """
    # the texts move once, to their block; of the words only the different ones of a block move
    dealt = _dealt(df.select(F.col(key), F.col(text)))
    vocab = vocab.withColumn("id", F.col("id").cast("int"))
    answers = _answered(dealt, words_of(F.col(text)), vocab, key, "word", "id", broadcast_words)

    def code(rows: pa.Table, known: pa.Table) -> pa.Table:
        words = pc.split_pattern(rows.column(text).combine_chunks(), " ")
        ids = _replaced(words, known.column("word").combine_chunks(), known.column("id").combine_chunks(), unknown)
        return pa.table({key: rows.column(key), "ids": ids})

    schema = StructType([df.schema[key], StructField("ids", ArrayType(IntegerType()))])
    return dealt.groupBy("_block").cogroup(answers.groupBy("_asked")).applyInArrow(code, schema)


def detokenize_vocab(
    df: DataFrame, vocab: DataFrame, key: str, broadcast_words: int = BROADCAST_WORDS
) -> DataFrame:
    """``(key, text)`` from ``(key, ids)``; ids that are not in ``vocab`` are skipped.

    No ids give an empty text. Every row has a row, also where keys repeat.
    """
    dealt = _dealt(df.select(key, F.col("ids").cast("array<int>").alias("ids")))
    vocab = vocab.withColumn("id", F.col("id").cast("int"))
    answers = _answered(dealt, F.col("ids"), vocab, key, "id", "word", broadcast_words)

    def spell(rows: pa.Table, known: pa.Table) -> pa.Table:
        words = _replaced(rows.column("ids").combine_chunks(), known.column("id").combine_chunks(), known.column("word").combine_chunks())
        return pa.table({key: rows.column(key), "text": pc.binary_join(words, " ")})

    schema = StructType([df.schema[key], StructField("text", StringType())])
    return dealt.groupBy("_block").cogroup(answers.groupBy("_asked")).applyInArrow(spell, schema)
