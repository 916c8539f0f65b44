"""Registered queries: tokenizing and packing."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.operators import mapping, pack, split, tokens
from weftline.operators.ranks import with_rank
from weftline.plans import prepare
from weftline.plans.corpus_queries import LANG_WEIGHTS, quota_sql
from weftline.plans.registry import query, table
from weftline.session import materialize

LENGTH = 1024
BATCH_DOCS = 64


def ids_md5(ids: Column) -> Column:
    """A checksum of token ids that both engines can make."""
    return F.md5(F.array_join(ids.cast("array<string>"), " "))


# The byte tokens of ``text`` in SQL, as a list of hex numbers with an end marker.
def duck_tokens(end: str) -> str:
    return f"list_append(regexp_extract_all(hex(encode(text)), '..'), '{end}')"


def duck_md5(tokens: str) -> str:
    numbers = f"list_transform({tokens}, lambda t: ('0x' || t)::INTEGER::VARCHAR)"
    return f"md5(array_to_string({numbers}, ' '))"


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query(
    f"""SELECT doc_id, octet_length(encode(text)) + 1 AS n,
    {duck_md5(duck_tokens('100'))} AS ids FROM documents"""
)
def tokenize_bytes(spark, sf_dir):
    ids = documents(spark, sf_dir).select(
        "doc_id", tokens.tokenize_bytes(F.col("text")).alias("ids")
    )
    return ids.select(
        "doc_id", F.size("ids").cast("bigint").alias("n"), ids_md5(F.col("ids")).alias("ids")
    )


@query("SELECT doc_id, text FROM documents")
def detokenize(spark, sf_dir):
    ids = tokens.tokenize_bytes(F.col("text"))
    return documents(spark, sf_dir).select(
        "doc_id", tokens.detokenize_bytes(ids).alias("text")
    )


PADDED_SQL = f"""SELECT doc_id,
    {duck_md5(f"list_resize({duck_tokens('100')}, 2048, '101')")} AS ids, least(octet_length(encode(text)) + 1, 2048)::BIGINT AS used FROM documents"""


def padded_summary(df):
    used = F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m)
    return df.select(
        "doc_id", ids_md5(F.col("input_ids")).alias("ids"), used.cast("bigint").alias("used")
    )


@query(
    f"""WITH rows AS ({PADDED_SQL}), placed AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM rows),
    size AS (SELECT doc_id, octet_length(encode(text)) AS n FROM documents)
    SELECT r // 16 AS batch_id, count(*) FILTER (n >= 300) AS rows,
    coalesce(string_agg(ids, ',' ORDER BY doc_id) FILTER (n >= 300), '') AS ids,
    coalesce(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (n < 300), '') AS short
    FROM placed JOIN size USING (doc_id) GROUP BY r // 16"""
)
def collate_batches(spark, sf_dir):
    """Batches of 16 documents stacked at one width; short ones are named, not stacked."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ids = tokens.truncate_pad(docs.withColumn("ids", tokens.tokenize_bytes(F.col("text"))), "ids", 2048)
    short = F.octet_length("text") < 300
    ids = ids.withColumn("labels", F.when(short, F.slice("labels", 1, 7)).otherwise(F.col("labels")))
    batched = split.batches(with_rank(ids, "doc_id"), 16, drop_last=False)
    stacked = mapping.stack_batches(batched, 2048, "doc_id", order=["doc_id"])
    return stacked.select(
        "batch_id",
        "rows",
        F.array_join(F.transform("input_ids", ids_md5), ",").alias("ids"),
        F.array_join(F.col("short").cast("array<string>"), ",").alias("short"),
    )


@query(PADDED_SQL)
def truncate_pad(spark, sf_dir):
    ids = documents(spark, sf_dir).select(
        "doc_id", tokens.tokenize_bytes(F.col("text")).alias("ids")
    )
    return padded_summary(tokens.truncate_pad(ids, "ids", 2048))


def byte_tokenizer():
    return lambda text: list(text.encode("utf-8"))


@query(
    f"""SELECT doc_id, octet_length(encode(text))::BIGINT AS n,
    {duck_md5("regexp_extract_all(hex(encode(text)), '..')")} AS ids FROM documents"""
)
def tokenize_udf(spark, sf_dir):
    """A Python tokenizer: here one that gives the UTF-8 bytes."""
    encode = tokens.tokenizer_udf(byte_tokenizer)
    ids = documents(spark, sf_dir).select("doc_id", encode("text").alias("ids"))
    return ids.select(
        "doc_id", F.size("ids").cast("bigint").alias("n"), ids_md5(F.col("ids")).alias("ids")
    )


VOCAB_SQL = """WITH words AS (SELECT doc_id, string_split(text, ' ') AS l FROM documents),
    u AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS i FROM words),
    c AS (SELECT word, count(*) AS n FROM u GROUP BY word),
    v AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS id FROM c)"""


@query(VOCAB_SQL + " SELECT word, n, id FROM v")
def build_vocab(spark, sf_dir):
    return tokens.build_vocab(documents(spark, sf_dir))


@query(
    VOCAB_SQL
    + """ SELECT doc_id, count(*) AS n, md5(string_agg(id::VARCHAR, ' ' ORDER BY i)) AS ids
    FROM u JOIN v USING (word) GROUP BY doc_id"""
)
def tokenize_vocab(spark, sf_dir):
    docs = documents(spark, sf_dir)
    vocab = materialize(tokens.build_vocab(docs), "vocab")
    # few enough that the looked-up words do not all fit the broadcast
    return tokens.tokenize_vocab(docs, vocab, "doc_id", broadcast_words=1000).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n"),
        ids_md5(F.col("ids")).alias("ids"),
    )


@query("SELECT doc_id, text FROM documents")
def detokenize_vocab(spark, sf_dir):
    docs = documents(spark, sf_dir)
    vocab = materialize(tokens.build_vocab(docs), "vocab")
    ids = tokens.tokenize_vocab(docs, vocab, "doc_id")
    return tokens.detokenize_vocab(ids, vocab, "doc_id", broadcast_words=1000)


def batch_sql(documents_cte: str, length: int = LENGTH) -> str:
    """Token by token: ``documents_cte`` defines ``d(rank, text)``."""
    return f"""{documents_cte},
    l AS (SELECT rank, {duck_tokens('100')} AS l FROM d),
    t AS (SELECT rank, unnest(l) AS tok, generate_subscripts(l, 1) AS i FROM l),
    p AS (SELECT rank // {BATCH_DOCS} AS batch_id, tok, row_number() OVER (
        PARTITION BY rank // {BATCH_DOCS} ORDER BY rank, i) - 1 AS p FROM t),
    s AS (SELECT batch_id, count(*) AS total FROM p GROUP BY batch_id)
    SELECT batch_id, p // {length} AS block, count(*) AS n,
    md5(string_agg(('0x' || tok)::INTEGER::VARCHAR, ' ' ORDER BY p)) AS ids FROM p JOIN s USING (batch_id)
    WHERE total < {length} OR p < total // {length} * {length}
    GROUP BY batch_id, p // {length}"""


DOCS_BY_ID = """WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS rank, text
    FROM documents)"""
PACK_BATCHES_SQL = batch_sql(DOCS_BY_ID)


def packed_summary(df):
    return df.select(
        "batch_id",
        "block",
        F.size("input_ids").cast("bigint").alias("n"),
        ids_md5(F.col("input_ids")).alias("ids"),
    )


def packed_batches(spark, sf_dir):
    return pack.pack_batches(
        documents(spark, sf_dir), tokens.ByteTokens(F.col("text")), "doc_id", LENGTH, BATCH_DOCS
    )


@query(PACK_BATCHES_SQL)
def pack_udf(spark, sf_dir):
    """Ids of a Python tokenizer, made once for each document and written down."""
    encode = tokens.tokenizer_udf(byte_tokenizer)
    ids = documents(spark, sf_dir).select("doc_id", encode("text").alias("ids"))
    packed = pack.pack_batches(
        materialize(ids, "ids"), tokens.ArrayTokens(F.col("ids"), tokens.EOS), "doc_id", LENGTH, BATCH_DOCS
    )
    return packed_summary(packed)


@query(PACK_BATCHES_SQL)
def pack_batches(spark, sf_dir):
    return packed_summary(packed_batches(spark, sf_dir))


CORPUS_TOKENS = f"""WITH l AS (SELECT doc_id, {duck_tokens('20')} AS l FROM documents),
    t AS (SELECT doc_id, unnest(l) AS tok, generate_subscripts(l, 1) AS i FROM l),
    p AS (SELECT tok, row_number() OVER (ORDER BY doc_id, i) - 1 AS p FROM t),
    s AS (SELECT count(*) - 1 AS total FROM p)"""


def corpus_sql(length: int, stride: int) -> str:
    return f"""{CORPUS_TOKENS},
    w AS (SELECT unnest(range(greatest(0, (p - {length} + {stride}) // {stride}),
        p // {stride} + 1)) AS seq_id, p, tok, total FROM p, s WHERE p < total)
    SELECT seq_id, md5(string_agg(('0x' || tok)::INTEGER::VARCHAR, ' ' ORDER BY p)) AS ids FROM w
    WHERE seq_id * {stride} + {length} <= total AND p >= seq_id * {stride}
    AND p < seq_id * {stride} + {length} GROUP BY seq_id"""


def packed_corpus(spark, sf_dir, stride):
    packed = pack.pack_corpus(
        documents(spark, sf_dir),
        tokens.ByteTokens(F.col("text"), tokens.SPACE),
        "doc_id",
        LENGTH,
        stride,
    )
    return packed.select("seq_id", ids_md5(F.col("input_ids")).alias("ids"))


@query(corpus_sql(LENGTH, LENGTH))
def pack_concat(spark, sf_dir):
    return packed_corpus(spark, sf_dir, None)


@query(corpus_sql(LENGTH, 640))
def pack_stride(spark, sf_dir):
    return packed_corpus(spark, sf_dir, 640)


@query(
    VOCAB_SQL
    + f""", p AS (SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS p
        FROM u JOIN v USING (word))
    SELECT p // {LENGTH} AS seq_id, md5(string_agg(id::VARCHAR, ' ' ORDER BY p)) AS ids
    FROM p WHERE p < (SELECT count(*) FROM p) // {LENGTH} * {LENGTH} GROUP BY 1"""
)
def pack_vocab(spark, sf_dir):
    """Corpus packing of a token array: words joined by spaces need no separator."""
    docs = documents(spark, sf_dir)
    vocab = materialize(tokens.build_vocab(docs), "vocab")
    ids = materialize(tokens.tokenize_vocab(docs, vocab, "doc_id"), "ids")
    packed = pack.pack_corpus(ids, tokens.ArrayTokens(F.col("ids")), "doc_id", LENGTH)
    return packed.select("seq_id", ids_md5(F.col("input_ids")).alias("ids"))


@query(
    f"""WITH b AS ({PACK_BATCHES_SQL})
    SELECT count(*) AS rows, count(*) FILTER (n <> {LENGTH} OR block % 10 = 3) AS bad_input_ids,
    count(*) FILTER (n <> {LENGTH} OR block % 7 = 2) AS bad_labels,
    count(*) FILTER (block % 10 = 3 OR block % 7 = 2) AS unequal FROM b"""
)
def check_packed(spark, sf_dir):
    """Some rows lack their last id, others have no labels."""
    packed = packed_batches(spark, sf_dir).withColumns({
        "input_ids": F.when(
            F.col("block") % 10 == 3, F.slice("input_ids", 1, F.size("input_ids") - 1)
        ).otherwise(F.col("input_ids")),
        "labels": F.when(F.col("block") % 7 != 2, F.col("labels")),
    })
    return pack.check_packed(packed, LENGTH)


MIX_SQL = batch_sql(
    quota_sql("lang", LANG_WEIGHTS)
    + """, f AS (SELECT x.*, row_number() OVER (
            PARTITION BY md5(text) ORDER BY mix_key, idx) AS rn, text
            FROM x JOIN documents USING (doc_id)),
        d AS (SELECT row_number() OVER (ORDER BY mix_key, idx) - 1 AS rank, text
            FROM f WHERE rn = 1)"""
)


@query(MIX_SQL)
def mix_dedup_pack(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packed_summary(
        prepare.mix_dedup_pack(
            docs, LANG_WEIGHTS, "doc_id", "lang", length=LENGTH, batch_docs=BATCH_DOCS,
            mode="quota",
        )
    )


@query(MIX_SQL)
def mix_dedup_pack_udf(spark, sf_dir):
    """The same job with a Python tokenizer, which here gives the same ids."""
    docs = table(spark, sf_dir, "documents")
    return packed_summary(
        prepare.mix_dedup_pack(
            docs, LANG_WEIGHTS, "doc_id", "lang", length=LENGTH, batch_docs=BATCH_DOCS,
            mode="quota", tokenizer=tokens.tokenizer_udf(byte_tokenizer),
        )
    )


@query("SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents")
def map_batches(spark, sf_dir):
    """A Python function that makes rows of lines."""
    return mapping.map_batches(documents(spark, sf_dir), split_lines, "doc_id long, line string")


def split_lines():
    def split(batch):
        rows = [
            (key, line)
            for key, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True)
            for line in (text or "").split("\n")
        ]
        yield pa.RecordBatch.from_pylist(
            [{"doc_id": key, "line": line} for key, line in rows],
            pa.schema([("doc_id", pa.int64()), ("line", pa.string())]),
        )

    return split


@query(PADDED_SQL.replace("'101'", "'100'"))
def pad_with_end(spark, sf_dir):
    """A tokenizer without a padding id pads with its end marker."""
    ids = documents(spark, sf_dir).select(
        "doc_id", tokens.tokenize_bytes(F.col("text")).alias("ids")
    )
    return padded_summary(tokens.truncate_pad(ids, "ids", 2048, pad=None))
