"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import secret_scan
from weftline.llm.blocks import remainder
from weftline.llm.collocations import collocations
from weftline.llm.decontaminate import find_leaks
from weftline.llm.html_main import extract, learn_weights
from weftline.llm.langid import identify, learn_languages
from weftline.llm.lm_score import score
from weftline.llm.ngram_join import near_duplicates
from weftline.llm.packing import MOST_PIECES, cut_pieces, pack
from weftline.llm.pii import digest
from weftline.llm.quality import learn_quality, score_quality
from weftline.llm.registry import query, table
from weftline.llm.spelling import frequent, typed_words, variants
from weftline.llm.store import written
from weftline.llm.topk_search import top_k
from weftline.llm.toxicity import learn_toxicity, score_toxicity


def held_out(divisor: int, rest: int) -> Column:
    return (remainder("doc_id", divisor) == rest).alias("held_out")


def predicted() -> Column:
    return (F.col("score") >= 0.7).cast("int").alias("predicted")


def labelled(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Documents with their label; repeated label rows count once."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(label).alias("label"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")


@query()
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


@query()
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_toxicity(labelled(spark, sf_dir, "toxic").where(remainder("doc_id", 3) != 1))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out(3, 1), "score", predicted(), "toxic_tokens", "offsets")


@query()
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@query("""
    WITH held AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
        FROM held q JOIN held c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_quality(labelled(spark, sf_dir, "quality").where(remainder("doc_id", 4) != 2))
    return score_quality(docs, model).select("doc_id", held_out(4, 2), "score", predicted())


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs.where(remainder("doc_id", 3) != 1))
    return identify(docs, model).select("doc_id", held_out(3, 1), "lang_pred", "score", "coverage")


@query()
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


@query()
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame, keep_ids: bool = False) -> DataFrame:
    # written once: the number of groups needs a count, and tokens are dear
    pieces = written(cut_pieces(docs, keep_ids=keep_ids).withColumnRenamed("part", "piece"), "pieces")
    return pack(pieces, most_pieces=MOST_PIECES, columns=("doc_id", "piece", "start", "ids_crc32"))


@query()
def op11_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn_weights(pages))


@query()
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(frequent(typed_words(table(spark, sf_dir, "documents"))))


@query("""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    ), words AS (
        SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
    ), one AS (
        SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM words) GROUP BY ALL
    ), two AS (
        SELECT lang, g[1] AS x, g[2] AS y, count(*) AS f
        FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) AS g FROM words) GROUP BY ALL
    ), three AS (
        SELECT lang, g[1] AS x, g[2] AS y, g[3] AS z, count(*) AS f
        FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS g FROM words)
        GROUP BY ALL HAVING count(*) >= 10
    ), longer AS (
        SELECT lang, x, y, max(f) AS f
        FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY ALL
    ), cuts AS (
        SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, p.f AS l, q.f AS r, 1 AS k
        FROM two c JOIN one p ON c.lang = p.lang AND c.x = p.x JOIN one q ON c.lang = q.lang AND c.y = q.x
        LEFT JOIN longer o ON c.lang = o.lang AND c.x = o.x AND c.y = o.y
        WHERE c.f >= 10 AND (o.f IS NULL OR 100 * o.f < 50 * c.f)
        UNION ALL
        SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, p.f, q.f, 1
        FROM three c JOIN one p ON c.lang = p.lang AND c.x = p.x JOIN two q ON c.lang = q.lang AND c.y = q.x AND c.z = q.y
        UNION ALL
        SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, p.f, q.f, 2
        FROM three c JOIN two p ON c.lang = p.lang AND c.x = p.x AND c.y = p.y JOIN one q ON c.lang = q.lang AND c.z = q.x
    ), scored AS (
        SELECT *, CAST((CAST(a AS HUGEINT) * a * 1000000) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
    ), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
