"""Registered queries: projections, filters, dedup, mixing, splits, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import json as J
from weftline.functions.text import decode_utf8_ignore, strip
from weftline.functions.text import universal_newlines as newlines
from weftline.operators import counts, dedup, mix, select, split
from weftline.operators.tokens import SPACE, ByteTokens
from weftline.plans.registry import query, table
from weftline.session import materialize, scratch_path

# The same characters as functions.text.WHITESPACE, as a DuckDB expression.
DUCK_WHITESPACE = " || ".join(
    f"chr({c})"
    for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)


def duck_strip(text: str) -> str:
    return f"trim({text}, {DUCK_WHITESPACE})"


# Events as JSON lines: one kind of line per event type. Reads the same in both dialects.
EVENT_LINE = """CASE event_type
    WHEN 'click' THEN '{"text": " click ' || event_id || ' ", "user": ' || user_id || '}'
    WHEN 'view' THEN '{"text": "view ' || event_id || '"} and more'
    WHEN 'signup' THEN '{"text": ' || user_id || '}'
    WHEN 'purchase' THEN '{"text": "  ", "user": ' || user_id || '}'
    ELSE props END"""
EVENT_REASON = """CASE event_type
    WHEN 'click' THEN 'ok' WHEN 'view' THEN 'invalid JSON'
    WHEN 'signup' THEN 'not a string' WHEN 'purchase' THEN 'empty text'
    ELSE 'missing field' END"""
JSON_KINDS = """CASE event_type
    WHEN 'click' THEN '"' || user_id || '"'
    WHEN 'view' THEN '[' || props || ', ' || user_id || ']'
    WHEN 'signup' THEN '' || value
    WHEN 'purchase' THEN props || ']'
    ELSE props END"""

LANG_WEIGHTS = {"en": 5, "fr": 2, "de": 2, "es": 1}
SOURCE_WEIGHTS = {"src0": 3, "src1": 1, "src2": 2, "src3": 1, "src4": 1}


def event_lines(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("line", F.expr(EVENT_LINE))


@query(
    """SELECT 'documents' AS origin, text FROM documents
    UNION ALL SELECT 'conversations', text FROM conversations
    UNION ALL SELECT 'pages', html FROM pages"""
)
def standardize_sources(spark, sf_dir):
    columns = {"documents": "text", "conversations": "text", "pages": "html"}
    return select.union_sources(
        select.standardize(table(spark, sf_dir, name), column).withColumn(
            "origin", F.lit(name)
        )
        for name, column in columns.items()
    )


@query(
    """SELECT origin, count(*) AS n, sum(length(text))::BIGINT AS characters FROM (
    SELECT 'documents' AS origin, text FROM documents
    UNION ALL SELECT 'conversations', text FROM conversations
    UNION ALL SELECT 'benchmark', text FROM benchmark) GROUP BY 1"""
)
def union_sources(spark, sf_dir):
    parts = [
        select.standardize(table(spark, sf_dir, name), "text").withColumn(
            "origin", F.lit(name)
        )
        for name in ("documents", "conversations", "benchmark")
    ]
    return (
        select.union_sources(parts)
        .groupBy("origin")
        .agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("characters"))
    )


@query("SELECT DISTINCT regexp_extract(url, '^[^?#]+') AS path FROM pages ORDER BY path")
def distinct_paths(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return select.distinct_paths(
        pages.select(F.regexp_extract("url", "^[^?#]+", 0).alias("path"))
    )


@query(
    """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    u AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM l)
    SELECT doc_id, row_number() OVER (ORDER BY doc_id, i) AS line_no, line FROM u"""
)
def numbered_lines(spark, sf_dir):
    return select.numbered_lines(table(spark, sf_dir, "documents"), "doc_id")


@query(
    f"""WITH l AS (SELECT {EVENT_LINE} AS line FROM events),
    k AS (SELECT unnest(json_keys(line)) AS field FROM l WHERE json_valid(line))
    SELECT field, count(*) AS n FROM k GROUP BY field"""
)
def field_inventory(spark, sf_dir):
    return select.field_inventory(event_lines(spark, sf_dir), "line")


@query(
    f"""SELECT event_id FROM (SELECT event_id, {EVENT_LINE} AS line FROM events)
    WHERE json_valid(line) AND json_exists(CASE WHEN json_valid(line) THEN line END, '$.text')"""
)
def filter_has_field(spark, sf_dir):
    return select.filter_has_field(event_lines(spark, sf_dir), "line").select("event_id")


@query("SELECT event_id FROM events WHERE event_type IN ('click', 'purchase')")
def filter_string_type(spark, sf_dir):
    return select.filter_string_type(event_lines(spark, sf_dir), "line").select(
        "event_id"
    )


@query(f"SELECT {EVENT_REASON} AS reason, count(*) AS n FROM events GROUP BY 1")
def reject_report(spark, sf_dir):
    from weftline.sources.files import reject_report as report

    return report(event_lines(spark, sf_dir), "line")


@query(
    """SELECT event_id, event_type <> 'purchase' AS ok, CASE event_type
    WHEN 'click' THEN 'string' WHEN 'view' THEN 'array' WHEN 'signup' THEN 'other'
    WHEN 'purchase' THEN 'none' ELSE 'object' END AS kind FROM events"""
)
def json_strict(spark, sf_dir):
    value = J.strict_json(F.expr(JSON_KINDS))
    return table(spark, sf_dir, "events").select(
        "event_id",
        value.isNotNull().alias("ok"),
        F.coalesce(J.json_kind(value), F.lit("none")).alias("kind"),
    )


@query("SELECT doc_id, text FROM documents WHERE lower(coalesce(lang, '')) = 'fr'")
def filter_language(spark, sf_dir):
    docs = select.filter_language(table(spark, sf_dir, "documents"), "FR")
    return docs.select("doc_id", "text")


BLANKED = "CASE WHEN lang = 'es' THEN chr(9) || '  ' || chr(10) WHEN lang <> 'de' THEN text END"


@query("SELECT doc_id, text FROM documents WHERE lang NOT IN ('es', 'de')")
def filter_blank(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(BLANKED).alias("text")
    )
    return select.filter_blank(docs)


@query("SELECT page_id, path FROM (SELECT page_id, regexp_extract(url, '^[^?#]+') AS path FROM pages) WHERE path LIKE '%.html'")
def filter_extension(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", "^[^?#]+", 0).alias("path")
    )
    return select.filter_extension(pages, allowed=[".HTML"])


@query("SELECT doc_id, lang FROM documents")
def require_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return select.require_rows(docs, "no documents")


@query("SELECT doc_id, text FROM documents")
def universal_newlines(spark, sf_dir):
    """Line ends of three kinds."""
    ends = F.element_at(F.array(F.lit("\r\n"), F.lit("\r"), F.lit("\n")), (F.col("doc_id") % 3 + 1).cast("int"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), ends).alias("text"))
    return docs.select("doc_id", newlines(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {duck_strip('text')} AS text FROM documents")
def strip_unicode(spark, sf_dir):
    padded = F.concat(F.lit(" \x1c \t"), "text", F.lit("　\x85\n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", strip(padded).alias("text")
    )


@query("SELECT doc_id, text FROM documents")
def utf8_ignore(spark, sf_dir):
    """Malformed bytes at both ends: a lone lead byte, and bytes that never occur."""
    data = F.concat(
        F.unhex(F.lit("C3")), F.encode("text", "UTF-8"), F.unhex(F.lit("FFE282"))
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", decode_utf8_ignore(data).alias("text")
    )


@query("SELECT page_id, url AS text FROM pages")
def pick_text_column(spark, sf_dir):
    """There is no column ``text``, so the first one after the key is taken."""
    return select.pick_text_column(
        table(spark, sf_dir, "pages"), "text", keep=["page_id"]
    )


@query(
    f"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS pages FROM documents),
    u AS (SELECT doc_id, generate_subscripts(pages, 1) - 1 AS page, unnest(pages) AS text
    FROM l) SELECT doc_id, page::INTEGER AS page, {duck_strip('text')} AS text FROM u
    WHERE {duck_strip('text')} <> ''"""
)
def explode_pages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return select.explode_pages(docs, F.split("text", "\n"), keep=["doc_id"])


@query(
    """SELECT doc_id, md5(text) AS md5 FROM (SELECT *, row_number() OVER (
    PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""
)
def dedup_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup.dedup_exact(docs, "doc_id", late=True).select("doc_id", F.md5("text").alias("md5"))


@query(
    """SELECT doc_id, batch FROM (SELECT doc_id, doc_id % 3 AS batch, row_number() OVER (PARTITION BY md5(text)
    ORDER BY doc_id % 3, doc_id) AS rn FROM documents) WHERE rn = 1"""
)
def seen_store(spark, sf_dir):
    """Three batches, one after the other, against a store of what was seen; a commit runs twice."""
    store = dedup.SeenStore(scratch_path(spark, "seen"), digits=1)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (F.col("doc_id") % 3).alias("batch"))
    kept = []
    for i in range(3):
        new = materialize(store.unseen(docs.filter(F.col("batch") == i), "doc_id").select("doc_id", "batch", "hash"), "unseen")
        for _ in range(2):
            store.add(new, f"batch-{i}")
        kept.append(new.select("doc_id", "batch"))
    return kept[0].union(kept[1]).union(kept[2])


@query(
    """WITH seen AS (SELECT md5(text) AS h FROM documents WHERE lang = 'en')
    SELECT doc_id FROM (SELECT *, row_number() OVER (
    PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents)
    WHERE rn = 1 AND md5(text) NOT IN (SELECT h FROM seen)"""
)
def dedup_incremental(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    seen = dedup.hashes(docs.filter("lang = 'en'"))
    return dedup.dedup_incremental(docs, seen, "doc_id").select("doc_id")


QUOTA_KEY = "(2 * k + 1) / weight::DOUBLE"
# 52 bits of a hash as a number in (0, 1), as a waiting time, added up per source
RANDOM_KEY = """(sum(ceil(-ln((('0x' || substr(md5('42:' || name || ':' || doc_id), 1, 13))
    ::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) / (weight::DOUBLE / {total}.0::DOUBLE)
    * 1048576.0::DOUBLE)::BIGINT) OVER (PARTITION BY name ORDER BY doc_id))::BIGINT"""


def random_sql(column: str, weights: dict[str, int]) -> str:
    return mixture_sql(column, weights, RANDOM_KEY.format(total=sum(weights.values())))


def quota_sql(column: str, weights: dict[str, int]) -> str:
    return mixture_sql(column, weights, QUOTA_KEY)


def mixture_sql(column: str, weights: dict[str, int], mix_key: str) -> str:
    values = ", ".join(f"('{s}', {i}, {w})" for i, (s, w) in enumerate(weights.items()))
    return f"""WITH w(name, idx, weight) AS (VALUES {values}),
    r AS (SELECT doc_id, {column} AS name, row_number() OVER (
        PARTITION BY {column} ORDER BY doc_id) - 1 AS k FROM documents),
    m AS (SELECT r.*, idx, {mix_key} AS mix_key
        FROM r JOIN w USING (name)),
    e AS (SELECT idx, max(mix_key) AS mix_key FROM m GROUP BY idx),
    c AS (SELECT mix_key, idx FROM e ORDER BY mix_key, idx LIMIT 1),
    x AS (SELECT m.* FROM m, c WHERE m.mix_key < c.mix_key
        OR (m.mix_key = c.mix_key AND m.idx <= c.idx))"""


@query(
    quota_sql("lang", LANG_WEIGHTS)
    + """ SELECT doc_id, name AS lang, k,
    row_number() OVER (ORDER BY mix_key, idx) - 1 AS pos FROM x"""
)
def interleave_quota(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    mixed = mix.interleave(docs, LANG_WEIGHTS, "doc_id", "lang", "quota")
    placed = mix.mixture_position(materialize(mixed, "mixed"), LANG_WEIGHTS, "quota")
    return placed.select("doc_id", "lang", "k", "pos")


@query(
    random_sql("lang", LANG_WEIGHTS)
    + """ SELECT doc_id, name AS lang, k,
    row_number() OVER (ORDER BY mix_key, idx) - 1 AS pos FROM x"""
)
def interleave_random(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    mixed = mix.interleave(docs, LANG_WEIGHTS, "doc_id", "lang", "random")
    placed = mix.mixture_position(materialize(mixed, "mixed"), LANG_WEIGHTS, "random")
    return placed.select("doc_id", "lang", "k", "pos")


@query(
    quota_sql("source", SOURCE_WEIGHTS)
    + f""", n AS (SELECT name, count(*) AS n FROM x GROUP BY name)
    SELECT name AS source, n, round(n / (SELECT sum(n) FROM n)::DOUBLE, 9) AS share,
    round(weight / {sum(SOURCE_WEIGHTS.values())}.0::DOUBLE, 9) AS target
    FROM n JOIN w USING (name)"""
)
def mixture_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    mixed = mix.interleave(docs, SOURCE_WEIGHTS, "doc_id", "source", "quota")
    report = mix.mixture_report(mixed, SOURCE_WEIGHTS)
    return report.select(
        "source", "n", F.round("share", 9).alias("share"), F.round("target", 9).alias("target")
    )


SPLIT_SQL = """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id)
    <= floor((SELECT count(*) FROM documents) * 0.9::DOUBLE) THEN 'train' ELSE 'val' END
    AS split FROM documents"""


@query(SPLIT_SQL)
def split_sequential(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return split.split_sequential(docs, "doc_id", 0.9)


@query(f"SELECT split, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY split")
def split_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return counts.split_counts(split.split_sequential(docs, "doc_id", 0.9))


@query(
    """SELECT doc_id, text FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS r
    FROM documents) WHERE r % 4 = 1"""
)
def shard_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split.shard_rows(docs, "doc_id", 4, 1)


@query(
    """SELECT url, page_id FROM (SELECT *, row_number() OVER (ORDER BY url, page_id) - 1 AS r
    FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)) WHERE r % 3 = 2"""
)
def shard_by_url(spark, sf_dir):
    """Keys that are strings."""
    pages = table(spark, sf_dir, "pages").groupBy("url").agg(F.min("page_id").alias("page_id"))
    return split.shard_rows(pages, "url", 3, 2)


@query(
    """SELECT url, count(*) AS n FROM (SELECT nullif(source, 'src_7') AS url,
    row_number() OVER (ORDER BY nullif(source, 'src_7') NULLS FIRST) - 1 AS r FROM documents)
    WHERE r % 3 = 2 GROUP BY url"""
)
def shard_by_source(spark, sf_dir):
    """String keys that repeat, some of them null: every row is in one shard."""
    key = F.nullif("source", F.lit("src_7")).alias("url")
    docs = table(spark, sf_dir, "documents").select(key, "doc_id")
    return split.shard_rows(docs, "url", 3, 2).groupBy("url").agg(F.count("*").alias("n"))


@query(
    """WITH h AS (SELECT CASE WHEN lang <> 'fr' THEN ('0x' || substr(md5(lang || source), 1, 15))::BIGINT END
        AS h FROM documents)
    SELECT h, split, count(*) AS n FROM (SELECT h, CASE WHEN row_number() OVER (ORDER BY h NULLS FIRST)
    <= floor((SELECT count(*) FROM documents) * 0.6::DOUBLE) THEN 'train' ELSE 'val' END
    AS split FROM h) GROUP BY ALL"""
)
def split_by_repeats(spark, sf_dir):
    """Keys far apart that repeat, some of them null: the split has the exact number of rows."""
    digest = F.md5(F.concat("lang", "source"))
    h = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    docs = table(spark, sf_dir, "documents").select(F.when(F.col("lang") != "fr", h).alias("h"), "doc_id")
    return split.split_sequential(docs, "h", 0.6).groupBy("h", "split").agg(F.count("*").alias("n"))


@query(
    """WITH h AS (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h
        FROM documents)
    SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY h)
    <= floor((SELECT count(*) FROM documents) * 0.9::DOUBLE) THEN 'train' ELSE 'val' END
    AS split FROM h"""
)
def split_by_hash(spark, sf_dir):
    """Keys that are numbers far apart."""
    digest = F.md5(F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("h")
    )
    return split.split_sequential(docs, "h", 0.9).select("doc_id", "split")


@query(
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:0:' || doc_id), doc_id)
        - 1 AS r FROM documents), n AS (SELECT count(*) AS n FROM documents)
    SELECT doc_id, (p % 7)::INTEGER AS replica, p // 7 AS sample FROM (
        SELECT doc_id, unnest(range(r, ((n + 6) // 7) * 7, n)) AS p FROM r, n)"""
)
def distributed_sampler(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return split.distributed_sampler(docs, "doc_id", 7)


@query(
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:2:' || doc_id), doc_id)
        - 1 AS r FROM documents), n AS (SELECT count(*) AS n FROM documents),
    d AS (SELECT doc_id, (p % 3)::INTEGER AS replica, p // 3 AS sample, (n + 2) // 3 AS each
        FROM (SELECT doc_id, n, unnest(range(r, ((n + 2) // 3) * 3, n)) AS p FROM r, n))
    SELECT doc_id, replica, sample, sample // 16 AS batch_id FROM d
    WHERE sample // 16 < each // 16"""
)
def training_batches(spark, sf_dir):
    from weftline.plans.prepare import training_batches as batches

    docs = table(spark, sf_dir, "documents").select("doc_id")
    return batches(docs, "doc_id", 16, replicas=3, epoch=2)


@query(
    """SELECT doc_id, row_number() OVER (ORDER BY md5('42:1:' || doc_id), doc_id) - 1 AS rank
    FROM documents"""
)
def shuffle_epoch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return split.shuffle_epoch(docs, "doc_id", 42, 1)


@query(
    """SELECT doc_id, r // 48 AS batch_id FROM (SELECT doc_id, row_number() OVER (
        ORDER BY md5('42:0:' || doc_id), doc_id) - 1 AS r FROM documents)
    WHERE r // 48 < (SELECT count(*) FROM documents) // 48"""
)
def batch_drop_last(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    ranked = split.shuffle_epoch(docs, "doc_id")
    return split.batches(ranked, 48, True).select("doc_id", "batch_id")


@query(
    """SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 48 AS batch_id
    FROM documents"""
)
def batch_keep_last(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    ranked = split.with_rank(docs, "doc_id")
    return split.batches(ranked, 48, False).select("doc_id", "batch_id")


@query(
    """SELECT n AS rows, n // 8 AS batches, n // 8 * 3 AS micro_steps,
    n // 8 // 4 * 3 AS optimizer_steps FROM (SELECT count(*) AS n FROM documents)"""
)
def training_plan(spark, sf_dir):
    return counts.training_plan(table(spark, sf_dir, "documents"), 8, 3, 4)


@query(
    """SELECT source AS path, count(*) AS n, grouping(source)::INTEGER AS is_total
    FROM documents GROUP BY ROLLUP (source)"""
)
def doc_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("source", "path")
    return counts.doc_counts(docs).withColumn("is_total", F.col("is_total").cast("int"))


@query(
    """SELECT n AS documents, c + n - 1 AS characters, t + n - 1 AS tokens,
    CASE WHEN t + n - 1 >= 2048 THEN (t + n - 1 - 2048) // 2048 + 1 ELSE 0 END AS examples
    FROM (SELECT count(*) AS n, sum(length(text))::BIGINT AS c,
    sum(octet_length(encode(text)))::BIGINT AS t FROM documents)"""
)
def corpus_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return counts.corpus_stats(docs, ByteTokens(F.col("text"), SPACE), 2048)
