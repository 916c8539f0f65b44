"""From raw documents to packed sequences: five stages, each on all that the one before kept.

Language ID drops what is in no learned language; the n-gram join keeps one document of
each group of near duplicates; decontamination drops documents with a benchmark item;
personal data is replaced by its kind; best-fit packing gives the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm.decontaminate import without_leaks
from weftline.llm.langid import accepted, learn_languages
from weftline.llm.ngram_join import one_of_each
from weftline.llm.pii import redacted
from weftline.llm.queries import packed
from weftline.llm.registry import ship_package, table
from weftline.llm.store import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return accepted(docs, learn_languages(docs))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return redacted(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packed(docs, keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("ngram_join", ngram_join),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("best_fit", best_fit),
]

#: Hash filters, MinHash and packing have no SQL; tests/llm/test_pipeline.py does it by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written down before the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
