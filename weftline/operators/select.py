"""Projections, filters and unions over text tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import json as J
from weftline.functions.text import has_text, strip, suffix
from weftline.operators.ranks import BUCKET_ROWS, with_running

# The file types that are read, with their spellings.
TEXT_SUFFIXES = (".txt",)
CSV_SUFFIXES = (".csv",)
JSON_SUFFIXES = (".json", ".jsonl")
PARQUET_SUFFIXES = (".parquet", ".pq")
SHEET_SUFFIXES = (".xlsx", ".xls")
PAGED_SUFFIXES = (".pdf",)
SUFFIXES = (
    TEXT_SUFFIXES
    + CSV_SUFFIXES
    + JSON_SUFFIXES
    + PARQUET_SUFFIXES
    + SHEET_SUFFIXES
    + PAGED_SUFFIXES
)


def standardize(df: DataFrame, column: str, keep: Iterable[str] = ()) -> DataFrame:
    """Keep one column as ``text``, with the key columns named in ``keep``."""
    return df.select(*keep, F.col(column).alias("text"))


def filter_language(df: DataFrame, language: str, column: str = "lang") -> DataFrame:
    """Rows in one language, case ignored; a missing value is no language.

    For Parquet written with lower-case values, ``df.filter(df.lang == ...)`` is
    better: the scan can use it to skip row groups.
    """
    return df.filter(F.lower(F.coalesce(F.col(column), F.lit(""))) == language.lower())


def filter_blank(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop rows with null or white-space text; the text itself is left as it is."""
    return df.filter(has_text(F.col(text)))


def filter_extension(
    df: DataFrame, path: str = "path", allowed: Iterable[str] = SUFFIXES
) -> DataFrame:
    return df.filter(suffix(F.col(path)).isin(*[a.lower() for a in allowed]))


def filter_string_type(df: DataFrame, line: str, field: str = "text") -> DataFrame:
    """JSON lines whose field is a string."""
    parsed = J.with_json(df, F.col(line), "_json")
    return parsed.filter(J.text_field(F.col("_json"), field).isNotNull()).drop("_json")


def filter_has_field(df: DataFrame, line: str, field: str = "text") -> DataFrame:
    """JSON lines that are objects with the field, whatever its value."""
    parsed = J.with_json(df, F.col(line), "_json")
    return parsed.filter(J.field_of(F.col("_json"), field).isNotNull()).drop("_json")


def pick_text_column(
    df: DataFrame, column: str = "text", keep: Iterable[str] = ()
) -> DataFrame:
    """The named column of a sheet, else its first; non-blank strings, unstripped."""
    keep = list(keep)
    first = next(c for c in df.columns if c not in keep)
    chosen = column if column in df.columns else first
    if not isinstance(df.schema[chosen].dataType, T.StringType):
        return standardize(df, chosen, keep).filter(F.lit(False)).withColumn(
            "text", F.col("text").cast("string")
        )
    return filter_blank(standardize(df, chosen, keep))


def explode_pages(
    df: DataFrame, pages: Column, keep: Iterable[str] = ()
) -> DataFrame:
    """One row per page with its 0-based number; pages are stripped, blank ones go.

    ``pages`` is an array of page texts, for example a text split at form feeds.
    """
    exploded = df.select(*keep, F.posexplode(pages).alias("page", "text"))
    return exploded.withColumn("text", strip(F.col("text"))).filter("text <> ''")


def union_sources(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def distinct_paths(df: DataFrame, path: str = "path") -> DataFrame:
    return df.select(path).distinct().orderBy(path)


def require_rows(df: DataFrame, message: str = "no valid rows") -> DataFrame:
    """Stop before the job when there is nothing to read. Looks for one row only."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def numbered_lines(
    df: DataFrame, key: str, text: str = "text", rows: int = BUCKET_ROWS
) -> DataFrame:
    """``(key, line_no, line)`` with 1-based numbers through the whole table."""
    lines = F.split(text, "\n")
    placed = with_running(
        df.select(key, text),
        key,
        {"_before": F.size(lines).cast("bigint")},
        rows=rows,
        inclusive=False,
    )
    return placed.select(
        key, "_before", F.posexplode(lines).alias("_at", "line")
    ).select(key, (F.col("_before") + F.col("_at") + 1).alias("line_no"), "line")


def field_inventory(df: DataFrame, line: str) -> DataFrame:
    """``(field, n)``: how many JSON object lines have each field."""
    value = F.to_json(J.strict_json(F.col(line)))
    return (
        df.select(F.explode(F.array_distinct(F.json_object_keys(value))).alias("field"))
        .groupBy("field")
        .agg(F.count("*").alias("n"))
    )
