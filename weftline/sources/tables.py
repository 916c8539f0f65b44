"""Tables laid out as ``root/name[/config][/split]``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from weftline.operators.split import first_rows


def table_path(
    root: str, name: str, config: str | None = None, split: str | None = None
) -> str:
    return "/".join(p for p in (root.rstrip("/"), name, config, split) if p)


def stream_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stream of Parquet files, where ``path`` may also be a single file.

    The file source takes a plain path for a folder, a pattern for either.
    """
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).parquet(pattern)


def read_source(
    spark: SparkSession,
    root: str,
    name: str,
    config: str | None = None,
    split: str | None = "train",
    streaming: bool = False,
) -> DataFrame:
    """A lazily read Parquet table, or a stream of its files in the same form."""
    path = table_path(root, name, config, split)
    table = spark.read.parquet(path)
    if not streaming:
        return table
    return stream_files(spark, path, table.schema)


def optional_split(
    spark: SparkSession,
    root: str,
    name: str,
    config: str | None = None,
    split: str = "validation",
    fallback_rows: int | None = None,
    key: str | None = None,
) -> DataFrame | None:
    """The split if there is one, else None, or the first rows of ``train`` if asked."""
    try:
        return read_source(spark, root, name, config, split)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    if fallback_rows is None:
        return None
    return first_rows(read_source(spark, root, name, config), key, fallback_rows)
