"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weftline.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back, which cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
