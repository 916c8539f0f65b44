"""Queries by name, each with the SQL that should give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.session import prepare_session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare_session(spark), sf_dir)

        name = function.__name__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
