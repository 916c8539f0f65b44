"""Writers."""

from __future__ import annotations

import uuid
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.sources.stores import arrow_uri

TOKEN_BYTES = 4
#: Folders that ``write_each`` deals its files to.
FOLDERS = 1024


def write_jsonl(
    df: DataFrame, path: str, text: str = "text", mode: str = "append"
) -> None:
    """One ``{"text": ...}`` per line, non-ASCII text as it is.

    A directory run replaces what is there (``overwrite``), a single file adds to it.
    """
    df.select(F.col(text).alias("text")).write.mode(mode).json(path)


def in_order(df: DataFrame, *order: str, parts: int | None = None) -> DataFrame:
    """Range partitions in key order: part files then follow it by name."""
    placed = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return placed.sortWithinPartitions(*order)


def write_split(df: DataFrame, path: str, mode: str = "overwrite", order: str | None = None) -> None:
    """``path/split=train`` and ``path/split=val`` in one pass, in key order if asked."""
    if order is not None:
        # the writer asks for rows by split; sorted by both it keeps the order
        df = df.repartitionByRange(order).sortWithinPartitions("split", order)
    df.select("text", "split").write.mode(mode).partitionBy("split").json(path)


def write_packed_shards(
    df: DataFrame,
    path: str,
    order: list[str],
    length: int,
    max_shard_bytes: int = 1 << 30,
    shards: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Parquet shards in row order, near and never above ``max_shard_bytes`` of token ids.

    The number of shards follows from the number of rows, unless ``shards`` gives it.
    Range partitions are not all alike, so they aim a tenth below the limit. Rows are shuffled
    with ids of two bytes where these do, and without labels that equal the ids.
    """
    rows = max(1, max_shard_bytes // (2 * TOKEN_BYTES * length))
    parts = shards or max(1, -(-df.count() * 10 // (rows * 9)))
    placed = in_order(_narrowed(df), *order, parts=parts)
    _widened(placed, df.columns).write.mode(mode).option(
        "maxRecordsPerFile", rows
    ).parquet(path, compression="zstd")


def _int_arrays(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "array<int>"]


def _narrowed(df: DataFrame) -> DataFrame:
    """Arrays of ints in fewer bytes, for ``_widened`` to undo; labels that equal the ids become null."""
    names = _int_arrays(df)
    if {"input_ids", "labels"} <= set(names):
        same = F.col("input_ids").eqNullSafe(F.col("labels"))
        df = df.withColumns({"labels": F.when(~same, F.col("labels")), "_same": same})
    for name in names:
        short = F.coalesce((F.array_min(name) >= -(1 << 15)) & (F.array_max(name) < 1 << 15), F.lit(True))
        df = df.withColumns({
            f"_short_{name}": F.when(short, F.col(name).cast("array<smallint>")), name: F.when(~short, F.col(name))
        })
    return df


def _widened(df: DataFrame, columns: list[str]) -> DataFrame:
    whole = {c: F.coalesce(F.col(f"_short_{c}").cast("array<int>"), F.col(c)) for c in columns if f"_short_{c}" in df.columns}
    df = df.withColumns(whole)
    if "_same" in df.columns:
        df = df.withColumn("labels", F.when(F.col("_same"), F.col("input_ids")).otherwise(F.col("labels")))
    return df.select(*columns)


def append_metrics(
    df: DataFrame, path: str, kind: str, writer: str = "batch", commit: str | None = None
) -> None:
    """Add records of one kind (``train`` or ``validation``) to a metric log.

    The log has a folder for each commit of each writer. The same commit again, after a failure,
    replaces its own records; without a name every call is a commit of its own.
    """
    commit = commit or uuid.uuid4().hex
    df.write.mode("overwrite").parquet(f"{path}/kind={kind}/writer={writer}/commit={commit}")


def read_metrics(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The records of a metric log, with ``kind``, ``writer`` and ``commit``."""
    parts = "kind string, writer string, commit string"
    full = StructType([*schema.fields, *StructType.fromDDL(parts).fields])
    return spark.read.schema(full).parquet(path)


def write_each(df: DataFrame, path: str, key: str, text: str) -> None:
    """One text file for each row, whose name has ``key=value`` in it.

    The tasks write the files themselves, since Spark's writer takes a folder, a check sum and a change
    of rights for each. Names depend on keys and partitions alone, so that a task which runs again
    replaces its files. A store that Arrow does not know is written by Spark, rows of one key together.
    """
    found = arrow_uri(df.sparkSession, path)
    if found is None:
        df.select(key, text).write.partitionBy(key).text(path)
        return
    _, uri = found

    def write(batches):
        store, root = pafs.FileSystem.from_uri(uri)
        part, seen, made = TaskContext.get().partitionId(), Counter(), set()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                folder = f"{root}/{zlib.crc32(str(name).encode()) % FOLDERS:04d}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{folder}/{key}={name}-{part}-{seen[name]}.txt") as out:
                    out.write((value.as_buffer() if value.is_valid else b""))
                    out.write(b"\n")
                seen[name] += 1
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    df.select(key, text).mapInArrow(write, "files long").agg(F.sum("files")).collect()
