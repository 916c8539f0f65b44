"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"
PARTS_CONF = "spark.sql.files.minPartitionNum"


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the SQL options the library relies on. All can be set at run time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    # passes over large files must cut them alike, also when executors come and go between them
    if spark.conf.get(PARTS_CONF, None) is None:
        spark.conf.set(PARTS_CONF, spark.sparkContext.defaultParallelism)
    # a JSON object with a repeated field keeps the last value, it is not an error
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once in a Spark application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    file = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(file, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(file)
    _SHIPPED.add(context.applicationId)


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster.

    Only a local session may fall back to a folder of this machine.
    """
    path = spark.conf.get(SCRATCH_CONF, None)
    if path:
        return path
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {SCRATCH_CONF} to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="weftline-")
    spark.conf.set(SCRATCH_CONF, path)
    return path


#: Scratch paths handed out inside ``temporary_scratch``, innermost last, in each thread.
_OPEN = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that nothing else uses."""
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    blocks = getattr(_OPEN, "blocks", None)
    if blocks:
        blocks[-1].append(path)
    return path


@contextmanager
def temporary_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what the block writes to the scratch folder when the block ends.

    For jobs that end with an output elsewhere: no DataFrame of the block may be read later.
    """
    _OPEN.blocks = [*getattr(_OPEN, "blocks", []), []]
    try:
        yield
    finally:
        for path in _OPEN.blocks.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back, which cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
