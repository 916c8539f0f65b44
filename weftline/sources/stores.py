"""Folders whose files tasks open themselves, through Arrow."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def arrow_uri(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """The folder as Spark names it and as Arrow opens it, or None in a store that Arrow does not know."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target)
    uri = target.toUri().toASCIIString()
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)
    try:
        pafs.FileSystem.from_uri(uri)
    except (pa.ArrowException, OSError):
        return None
    return target.toString(), uri
