"""Exact deduplication by the MD5 of the UTF-8 text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.functions.text import text_hash


def first_of_hash(
    df: DataFrame, hash_column: str, order: Sequence[str]
) -> DataFrame:
    """The first row of every hash in the given order.

    Spark limits each group to its first row before the shuffle as well as after it
    (``WindowGroupLimit``), so a text copied into a third of the table sends one row
    per input task.
    """
    first = W.partitionBy(hash_column).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")
    )


def dedup_exact(
    df: DataFrame,
    order: str | Sequence[str],
    text: str = "text",
    keep_hash: str | None = None,
    late: bool = False,
) -> DataFrame:
    """Keep the first row of every distinct text in the given order.

    With ``late`` the order must name each row once. Then the winners are chosen among hashes
    alone, and whole rows are only fetched for them: texts are read twice, but never sorted,
    and sent at most once.
    """
    order = [order] if isinstance(order, str) else list(order)
    name = keep_hash or "_hash"
    hashed = df.withColumn(name, text_hash(F.col(text)))
    if late:
        # a struct, so that a null in the order is a place like any other
        place = F.struct(*order).alias("_place")
        winners = first_of_hash(hashed.select(name, *order), name, order).select(place)
        kept = hashed.select("*", place).join(winners.hint("shuffle_hash"), "_place", "left_semi").drop("_place")
    else:
        kept = first_of_hash(hashed, name, order)
    return kept if keep_hash else kept.drop(name)


def hashes(df: DataFrame, text: str = "text") -> DataFrame:
    """The distinct text hashes of a table, to be stored for ``dedup_incremental``."""
    return df.select(text_hash(F.col(text)).alias("hash")).distinct()


def dedup_incremental(
    new: DataFrame, seen: DataFrame, order: str | Sequence[str], text: str = "text"
) -> DataFrame:
    """First rows of the texts in ``new`` whose ``hash`` is not in ``seen``.

    ``new`` is reduced to one row per hash first, by the same partitioning the
    anti-join needs, so the join has neither hot keys nor a second shuffle of ``new``.
    The result has the column ``hash``; append it to the stored hashes.
    """
    return dedup_exact(new, order, text, keep_hash="hash").join(
        seen.select("hash"), "hash", "left_anti"
    )


class SeenStore:
    """Hashes of texts seen so far, in folders by the first hex digits of the hash.

    ``unseen`` opens only the folders that a batch can hit; inside them Bloom filters of the
    Parquet files answer for the hashes of small batches. Hashes of a commit with the same
    name replace each other, so that a commit may run again.
    """

    def __init__(self, path: str, digits: int = 2, literals: int = 1000) -> None:
        if not 1 <= digits <= 3:
            raise ValueError("1 to 3 digits")
        self.path, self.digits, self.literals = path, digits, literals

    def _bucketed(self, hashes: DataFrame) -> DataFrame:
        text = F.col("hash").cast("binary")
        # a null text has no hash, and is never known
        return hashes.filter("hash is not null").select("hash", F.lower(F.substring(F.hex(text), 1, self.digits)).alias("bucket"))

    def add(self, hashes: DataFrame, commit: str) -> None:
        """Add a column ``hash``; every folder gets one file of a commit, sorted, for small batches."""
        rows = self._bucketed(hashes.select("hash").distinct())
        (
            rows.repartition("bucket")
            .sortWithinPartitions("bucket", "hash")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .option("parquet.bloom.filter.enabled#hash", "true")
            .parquet(f"{self.path}/commit={commit}")
        )

    def seen(self, spark: SparkSession, hashes: DataFrame) -> DataFrame:
        """The stored hashes that may be among the given ones.

        There are at most ``16 ** digits`` folders, whose names become a filter on partitions.
        """
        kind = hashes.schema["hash"].dataType.simpleString()
        try:
            stored = spark.read.schema(f"hash {kind}, commit string, bucket string").parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return hashes.select("hash").limit(0)
        asked = self._bucketed(hashes.select("hash"))
        buckets = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
        stored = stored.filter(F.col("bucket").isin(*buckets)) if buckets else stored.limit(0)
        few = asked.select("hash").distinct().limit(self.literals + 1).collect()
        if 0 < len(few) <= self.literals:
            stored = stored.filter(F.col("hash").isin(*[r["hash"] for r in few]))
        return stored.select("hash")

    def unseen(self, new: DataFrame, order: str | Sequence[str], text: str = "text") -> DataFrame:
        """First rows of the texts in ``new`` that are not in the store, with their ``hash``."""
        first = dedup_exact(new, order, text, keep_hash="hash")
        seen = self.seen(new.sparkSession, new.select(text_hash(F.col(text)).alias("hash")))
        return first.join(seen, "hash", "left_anti")
