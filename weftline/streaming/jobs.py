"""Structured Streaming forms of the corpus operators.

The column functions are those of the batch jobs. A stream is run by ``run_available``
up to the end of what is there; started again with the same checkpoint it goes on from
the stored position.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from weftline.functions.text import has_text, text_hash
from weftline.operators.pack import pack_batches
from weftline.operators.ranks import dense_position
from weftline.operators.tokens import ByteTokens, Tokens, tokenize_bytes, truncate_pad
from weftline.session import scratch_path, temporary_scratch
from weftline.sources.sinks import append_metrics

STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_standardize(
    stream: DataFrame, column: str, language: str | None = None, lang: str = "lang", keep=()
) -> DataFrame:
    """Language filter, then one column as ``text``, blank rows left out."""
    if language is not None:
        wanted = F.lower(F.coalesce(F.col(lang), F.lit(""))) == language.lower()
        stream = stream.filter(wanted)
    out = stream.select(*keep, F.col(column).alias("text"))
    return out.filter(has_text(F.col("text")))


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of streams that start from now on in RocksDB, in this session."""
    spark.conf.set(STATE_STORE_CONF, ROCKSDB)


def stream_shard(stream: DataFrame, key: str, num_shards: int, index: int) -> DataFrame:
    """The rows of one shard, dealt by a hash of the key: a stream has no row numbers.

    Every row is in one shard, the same at every run. A null key counts as an empty one.
    """
    if not 0 <= index < num_shards:
        raise ValueError("index must be in [0, num_shards)")
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return stream.filter(F.pmod(number, F.lit(num_shards)) == index)


def stream_dedup(
    stream: DataFrame, text: str = "text", event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """First arrival of every text. The state holds 16-byte hashes, not texts.

    It grows with the distinct texts, so let ``use_rocksdb`` keep it on disk. With ``event_time`` and
    ``delay`` a hash is forgotten after that time, and later copies pass again.
    """
    hashed = stream.withColumn("hash", text_hash(F.col(text)))
    if event_time is None:
        return hashed.dropDuplicates(["hash"])
    return hashed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["hash"])


def stream_tokenize(
    stream: DataFrame, length: int, text: str = "text", mask_label: int | None = None
) -> DataFrame:
    """Byte ids cut and padded to ``length``; the text is dropped."""
    ids = stream.withColumn("_ids", tokenize_bytes(F.col(text))).drop(text)
    return truncate_pad(ids, "_ids", length, mask_label=mask_label)


def stream_pack(
    stream: DataFrame,
    path: str,
    order: list[str],
    tokens: Tokens | None = None,
    length: int = 4096,
    batch_docs: int = 1000,
) -> DataStreamWriter:
    """Pack batches of ``batch_docs`` documents that run on through the stream.

    Rows go in micro-batches, then by ``order``. What does not fill a batch waits in
    ``path/carry`` for the next micro-batch; packed rows are in ``path/packed/epoch=N``.
    When the stream is over, ``finish_pack`` packs the rest as the short last batch. A
    micro-batch that runs again after a failure replaces its own folders.
    """
    tokens = tokens or ByteTokens(F.col("text"))
    schema, spark = stream.schema, stream.sparkSession

    def pack(rows: DataFrame, epoch: int) -> None:
        with temporary_scratch(spark):
            pack_epoch(rows, epoch)

    def pack_epoch(rows: DataFrame, epoch: int) -> None:
        # the session of a micro-batch plans without statistics; what follows is batch work
        arrived = scratch_path(spark, "arrived")
        rows.write.parquet(arrived)
        rows = spark.read.schema(schema).parquet(arrived)
        waiting, done = _carried(spark, path, schema, epoch - 1)
        new = waiting.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
        numbered = dense_position(new, ["_new", *order], "_pos").drop("_new")
        batches = numbered.count() // batch_docs
        full = batches * batch_docs
        packed = pack_batches(numbered.filter(F.col("_pos") < full), tokens, "_pos", length, batch_docs)
        packed = packed.withColumn("batch_id", F.col("batch_id") + done)
        packed.write.mode("overwrite").parquet(f"{path}/packed/epoch={epoch}")
        rest = numbered.filter(F.col("_pos") >= full).drop("_pos")
        rest.write.mode("overwrite").parquet(f"{path}/carry/epoch={epoch}")
        counted = spark.range(1).select(F.lit(done + batches).cast("bigint").alias("batches"))
        counted.write.mode("overwrite").json(f"{path}/done/epoch={epoch}")

    return stream.writeStream.foreachBatch(pack)


def _carried(spark: SparkSession, path: str, schema: StructType, epoch: int) -> tuple[DataFrame, int]:
    """The rows that wait after an epoch, and the number of batches packed by then."""
    if epoch < 0:
        return spark.createDataFrame([], schema), 0
    done = spark.read.schema("batches long").json(f"{path}/done/epoch={epoch}").first()
    return spark.read.schema(schema).parquet(f"{path}/carry/epoch={epoch}"), done["batches"]


def finish_pack(
    spark: SparkSession,
    path: str,
    schema: StructType,
    last_epoch: int,
    order: list[str],
    tokens: Tokens | None = None,
    length: int = 4096,
) -> None:
    """Pack what ``stream_pack`` has left after its last epoch as one short batch."""
    rest, done = _carried(spark, path, schema, last_epoch)
    tokens = tokens or ByteTokens(F.col("text"))
    numbered = dense_position(rest, order, "_pos")
    # fewer rows than a batch: one segment whatever its size
    packed = pack_batches(numbered, tokens, "_pos", length, 1 << 40)
    packed = packed.withColumn("batch_id", F.col("batch_id") + done)
    packed.write.mode("overwrite").parquet(f"{path}/packed/epoch=rest")


#: Stands for a null step, which comes first.
_NO_STEP = -(1 << 63)


class _EarlyStop(StatefulProcessor):
    """Counts misses of one run; the state is five numbers, whatever the length of the run."""

    def __init__(self, patience: int, min_delta: float) -> None:
        self.patience, self.min_delta = patience, min_delta

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = "seen long, best double, misses int, stop_index long, stop_step long"
        self.state = handle.getValueState("run", fields)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers) -> Iterator[Row]:
        seen, best, misses, stop_index, stop_step = self.state.get() or (0, None, 0, None, None)
        new = sorted(((r.step, r.loss) for r in rows if r.counts), key=itemgetter(0))
        if stop_index is None:
            for at, (step, loss) in enumerate(new):
                # as in SQL, what is not a number is above any loss
                if best is not None and best == best and not loss <= best - self.min_delta:
                    misses += 1
                    if misses >= self.patience:
                        stop_index, stop_step = seen + at, None if step == _NO_STEP else step
                        break
                else:
                    best, misses = loss, 0
        seen += len(new)
        self.state.update((seen, best, misses, stop_index, stop_step))
        runs = {f"by{i}": value for i, value in enumerate(key)}
        yield Row(**runs, seen=seen, stop_index=stop_index, stop_step=stop_step)

    def close(self) -> None:
        pass


def stream_early_stop(
    stream: DataFrame,
    step: str = "step",
    loss: str = "loss",
    by: Sequence[str] = ("run",),
    patience: int = 3,
    min_delta: float = 0.001,
) -> DataFrame:
    """Early stopping while runs train: a row ``(by, seen, stop_index, stop_step)`` for each run and micro-batch.

    Losses count in the order of micro-batches, then steps; null losses do not count. The state
    of a run goes on in RocksDB after a restart. A task holds one run's rows of one
    micro-batch, so the source bounds it (``maxFilesPerTrigger``). ``last_stop`` has the newest row
    of every run.
    """
    use_rocksdb(stream.sparkSession)
    # rows reach Python as named tuples, whose names do not begin with an underscore
    keys = {f"by{i}": F.col(c) for i, c in enumerate(by)}
    slim = stream.select(
        *[c.alias(n) for n, c in keys.items()],
        F.coalesce(F.col(step).cast("long"), F.lit(_NO_STEP)).alias("step"),
        F.coalesce(F.col(loss).cast("double"), F.lit(0.0)).alias("loss"), F.col(loss).isNotNull().alias("counts"),
    )
    types = ", ".join(f"{n} {slim.schema[n].dataType.simpleString()}" for n in keys)
    found = slim.groupBy(*keys).transformWithState(
        _EarlyStop(patience, min_delta), f"{types}, seen long, stop_index long, stop_step long", "Append", "None"
    )
    return found.select(*[F.col(n).alias(c) for n, c in zip(keys, by, strict=True)], "seen", "stop_index", "stop_step")


def last_stop(found: DataFrame, by: Sequence[str] = ("run",)) -> DataFrame:
    """``(by, stop_index, stop_step)`` from the rows that ``stream_early_stop`` has written so far."""
    newest = F.max_by(F.struct("stop_index", "stop_step"), "seen").alias("_stop")
    return found.groupBy(*by).agg(newest).select(*by, "_stop.*")


def stream_metrics(stream: DataFrame, path: str, kind: str, writer: str) -> DataStreamWriter:
    """Add the records of a stream to the metric log; a micro-batch that runs again adds nothing."""

    def add(rows: DataFrame, epoch: int) -> None:
        append_metrics(rows, path, kind, writer, f"epoch-{epoch}")

    return stream.writeStream.foreachBatch(add)


def to_parquet(stream: DataFrame, path: str) -> DataStreamWriter:
    return stream.writeStream.format("parquet").outputMode("append").option("path", path)


def run_available(writer: DataStreamWriter, checkpoint: str) -> int:
    """Run over everything there is, then stop; gives the last epoch, -1 if none ran."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query.lastProgress["batchId"] if query.lastProgress else -1
