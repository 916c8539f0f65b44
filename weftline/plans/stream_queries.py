"""Registered queries: the streaming jobs, run over a table's files to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.plans.registry import query, table
from weftline.plans.runlog_queries import EARLY_STOP_SQL
from weftline.plans.token_queries import (
    BATCH_DOCS,
    LENGTH,
    PACK_BATCHES_SQL,
    PADDED_SQL,
    packed_summary,
    padded_summary,
)
from weftline.session import scratch_path
from weftline.sources import sinks
from weftline.sources.tables import stream_files
from weftline.streaming import jobs


def documents_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    return stream_files(spark, f"{sf_dir}/documents.parquet", schema)


def run(spark, stream):
    path = scratch_path(spark, "stream")
    jobs.run_available(jobs.to_parquet(stream, f"{path}/out"), f"{path}/progress")
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


@query("SELECT doc_id, text FROM documents WHERE lang = 'en'")
def stream_standardize(spark, sf_dir):
    stream = documents_stream(spark, sf_dir)
    return run(spark, jobs.stream_standardize(stream, "text", "EN", keep=["doc_id"]))


@query("SELECT DISTINCT md5(text) AS md5 FROM documents")
def stream_dedup(spark, sf_dir):
    jobs.use_rocksdb(spark)
    stream = documents_stream(spark, sf_dir).select("doc_id", "text")
    return run(spark, jobs.stream_dedup(stream)).select(F.md5("text").alias("md5"))


@query(PADDED_SQL)
def stream_tokenize(spark, sf_dir):
    stream = documents_stream(spark, sf_dir).select("doc_id", "text")
    return padded_summary(run(spark, jobs.stream_tokenize(stream, 2048)))


def quarter(df, key, last, i):
    """The rows with ``last * i < 4 * key <= last * (i + 1)``, key 0 included, by bounds that the scan can use."""
    return df.filter((F.col(key) > (last * i - (i == 0)) // 4) & (F.col(key) <= last * (i + 1) // 4))


@query(PACK_BATCHES_SQL)
def stream_pack(spark, sf_dir):
    """Four quarters in the order of their ids, a micro-batch each; no batch ends with one.

    A quarter is as many files as tasks write, and the stream goes on when the next one is there.
    """
    path = scratch_path(spark, "stream-pack")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    last = docs.agg(F.max("doc_id")).first()[0]
    for i in range(4):
        quarter(docs, "doc_id", last, i).write.parquet(f"{path}/in/{i}")
        stream = spark.readStream.schema(docs.schema).parquet(f"{path}/in/*")
        writer = jobs.stream_pack(stream, f"{path}/out", ["doc_id"], length=LENGTH, batch_docs=BATCH_DOCS)
        epoch = jobs.run_available(writer, f"{path}/progress")
    jobs.finish_pack(spark, f"{path}/out", docs.schema, epoch, ["doc_id"], length=LENGTH)
    return packed_summary(spark.read.parquet(f"{path}/out/packed"))


@query("""SELECT doc_id, lang FROM documents
    WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 3 = 1""")
def stream_shard(spark, sf_dir):
    stream = documents_stream(spark, sf_dir).select("doc_id", "lang")
    return run(spark, jobs.stream_shard(stream, "doc_id", 3, 1))


def event_parts(spark, sf_dir, path, parts):
    """Some of four files with a quarter of the events each, in the order of their ids."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    log = events.select("event_type", F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    for i in parts:
        part = log.filter((F.col("step") * 4 > last * i - (i == 0)) & (F.col("step") * 4 <= last * (i + 1)))
        part.coalesce(1).write.parquet(f"{path}/in/{i}")
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")


@query(EARLY_STOP_SQL)
def stream_early_stop(spark, sf_dir):
    """Four micro-batches, with a restart after the first two."""
    path = scratch_path(spark, "stream-stop")
    for parts in ((0, 1), (2, 3)):
        stream = event_parts(spark, sf_dir, path, parts)
        found = jobs.stream_early_stop(stream, patience=12, min_delta=0.5)
        jobs.run_available(jobs.to_parquet(found, f"{path}/out"), f"{path}/progress")
    return jobs.last_stop(spark.read.schema(found.schema).parquet(f"{path}/out"))


@query("""SELECT CASE WHEN event_type = 'view' THEN 'validation' ELSE 'train' END AS kind, event_id AS step,
    value AS loss FROM events""")
def metric_stream(spark, sf_dir):
    """Two streams and a batch that is written twice under one name."""
    path = scratch_path(spark, "metric-stream")
    stream = event_parts(spark, sf_dir, path, range(4)).filter("event_type <> 'click'").select("event_type", "step", "loss")
    for kind in ("train", "validation"):
        rows = stream.filter(f"(event_type = 'view') = {kind == 'validation'}").drop("event_type")
        jobs.run_available(jobs.stream_metrics(rows, f"{path}/log", kind, "events"), f"{path}/progress-{kind}")
    clicks = spark.read.parquet(f"{path}/in/*").filter("event_type = 'click'").select("step", "loss")
    for _ in range(2):
        sinks.append_metrics(clicks, f"{path}/log", "train", "clicks", "all")
    return sinks.read_metrics(spark, f"{path}/log", clicks.schema).select("kind", "step", "loss")
