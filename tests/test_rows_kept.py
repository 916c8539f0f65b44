"""No row is lost to a null, an empty value or an unusual key."""

import pyarrow as pa
from pyspark.sql import functions as F

from weftline.operators import mapping, pack, ranks, runlog, select, split, tokens
from weftline.plans.prepare import mix_dedup_pack
from weftline.streaming import jobs


def test_null_keys_come_first(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (300, "c")], "k long, text string")
    got = {r["text"]: r["rank"] for r in ranks.with_rank(df, "k").collect()}
    assert got == {"b": 0, "a": 1, "c": 2}
    assert select.numbered_lines(df, "k").count() == 3
    packed = pack.pack_corpus(df, tokens.ByteTokens(F.col("text"), 32), "k", length=1)
    got = {r["seq_id"]: bytes(r["input_ids"]) for r in packed.collect()}
    assert b"".join(got[i] for i in sorted(got)) == b"b a c"
    assert split.shard_rows(df, "k", 1, 0).count() == 3
    assert split.distributed_sampler(df, "k", 1, shuffle=False).count() == 3


def test_any_key(spark):
    keys = [i * 10**9 for i in range(500)] + [None]
    df = spark.createDataFrame([(k, f"s{k}") for k in keys], "k long, s string")
    assert not ranks.is_dense(df, "k") and not ranks.is_dense(df, "s")
    order = [None, *sorted(k for k in keys if k is not None)]
    got = {r["k"]: r["rank"] for r in ranks.with_any_rank(df, "k").collect()}
    assert [got[k] for k in order] == list(range(501))
    train = {r["s"] for r in split.split_sequential(df, "s", 0.5).filter("split = 'train'").collect()}
    assert train == set(sorted(f"s{k}" for k in keys)[:250])
    assert split.first_rows(df, "s", 7).count() == 7
    shards = [split.shard_rows(df, "s", 3, i).count() for i in range(3)]
    assert shards == [167, 167, 167]


def test_repeated_keys(spark):
    """Every row counts once, whatever its key."""
    strings = spark.createDataFrame([(k, i) for i, k in enumerate(["a", "a", "b", None, None])], "k string, n int")
    split_rows = split.split_sequential(strings, "k", 0.6).collect()
    assert sorted(r["n"] for r in split_rows) == [0, 1, 2, 3, 4]
    train = {r["n"] for r in split_rows if r["split"] == "train"}
    assert len(train) == 3 and {3, 4} < train and 2 not in train
    far = spark.createDataFrame([(10**15, 0), (10**15, 1), (5, 2)], "k long, n int")
    near = spark.createDataFrame([(k % 7 or None, k) for k in range(600)], "k long, n int")
    for df in (strings, far, near):
        size = df.count()
        shards = [split.shard_rows(df, "k", 2, i).collect() for i in range(2)]
        assert sorted(r["n"] for s in shards for r in s) == list(range(size))
        assert max(map(len, shards)) - min(map(len, shards)) <= 1
        for n in (0, size // 2, size - 1, size + 1):
            first = split.first_rows(df, "k", n).collect()
            assert len({r["n"] for r in first}) == len(first) == min(n, size)
            keys = sorted((r["k"] is not None, r["k"] or 0) for r in df.collect())
            assert sorted((r["k"] is not None, r["k"] or 0) for r in first) == keys[:n]
        sampled = split.distributed_sampler(df, "k", 3, shuffle=False)
        assert sampled.count() == -(-size // 3) * 3 and sampled.select("n").distinct().count() == size
    assert ranks.is_unique(spark.createDataFrame([(k,) for k in [None, *range(-70, 200, 3)]], "k long"), "k")
    assert not ranks.is_unique(spark.createDataFrame([(None,), (None,), (3,)], "k long"), "k")


def test_runs_without_a_name_or_a_loss(spark):
    log = spark.createDataFrame(
        [(None, 0, 0), (None, 0, 1), ("a", None, 0), ("a", 1, 0)], "run string, epoch int, micro_step long"
    )
    assert runlog.optimizer_steps(log, 2).count() == 4
    losses = [("a", i, None) for i in range(4)] + [(None, i, 1.0) for i in range(400)]
    df = spark.createDataFrame(losses, "run string, step long, loss double")
    got = {r["run"]: r["stop_index"] for r in runlog.early_stop(df, patience=300, rows=8).collect()}
    assert got == {"a": None, None: 300}


def test_empty_texts_and_ids(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (3, ""), (4, "zz")], "k long, text string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "word string, id long")
    got = {r["k"]: r["ids"] for r in tokens.tokenize_vocab(docs, vocab, "k").collect()}
    assert got == {1: [0, 1, 0], 2: [], 3: [], 4: []}
    known = {r["k"]: r["ids"] for r in tokens.tokenize_vocab(docs, vocab, "k", unknown=9, broadcast_words=1).collect()}
    assert known == {1: [0, 1, 0], 2: [], 3: [9], 4: [9]}
    ids = spark.createDataFrame([(1, [0, 1]), (2, []), (3, None)], "k long, ids array<int>")
    assert {r["k"]: r["text"] for r in tokens.detokenize_vocab(ids, vocab, "k").collect()} == {1: "a b", 2: "", 3: ""}


def test_a_tokenizer_runs_once_for_each_document(spark, tmp_path):
    def load():
        def encode(text):
            with open(f"{tmp_path}/calls", "a") as calls:
                calls.write("x\n")
            return list(text.encode())

        return encode

    rows = [(i, f"text {i % 50}", "ab"[i % 2]) for i in range(100)]
    docs = spark.createDataFrame(rows, "k long, text string, source string")
    args = (docs, {"a": 0.5, "b": 0.5}, "k")
    named = {"length": 16, "batch_docs": 8, "mode": "quota"}
    own = mix_dedup_pack(*args, tokenizer=tokens.tokenizer_udf(load), **named).collect()
    assert sorted(own) == sorted(mix_dedup_pack(*args, **named).collect())
    assert len((tmp_path / "calls").read_text().splitlines()) == 50


def test_batches_may_change_the_number_of_rows(spark):
    def load():
        return lambda batch: [pa.RecordBatch.from_pydict({"n": [n] * n}) for n in batch.column(0).to_pylist() if n]

    got = mapping.map_batches(spark.range(5), load, "n long")
    assert sorted(r["n"] for r in got.collect()) == [1, 2, 2, 3, 3, 3, 4, 4, 4, 4]


def test_streams_are_packed_across_micro_batches(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * (i % 13)) for i in range(50)], "k long, text string")
    for i in range(4):
        docs.filter(f"k >= {i * 12} and k < {i * 12 + (14 if i == 3 else 12)}").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out = f"{tmp_path}/out"
    last = jobs.run_available(jobs.stream_pack(stream, out, ["k"], length=8, batch_docs=7), f"{tmp_path}/progress")
    jobs.finish_pack(spark, out, docs.schema, last, ["k"], length=8)
    want = pack.pack_batches(docs, tokens.ByteTokens(F.col("text")), "k", 8, 7)
    columns = ["batch_id", "block", "input_ids"]
    assert last == 3
    assert sorted(spark.read.parquet(f"{out}/packed").select(*columns).collect()) == sorted(want.select(*columns).collect())
    shards = [jobs.stream_shard(docs, "k", 3, i).count() for i in range(3)]
    assert sum(shards) == 50 and min(shards) > 5
