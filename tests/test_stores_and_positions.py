"""Late rows, stores and positions, batches as a whole, and streams that run again."""

import math
import pathlib
import random
import re

import pyarrow as pa
import pytest

from weftline.operators import dedup, mapping, runlog, tokens
from weftline.sources import sinks
from weftline.streaming import jobs


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().sparkPlan().toString()


def test_late_rows_are_the_same(spark):
    rows = [(None, "n"), (5, "a"), (3, "a"), (9, None), (8, None), (7, ""), (6, "n")] + [(100 + i, f"t{i % 7}") for i in range(80)]
    df = spark.createDataFrame(rows, "k long, text string").repartition(3)
    early = dedup.dedup_exact(df, "k").collect()
    late = dedup.dedup_exact(df, "k", late=True)
    assert sorted(map(str, late.collect())) == sorted(map(str, early))
    physical = late._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in physical or "BroadcastHashJoin" in physical
    # the sorts are those of the narrow winners
    assert all("text" not in line for line in physical.splitlines() if "Sort [" in line or "+- Sort" in line)


def test_rows_with_one_key_stay_apart(spark):
    docs = spark.createDataFrame([(1, "x x"), (1, "y y"), (1, "x x"), (2, None), (2, None), (None, "y")], "k long, text string")
    vocab = spark.createDataFrame([("x", 0), ("y", 1)], "word string, id long")
    for head in (0, 10):
        coded = tokens.tokenize_vocab(docs, vocab, "k", broadcast_words=head)
        assert sorted((r["k"] or 0, r["ids"]) for r in coded.collect()) == [(0, [1]), (1, [0, 0]), (1, [0, 0]), (1, [1, 1]), (2, []), (2, [])]
        back = tokens.detokenize_vocab(coded, vocab, "k", broadcast_words=head)
        assert sorted((r["k"] or 0, r["text"]) for r in back.collect()) == [(0, "y"), (1, "x x"), (1, "x x"), (1, "y y"), (2, ""), (2, "")]


def test_seen_store(spark, tmp_path):
    store = dedup.SeenStore(str(tmp_path / "seen"))
    first = spark.createDataFrame([(i, f"t{i}") for i in range(300)] + [(300, None)], "k long, text string")
    new = store.unseen(first, "k").select("k", "text", "hash").collect()
    assert len(new) == 301
    for _ in range(2):
        store.add(spark.createDataFrame(new, "k long, text string, hash binary"), "one")
    again = spark.createDataFrame([(1, "t5"), (2, "new"), (3, "t299"), (4, "new"), (5, None)], "k long, text string")
    assert sorted((r["k"], r["text"]) for r in store.unseen(again, "k").collect()) == [(2, "new"), (5, None)]
    looked = store.seen(spark, dedup.hashes(again))
    pruned = looked._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in pruned and 1 <= len(re.findall(r"\b[0-9a-f]{2}\b", pruned)) <= 3
    many = dedup.SeenStore(str(tmp_path / "seen"), literals=1)
    assert sorted(r["k"] for r in many.unseen(again, "k").collect()) == [2, 5]
    with pytest.raises(ValueError):
        dedup.SeenStore("x", digits=0)


def test_position(spark, tmp_path):
    df = spark.createDataFrame([(i, i * 7 % 50) for i in range(50)], "sample long, v long")
    data, position = str(tmp_path / "data"), str(tmp_path / "position")
    for epoch in range(3):
        runlog.write_epoch(df, data, epoch, shard_rows=8)
    assert runlog.resume_position(spark, data, position, df.schema).count() == 150
    for epoch, sample, left in ((0, 0, 150), (1, 17, 83), (2, 49, 1), (2, 50, 0)):
        runlog.save_position(spark, position, epoch, sample, 8)
        rest = runlog.resume_position(spark, data, position, df.schema)
        assert rest.count() == left
        filters = rest._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("], ")[0]
        assert "epoch" in filters and "shard" in filters


def test_batches_as_a_whole(spark):
    rows = [(i, [i] * (4 if i % 5 else 3), [0] * 4, i // 3) for i in range(11)] + [(50, None, None, 3), (51, [1] * 4, [None] * 4, None)]
    df = spark.createDataFrame(rows, "k long, input_ids array<int>, labels array<int>, batch_id long").repartition(4)
    got = {r["batch_id"]: r for r in mapping.stack_batches(df, 4, "k", order=["k"]).collect()}
    assert [len(x) for x in got[0]["input_ids"]] == [4, 4] and got[0]["short"] == [0] and got[0]["rows"] == 2
    assert got[1]["input_ids"] == [[3] * 4, [4] * 4] and got[1]["short"] == [5]
    assert got[3]["short"] == [10, 50] and got[3]["rows"] == 1 and got[None]["labels"] == [[None] * 4]

    def load():
        return lambda table: pa.table({"n": [table.num_rows], "last": [table.column("k")[-1].as_py()]})

    counted = mapping.collate_batches(df.drop("input_ids", "labels"), load, "n long, last long", order=["k"])
    assert sorted(tuple(r) for r in counted.collect()) == [(1, 51), (3, 2), (3, 5), (3, 8), (3, 50)]
    assert mapping.stack_batches(df.limit(0), 4, "k").count() == 0


def losses(seed):
    rng = random.Random(seed)
    out = []
    for run in ("a", "b", None, "flat", "none"):
        for step in range(60):
            loss = None if run == "none" or rng.random() < 0.1 else round(100 - step * 0.05 + rng.choice([0, 0, 0.06, 0.2]), 3)
            out.append((run, step, math.nan if rng.random() < 0.05 and loss else loss))
    return out


def test_early_stop_of_a_stream(spark, tmp_path):
    rows = losses(3)
    log = spark.createDataFrame(rows, "run string, step long, loss double")
    want = {r["run"]: (r["stop_index"], r["stop_step"]) for r in runlog.early_stop(log, patience=2, min_delta=0.01, rows=8).collect()}
    for part in ((0, 1), (2, 3)):
        for i in part:
            log.filter(f"step div 15 = {i}").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
        found = jobs.stream_early_stop(stream, patience=2, min_delta=0.01)
        jobs.run_available(jobs.to_parquet(found, str(tmp_path / "out")), str(tmp_path / "log"))
    got = jobs.last_stop(spark.read.schema(found.schema).parquet(str(tmp_path / "out"))).collect()
    assert {r["run"]: (r["stop_index"], r["stop_step"]) for r in got} == want and len(got) == 5
    assert any(stop is not None for stop, _ in want.values())


def test_a_micro_batch_that_runs_again_adds_nothing(spark, tmp_path):
    log = spark.createDataFrame([(i, float(i)) for i in range(20)], "step long, loss double")
    for i in range(2):
        log.filter(f"step div 10 = {i}").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    out, progress = str(tmp_path / "out"), tmp_path / "log"
    assert jobs.run_available(jobs.stream_metrics(stream, out, "train", "s"), str(progress)) == 1
    # as if the last micro-batch had been written, but its end not recorded
    for name in ("1", ".1.crc"):
        pathlib.Path(progress / "commits" / name).unlink(missing_ok=True)
    jobs.run_available(jobs.stream_metrics(stream, out, "train", "s"), str(progress))
    sinks.append_metrics(log.limit(1), out, "validation", commit="x")
    sinks.append_metrics(log.limit(1), out, "validation", commit="x")
    got = sinks.read_metrics(spark, out, log.schema).collect()
    assert sorted(r["step"] for r in got if r["kind"] == "train") == list(range(20))
    assert len(got) == 21


def test_jobs_leave_nothing_behind(spark, tmp_path):
    from weftline import session
    from weftline.plans.prepare import convert_directory

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('["one", "two"]')
    (tmp_path / "in/b.csv").write_text("text\n\"th\nree\"\n")
    scratch = pathlib.Path(session.scratch_dir(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    convert_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"), train_ratio=0.5)
    assert set(scratch.iterdir()) == before
    assert sorted(r["text"] for r in spark.read.json(str(tmp_path / "out/data")).collect()) == ["one", "th\nree", "two"]
    with session.temporary_scratch(spark):
        inner = session.materialize(spark.range(3), "kept-until-the-end")
        assert inner.count() == 3 and set(scratch.iterdir()) != before
    assert set(scratch.iterdir()) == before
