import math
import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import runlog


def stop_model(losses, patience, delta):
    best, misses = None, 0
    for i, x in enumerate(losses):
        if best is None:
            best = x
        elif x > best - delta:
            misses += 1
            if misses >= patience:
                return i
        else:
            best, misses = x, 0
    return None


@pytest.mark.parametrize(
    "patience,delta,rows", [(3, 0.001, 3), (5, 0.0, 8), (4, 0.01, 1024)]
)
def test_early_stop_equals_a_loop(spark, patience, delta, rows):
    rnd = random.Random(patience)
    runs = {"edge": [3.0, 2.0, 1.9995, 2.1, 2.2, 1.0]}
    for i in range(16):
        n = rnd.choice([1, 2, 30, 300])
        runs[f"r{i}"] = [
            round(100 - j * 0.05 + rnd.choice([0, 0, 0.06, 0.2]), 3) for j in range(n)
        ]
    df = spark.createDataFrame(
        [(r, j * 3, x) for r, losses in runs.items() for j, x in enumerate(losses)],
        "run string, step long, loss double",
    ).repartition(3)
    out = runlog.early_stop(df, patience=patience, min_delta=delta, rows=rows).collect()
    want = {r: stop_model(losses, patience, delta) for r, losses in runs.items()}
    assert {r.run: r.stop_index for r in out} == want
    assert all(r.stop_step == (None if r.stop_index is None else 3 * r.stop_index) for r in out)
    if patience == 3:
        assert want["edge"] == 4


def test_optimizer_steps_drop_the_rest_of_an_epoch(spark):
    rows = [("r", e, i) for e, n in enumerate([10, 3, 8]) for i in range(n)]
    df = spark.createDataFrame(rows, "run string, epoch int, micro_step long")
    out = runlog.optimizer_steps(df, 4)
    made = out.filter("is_step").orderBy("epoch", "micro_step").collect()
    assert [(r.epoch, r.micro_step, r.step) for r in made] == [
        (0, 3, 1), (0, 7, 2), (2, 3, 3), (2, 7, 4),
    ]
    assert [r.step for r in runlog.every_n_steps(out, 2).orderBy("step").collect()] == [2, 4]


def test_schedule(spark):
    steps = [0, 5, 10, 55, 100]
    df = spark.createDataFrame([(s,) for s in steps], "s long")
    lr = df.select(runlog.lr_schedule(F.col("s"), 2.0, 10, 100).alias("x")).collect()
    assert [round(r.x, 9) for r in lr] == [0.0, 1.0, 2.0, 1.0, 0.0]


def test_checkpoints(spark):
    names = ["checkpoint-9", "checkpoint-10", "checkpoint-error-99", "best_model"]
    df = spark.createDataFrame([("r", f"out/{n}") for n in names], "run string, path string")
    assert runlog.latest_checkpoint(df).first().path == "out/checkpoint-10"
    kept = runlog.retain_last_k(df, 1)
    assert [r.step for r in kept.collect()] == [10]


def test_best_and_means(spark):
    rows = [("r", 1, 0, 3.0), ("r", 2, 0, 2.0), ("r", 3, 0, 2.0), ("r", 4, 1, None)]
    df = spark.createDataFrame(rows, "run string, step long, rank long, loss double")
    flags = runlog.best_so_far(df).orderBy("step").collect()
    assert [r.is_best for r in flags] == [True, True, False, False]
    assert tuple(runlog.best_checkpoint(df).first()) == ("r", 2, 2.0)
    best = runlog.best_checkpoint(df, greater_is_better=True).first()
    assert tuple(best) == ("r", 1, 3.0)
    means = runlog.running_avg_loss(df, by=["run"]).orderBy("step").collect()
    assert [r.avg_loss for r in means] == [3.0, 2.5, 7 / 3, 7 / 3]
    # rank 0 has the mean 7/3 and rank 1 no loss, which counts as 0
    val = runlog.val_loss_mean(df, by=["run"]).first()
    assert math.isclose(val.val_loss, 7 / 6)
    assert math.isclose(runlog.perplexity(df).first().perplexity, math.exp(7 / 3))


def test_throughput_and_resume(spark):
    df = spark.createDataFrame([(4, 128, 10.0), (4, 128, 30.0)], "batch_size int, seq_len int, time_ms double")
    assert tuple(runlog.throughput(df).first()) == (4, 128, 20.0, 25600.0)
    left = runlog.resume_incremental(spark.range(5), spark.range(3), ["id"])
    assert sorted(r.id for r in left.collect()) == [3, 4]
