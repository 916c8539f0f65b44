import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import counts, dedup, mix, ranks, split
from weftline.operators.tokens import ByteTokens


def test_running_values_equal_a_loop(spark):
    rnd = random.Random(1)
    rows = [
        (rnd.choice(["a", "a", "a", "b", None]), i * rnd.choice([1]), rnd.randrange(100))
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "g string, i long, v long")
    for size in (1, 3, 1000):
        out = ranks.with_running(
            df, "i", {"s": F.col("v")}, {"m": F.col("v")}, by=["g"], rows=size
        )
        before = ranks.with_running(
            df, "i", {"s": F.col("v")}, {"m": F.col("v")}, by=["g"], rows=size,
            inclusive=False,
        )
        got = {r.i: (r.s, r.m) for r in out.collect()}
        got_before = {r.i: (r.s, r.m) for r in before.collect()}
        for g, i, _ in rows:
            upto = [v for h, j, v in rows if h == g and j <= i]
            prior = upto[:-1]
            assert got[i] == (sum(upto), min(upto))
            assert got_before[i] == (sum(prior), min(prior, default=None))


def test_more_buckets_than_the_fanout(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FANOUT", 4)
    out = ranks.with_rank(spark.range(100), "id", rows=2).collect()
    assert sorted((r.id, r["rank"]) for r in out) == [(i, i) for i in range(100)]


def test_dense_position_of_a_hot_first_column(spark):
    rows = [("hot" if i % 3 else f"p{i}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "path string, n long")
    got = ranks.dense_position(df, ["path", "n"]).collect()
    want = {r: i for i, r in enumerate(sorted(rows))}
    assert {(r.path, r.n): r.pos for r in got} == want


def test_key_at_rank(spark):
    df = spark.range(0, 300, 3)
    for rank, want in ((0, [0]), (37, [111]), (99, [297]), (100, [])):
        got = ranks.key_at_rank(df, "id", F.lit(rank), rows=10).collect()
        assert [r.cut for r in got] == want


def quota_sources(spark):
    rows = [("a", i) for i in range(2)] + [("b", i + 10) for i in range(10)]
    return spark.createDataFrame(rows, "source string, i long")


def test_quota_stops_with_the_first_source_that_ends(spark):
    weights = {"a": 1, "b": 1}
    mixed = mix.interleave(quota_sources(spark), weights, "i", mode="quota")
    placed = mix.mixture_position(mixed, weights, "quota").orderBy("pos").collect()
    assert [(r.source, r.k, r.pos) for r in placed] == [("a", 0, 0), ("b", 0, 1), ("a", 1, 2)]


def test_listed_source_without_rows_gives_nothing(spark):
    weights = {"a": 1, "b": 1, "c": 1}
    assert mix.interleave(quota_sources(spark), weights, "i", mode="quota").isEmpty()


def test_unlisted_source_is_left_out(spark):
    mixed = mix.interleave(quota_sources(spark), {"b": 2}, "i", mode="quota")
    assert {r.source for r in mixed.collect()} == {"b"} and mixed.count() == 10


def test_random_mixture(spark):
    weights = {"a": 0.1, "b": 0.3, "c": 0.6}
    rows = [(s, n * 10_000 + i) for n, s in enumerate("abc") for i in range(6000)]
    df = spark.createDataFrame(rows, "source string, i long")

    def run(partitions, rows):
        mixed = mix.interleave(df.repartition(partitions), weights, "i", rows=rows)
        placed = mix.mixture_position(mixed, weights, rows=rows)
        return [(r.source, r.k, r.pos) for r in placed.orderBy("pos").collect()]

    first = run(2, 100)
    assert first == run(5, 777)
    assert [p for _, _, p in first] == list(range(len(first)))
    for s in "abc":
        assert [k for t, k, _ in first if t == s] == list(range(sum(t == s for t, _, _ in first)))
    assert max(sum(t == s for t, _, _ in first) for s in "abc") == 6000
    for s, w in weights.items():
        share = sum(t == s for t, _, _ in first) / len(first)
        assert abs(share - w) < 0.02
    report = mix.mixture_report(
        spark.createDataFrame(first, "source string, k long, pos long"), weights
    )
    assert abs(sum(r.share for r in report.collect()) - 1) < 1e-9


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        mix.interleave(quota_sources(spark), {"a": 1}, "i", mode="other")


def test_first_copy_is_kept_when_a_third_are_copies(spark):
    rows = [(i, "same" if i % 3 == 1 else f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "i long, text string").repartition(7)
    got = {r.i for r in dedup.dedup_exact(df, "i").collect()}
    assert got == {1} | {i for i in range(300) if i % 3 != 1}
    plan = dedup.dedup_exact(df, "i")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_incremental_dedup_continues(spark):
    df = spark.createDataFrame([(i, f"t{i % 5}") for i in range(20)], "i long, text string")
    seen = dedup.hashes(df.filter("i < 3"))
    new = dedup.dedup_incremental(df.filter("i >= 3"), seen, "i")
    assert {r.i for r in new.collect()} == {3, 4}
    again = dedup.dedup_incremental(df, seen.unionByName(new.select("hash")), "i")
    assert again.isEmpty()


@pytest.mark.parametrize(
    "n,ratio,train", [(100, 0.29, 28), (7, 0.9, 6), (7, 1.0, 7), (7, 0.0, 0), (0, 0.9, 0)]
)
def test_sequential_split(spark, n, ratio, train):
    out = split.split_sequential(spark.range(n), "id", ratio, rows=3).collect()
    assert [r.id for r in sorted(out) if r.split == "train"] == list(range(train))
    assert len(out) == n


def test_split_does_not_shuffle_the_rows(spark):
    df = spark.range(50).withColumn("text", F.lit("x"))
    plan = split.split_sequential(df, "id").select("text", "split")
    text = plan._jdf.queryExecution().executedPlan().toString()
    main = text.split("Subquery")[0]
    assert "Exchange" not in main


def test_shards_and_sampler(spark):
    shards = [
        {r.id for r in split.shard_rows(spark.range(23), "id", 4, i, rows=5).collect()}
        for i in range(4)
    ]
    assert shards == [set(range(i, 23, 4)) for i in range(4)]
    for n, replicas, shuffle in ((23, 4, True), (3, 8, False), (8, 4, False)):
        rows = split.distributed_sampler(spark.range(n), "id", replicas, shuffle).collect()
        each = -(-n // replicas)
        assert sorted((r.replica, r["sample"]) for r in rows) == [
            (i, j) for i in range(replicas) for j in range(each)
        ]
        assert {r.id for r in rows} == set(range(n))
        if not shuffle:
            assert all(r.id == (r["sample"] * replicas + r.replica) % n for r in rows)


def test_shuffle_is_a_permutation_and_changes_with_the_epoch(spark):
    def order(epoch, partitions):
        df = spark.range(200).repartition(partitions)
        out = split.shuffle_epoch(df, "id", epoch=epoch).orderBy("rank").collect()
        assert [r["rank"] for r in out] == list(range(200))
        return [r.id for r in out]

    assert order(0, 1) == order(0, 6) != order(1, 1)
    assert sorted(order(0, 1)) == list(range(200))


def test_batches(spark):
    ranked = ranks.with_rank(spark.range(10), "id")
    kept = split.batches(ranked, 4, drop_last=False)
    full = split.batches(ranked, 4, drop_last=True)
    assert sorted(r.batch_id for r in kept.collect()) == [0] * 4 + [1] * 4 + [2] * 2
    assert sorted(r.batch_id for r in full.collect()) == [0] * 4 + [1] * 4


def test_counts(spark):
    df = spark.createDataFrame([(0, "ab"), (1, "é"), (2, "xyz")], "i long, text string")
    stats = counts.corpus_stats(df, ByteTokens(F.col("text"), 32), 4).first()
    assert tuple(stats) == (3, 8, 9, 2)
    empty = counts.corpus_stats(df.filter("i < 0"), ByteTokens(F.col("text"), 32), 4)
    assert tuple(empty.first()) == (0, 0, 0, 0)
    plan = counts.training_plan(spark.range(50), 8, 3, 4).first()
    assert tuple(plan) == (50, 6, 18, 3)
    keep = counts.training_plan(spark.range(50), 8, 3, 4, drop_last=False).first()
    assert tuple(keep) == (50, 7, 21, 3)
    by_path = counts.doc_counts(
        spark.createDataFrame([("a",), ("a",), (None,)], "path string")
    ).collect()
    assert {(r.path, r.n, r.is_total) for r in by_path} == {("a", 2, 0), (None, 1, 0), (None, 3, 1)}
