"""Questions about training runs, asked of their metric tables.

A run's log may be as long as a table, so nothing here collects a run: running
values go through ``with_running``, and early stopping is folded chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.functions.text import name_number
from weftline.operators.ranks import BUCKET_ROWS, div, with_rank, with_running


def running_avg_loss(
    df: DataFrame,
    step: str = "step",
    loss: str = "loss",
    by: Sequence[str] = ("run", "epoch"),
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``avg_loss``, the mean loss of the epoch so far."""
    sums = {
        "_sum": F.coalesce(F.col(loss), F.lit(0.0)),
        "_count": F.col(loss).isNotNull().cast("bigint"),
    }
    out = with_running(df, step, sums, by=by, rows=rows)
    return out.withColumn("avg_loss", F.try_divide("_sum", "_count")).drop(
        "_sum", "_count"
    )


def optimizer_steps(
    df: DataFrame,
    accumulation: int,
    micro_step: str = "micro_step",
    run: str = "run",
    epoch: str = "epoch",
) -> DataFrame:
    """Add ``step``, the optimizer steps made so far, and ``is_step``.

    ``micro_step`` counts from 0 in each epoch. What is left of an epoch after its last
    full accumulation makes no step.
    """
    # a struct, so that runs and epochs without a name join like others
    df = df.withColumn("_epoch", F.struct(F.col(run).alias("run"), F.col(epoch).alias("epoch")))
    per_epoch = df.groupBy("_epoch").agg(
        div(F.max(micro_step) + 1, accumulation).alias("_steps")
    )
    earlier = W.partitionBy("_epoch.run").orderBy("_epoch.epoch").rowsBetween(
        W.unboundedPreceding, -1
    )
    before = per_epoch.select(
        "_epoch", F.coalesce(F.sum("_steps").over(earlier), F.lit(0)).alias("_before")
    )
    done = div(F.col(micro_step) + 1, accumulation)
    return (
        df.join(before, "_epoch")
        .withColumns(
            {
                "step": F.col("_before") + done,
                "is_step": F.pmod(F.col(micro_step) + 1, F.lit(accumulation)) == 0,
            }
        )
        .drop("_before", "_epoch")
    )


def every_n_steps(df: DataFrame, n: int, step: str = "step") -> DataFrame:
    """One row for every ``n``-th optimizer step, taken when the step is made."""
    return df.filter(F.col("is_step") & (F.pmod(step, F.lit(n)) == 0))


def val_loss_mean(
    df: DataFrame,
    loss: str = "loss",
    by: Sequence[str] = ("run", "step"),
    rank: str = "rank",
) -> DataFrame:
    """Mean loss per rank, then the unweighted mean over ranks; 0 for no losses."""
    per_rank = df.groupBy(*by, rank).agg(
        F.coalesce(F.avg(loss), F.lit(0.0)).alias("_loss")
    )
    return per_rank.groupBy(*by).agg(F.avg("_loss").alias("val_loss"))


def best_so_far(
    df: DataFrame,
    step: str = "step",
    loss: str = "loss",
    by: Sequence[str] = ("run",),
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``best_before`` and ``is_best``: strictly lower than all losses before."""
    out = with_running(
        df, step, mins={"best_before": F.col(loss)}, by=by, rows=rows, inclusive=False
    )
    lower = F.col("best_before").isNull() | (F.col(loss) < F.col("best_before"))
    return out.withColumn("is_best", F.coalesce(lower, F.lit(False)))


def best_checkpoint(
    df: DataFrame,
    metric: str = "loss",
    step: str = "step",
    by: Sequence[str] = ("run",),
    greater_is_better: bool = False,
) -> DataFrame:
    """The step with the best metric, the earliest of equals."""
    # nulls sort low, hence they must not enter a minimum
    rows = df.filter(F.col(metric).isNotNull())
    value = -F.col(metric) if greater_is_better else F.col(metric)
    best = rows.groupBy(*by).agg(
        F.min(F.struct(value.alias("value"), F.col(step).alias("step"))).alias("_best")
    )
    found = F.col("_best.value")
    return best.select(
        *by,
        F.col("_best.step").alias("step"),
        (-found if greater_is_better else found).alias("metric"),
    )


def lr_schedule(step: Column, base: float, warmup: int, total: int) -> Column:
    """Learning rate: linear warm-up, then a cosine to 0 at ``total`` steps."""
    progress = (step - warmup) / float(max(1, total - warmup))
    cosine = F.greatest(F.lit(0.0), 0.5 * (1.0 + F.cos(F.lit(3.141592653589793) * progress)))
    return base * F.when(step < warmup, step / float(max(1, warmup))).otherwise(cosine)


def latest_checkpoint(
    df: DataFrame, path: str = "path", by: Sequence[str] = ("run",)
) -> DataFrame:
    """The path ``checkpoint-N`` with the highest N; other names do not count."""
    numbered = df.withColumn("step", name_number(F.col(path), "checkpoint")).filter(
        "step is not null"
    )
    return numbered.groupBy(*by).agg(
        F.max_by(path, "step").alias("path"), F.max("step").alias("step")
    )


def retain_last_k(
    df: DataFrame, k: int, path: str = "path", by: Sequence[str] = ("run",)
) -> DataFrame:
    """The ``k`` latest checkpoints; Spark cuts each group to ``k`` before the shuffle."""
    numbered = df.withColumn("step", name_number(F.col(path), "checkpoint")).filter(
        "step is not null"
    )
    latest = W.partitionBy(*by).orderBy(F.col("step").desc())
    return (
        numbered.withColumn("_rn", F.row_number().over(latest))
        .filter(F.col("_rn") <= k)
        .drop("_rn")
    )


def perplexity(df: DataFrame, loss: str = "loss", by: Sequence[str] = ("run",)) -> DataFrame:
    return df.groupBy(*by).agg(F.exp(F.avg(loss)).alias("perplexity"))


def throughput(df: DataFrame, time_ms: str = "time_ms") -> DataFrame:
    """Mean time and tokens per second for each ``(batch_size, seq_len)``."""
    mean = df.groupBy("batch_size", "seq_len").agg(F.avg(time_ms).alias("time_ms"))
    tokens = F.col("batch_size") * F.col("seq_len")
    return mean.withColumn("tokens_per_sec", tokens / (F.col("time_ms") / 1000.0))


def resume_incremental(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not among those already processed."""
    return df.join(done.select(*keys), list(keys), "left_anti")


def write_epoch(df: DataFrame, path: str, epoch: int, sample: str = "sample", shard_rows: int = 100_000) -> None:
    """Store one epoch's rows as ``path/epoch=E/shard=S``, ``shard_rows`` samples to a shard."""
    placed = df.withColumn("shard", div(F.col(sample), shard_rows))
    placed = placed.repartitionByRange("shard").sortWithinPartitions("shard", sample)
    placed.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/epoch={epoch}")


def save_position(spark: SparkSession, path: str, epoch: int, sample: int, shard_rows: int = 100_000) -> None:
    """Record that ``sample`` is the next one of ``epoch``. The record is replaced whole."""
    row = spark.range(1).select(
        F.lit(epoch).cast("bigint").alias("epoch"),
        F.lit(sample).cast("bigint").alias("sample"),
        F.lit(shard_rows).cast("bigint").alias("shard_rows"),
    )
    row.write.mode("overwrite").json(path)


def resume_position(spark: SparkSession, path: str, position: str, schema: StructType, sample: str = "sample") -> DataFrame:
    """The samples that are left of the stored position's epoch and of all later ones.

    Finished epochs and shards are left out by their folders, so nothing of them is read.
    Without a record everything is left.
    """
    parts = StructType.fromDDL("epoch bigint, shard bigint")
    rows = spark.read.schema(StructType([*schema.fields, *parts.fields])).parquet(path)
    try:
        at = spark.read.schema("epoch long, sample long, shard_rows long").json(position).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return rows
    first_shard = at["sample"] // at["shard_rows"]
    same = (F.col("epoch") == at["epoch"]) & (F.col("shard") >= first_shard) & (F.col(sample) >= at["sample"])
    return rows.filter((F.col("epoch") > at["epoch"]) | same)


def _fold(
    rows: Column, best: Column, misses: Column, patience: int, delta: float, at: Column
) -> Column:
    """Run early stopping over rows ``(idx, loss, at)`` from a given state.

    ``at`` here is a null of the type of the rows' ``at``.
    """
    nothing = F.struct(F.lit(None).cast("bigint").alias("idx"), at.alias("at"))

    def state(best: Column, misses: Column, stop: Column) -> Column:
        return F.struct(
            best.cast("double").alias("best"),
            misses.cast("int").alias("misses"),
            stop.alias("stop"),
        )

    def step(s: Column, row: Column) -> Column:
        missed = s["misses"] + 1
        here = F.struct(row["idx"].alias("idx"), row["at"].alias("at"))
        return (
            F.when(s["stop"]["idx"].isNotNull(), s)
            .when(
                row["loss"] > s["best"] - delta,
                state(
                    s["best"], missed, F.when(missed >= patience, here).otherwise(nothing)
                ),
            )
            .otherwise(state(row["loss"], F.lit(0), nothing))
        )

    return F.aggregate(rows, state(best, misses, nothing), step)


def early_stop(
    df: DataFrame,
    step: str = "step",
    loss: str = "loss",
    by: Sequence[str] = ("run",),
    patience: int = 3,
    min_delta: float = 0.001,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(by, stop_index, stop_step)``: where each run stops, null if it does not.

    A loss is a miss if ``loss > best - min_delta``; ``patience`` misses in a row stop
    the run.

    The state before a chunk of rows is the number of misses since the last accepted
    loss, below ``patience``; that loss is then one of the last rows of the chunk
    before. So each chunk is folded once from each possible state, in parallel, and
    becomes a table of ``patience`` entries. Those tables compose, again in chunks.
    """
    rows = max(rows, patience)
    groups = df.select(F.struct(*by).alias("_group")).distinct()
    kept = df.filter(F.col(loss).isNotNull()).select(
        F.struct(*by).alias("_group"), F.col(step).alias("_step"), F.col(loss).alias("_loss")
    )
    ranked = with_rank(kept, "_step", "_idx", by=["_group"], rows=rows)
    chunk = div(F.col("_idx"), rows)
    # the last rows of a chunk are also the history of the next one
    is_history = F.pmod("_idx", F.lit(rows)) >= rows - patience
    chunks = F.when(is_history, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    row = F.struct(
        F.col("_idx").alias("idx"),
        F.col("_loss").cast("double").alias("loss"),
        F.col("_step").alias("at"),
    )
    no_step = F.lit(None).cast(df.schema[step].dataType)
    collected = (
        ranked.select("_group", F.explode(chunks).alias("_chunk"), row.alias("_row"))
        .groupBy("_group", "_chunk")
        .agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    )
    first = F.col("_chunk") * rows
    body = F.filter("_rows", lambda r: r["idx"] >= first)
    history = F.filter("_rows", lambda r: r["idx"] < first)

    def entry(misses: Column) -> Column:
        # ``get`` gives null before the first row of the run: no best loss yet
        best = F.get(history, F.lit(patience - 1) - misses)["loss"]
        end = _fold(body, best, misses, patience, min_delta, no_step)
        return F.struct(end["misses"].alias("misses"), end["stop"].alias("stop"))

    states = F.sequence(F.lit(0), F.lit(patience - 1))
    tables = collected.filter(F.size(body) > 0).select(
        "_group", "_chunk", F.transform(states, entry).alias("_table")
    )

    def follow(parts: Column, misses: Column) -> Column:
        start = F.struct(
            misses.cast("int").alias("misses"),
            F.struct(
                F.lit(None).cast("bigint").alias("idx"), no_step.alias("at")
            ).alias("stop"),
        )
        return F.aggregate(
            parts,
            start,
            lambda s, t: F.when(s["stop"]["idx"].isNotNull(), s).otherwise(
                F.get(t["_table"], s["misses"])
            ),
        )

    def compose(tables: DataFrame) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct("_chunk", "_table")))
        return (
            tables.groupBy("_group", div(F.col("_chunk"), rows).alias("_next"))
            .agg(parts.alias("_parts"))
            .select(
                "_group",
                F.col("_next").alias("_chunk"),
                F.transform(states, lambda m: follow(F.col("_parts"), m)).alias("_table"),
            )
        )

    # two rounds leave one table per rows**3 rows of a run
    tables = compose(compose(tables))
    parts = F.array_sort(F.collect_list(F.struct("_chunk", "_table")))
    return (
        tables.groupBy("_group")
        .agg(parts.alias("_parts"))
        .select("_group", follow(F.col("_parts"), F.lit(0))["stop"].alias("_stop"))
        .join(groups, "_group", "right")
        .select(
            *[F.col("_group")[c].alias(c) for c in by],
            F.col("_stop.idx").alias("stop_index"),
            F.col("_stop.at").alias("stop_step"),
        )
    )
