"""Registered queries: run logs, with events as the log.

A run is an event type (or a user), its losses are the event values in event order,
an epoch is a week and a rank is ``user_id % 4``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import runlog, split
from weftline.operators.ranks import div, with_rank
from weftline.plans.registry import query, table
from weftline.session import scratch_path

LOG_CTE = """WITH e AS (SELECT event_id, event_type AS run,
        date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) // 7 AS epoch,
        user_id % 4 AS rank, value AS loss FROM events),
    log AS (SELECT *, row_number() OVER (PARTITION BY run, epoch ORDER BY event_id) - 1
        AS micro_step FROM e)"""


def events_log(spark, sf_dir):
    days = F.datediff("ts", F.lit("2024-01-01"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("run"),
        div(days.cast("bigint"), 7).alias("epoch"),
        (F.col("user_id") % 4).alias("rank"),
        F.col("value").alias("loss"),
    )


def micro_log(spark, sf_dir):
    return with_rank(
        events_log(spark, sf_dir), "event_id", "micro_step", by=["run", "epoch"]
    )


@query(
    LOG_CTE
    + """, w AS (SELECT event_id, run, epoch, round(loss * 100)::BIGINT AS cents FROM log)
    SELECT event_id, run, epoch, (sum(cents) OVER so_far)::DOUBLE / count(*) OVER so_far AS avg_loss FROM w
    WINDOW so_far AS (PARTITION BY run, epoch ORDER BY event_id ROWS UNBOUNDED PRECEDING)"""
)
def running_avg_loss(spark, sf_dir):
    """Losses as whole cents, whose sums are exact in any order."""
    log = events_log(spark, sf_dir).withColumn("loss", F.round(F.col("loss") * 100).cast("double"))
    out = runlog.running_avg_loss(log, step="event_id")
    return out.select("event_id", "run", "epoch", "avg_loss")


STEPS_SQL = (
    LOG_CTE
    + """, n AS (SELECT run, epoch, count(*) // 4 AS steps FROM log GROUP BY run, epoch),
    b AS (SELECT run, epoch, coalesce(sum(steps) OVER (PARTITION BY run ORDER BY epoch
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM n),
    steps AS (SELECT event_id, run, epoch, micro_step,
        before + (micro_step + 1) // 4 AS step, (micro_step + 1) % 4 = 0 AS is_step
        FROM log JOIN b USING (run, epoch))"""
)


@query(STEPS_SQL + " SELECT * FROM steps")
def optimizer_steps(spark, sf_dir):
    out = runlog.optimizer_steps(micro_log(spark, sf_dir), 4)
    return out.select("event_id", "run", "epoch", "micro_step", "step", "is_step")


@query(STEPS_SQL + " SELECT event_id, run, step FROM steps WHERE is_step AND step % 10 = 0")
def every_n_steps(spark, sf_dir):
    steps = runlog.optimizer_steps(micro_log(spark, sf_dir), 4)
    return runlog.every_n_steps(steps, 10).select("event_id", "run", "step")


@query(
    LOG_CTE
    + """, r AS (SELECT run, epoch, rank, avg(loss) AS l FROM log GROUP BY ALL)
    SELECT run, epoch, round(avg(l), 6) AS val_loss FROM r GROUP BY run, epoch"""
)
def val_loss_mean(spark, sf_dir):
    out = runlog.val_loss_mean(events_log(spark, sf_dir), by=["run", "epoch"])
    return out.select("run", "epoch", F.round("val_loss", 6).alias("val_loss"))


@query(
    """SELECT event_id, run, best_before, coalesce(loss < best_before, true) AS is_best FROM (
    SELECT event_id, event_type AS run, value AS loss, min(value) OVER (PARTITION BY
    event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS best_before FROM events)"""
)
def best_so_far(spark, sf_dir):
    out = runlog.best_so_far(events_log(spark, sf_dir), step="event_id")
    return out.select("event_id", "run", "best_before", "is_best")


@query(
    """SELECT user_id AS run, event_id AS step, value AS metric FROM (SELECT *, row_number()
    OVER (PARTITION BY user_id ORDER BY value, event_id) AS rn FROM events) WHERE rn = 1"""
)
def best_checkpoint(spark, sf_dir):
    log = table(spark, sf_dir, "events").withColumnRenamed("user_id", "run")
    return runlog.best_checkpoint(log, "value", "event_id")


EARLY_STOP_SQL = """WITH RECURSIVE r AS (SELECT user_id AS run, event_id, value AS loss, row_number() OVER (
        PARTITION BY user_id ORDER BY event_id) - 1 AS idx FROM events),
    f AS (SELECT run, 0::BIGINT AS idx, event_id, loss AS best, 0 AS misses FROM r
            WHERE idx = 0
        UNION ALL SELECT r.run, r.idx, r.event_id,
            CASE WHEN r.loss > f.best - 0.5 THEN f.best ELSE r.loss END,
            CASE WHEN r.loss > f.best - 0.5 THEN f.misses + 1 ELSE 0 END
        FROM f JOIN r ON r.run = f.run AND r.idx = f.idx + 1 WHERE f.misses < 12),
    s AS (SELECT run, idx, event_id FROM f WHERE misses >= 12)
    SELECT run, s.idx AS stop_index, s.event_id AS stop_step
    FROM (SELECT DISTINCT run FROM r) LEFT JOIN s USING (run)"""


@query(EARLY_STOP_SQL)
def early_stop(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.col("value").alias("loss"),
    )
    return runlog.early_stop(log, patience=12, min_delta=0.5, rows=64)


@query(
    """SELECT event_id, round(1e6 * 5e-5 * CASE WHEN event_id < 500 THEN event_id / 500.0
    ELSE greatest(0, 0.5 * (1 + cos(pi() * (event_id - 500) / (n - 500)))) END, 6) AS lr
    FROM events, (SELECT 20000.0 AS n)"""
)
def lr_schedule(spark, sf_dir):
    lr = runlog.lr_schedule(F.col("event_id"), 5e-5, 500, 20000)
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(1e6 * lr, 6).alias("lr")
    )


CHECKPOINT = """'runs/' || user_id || CASE WHEN event_type = 'error'
    THEN '/checkpoint-error-' ELSE '/checkpoint-' END || event_id"""


def checkpoints(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.expr(CHECKPOINT).alias("path")
    )


def latest_sql(k: int) -> str:
    return f"""SELECT run, path, step FROM (SELECT user_id AS run, {CHECKPOINT} AS path,
    event_id AS step, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
    FROM events WHERE event_type <> 'error') WHERE rn <= {k}"""


@query(latest_sql(1))
def latest_checkpoint(spark, sf_dir):
    return runlog.latest_checkpoint(checkpoints(spark, sf_dir))


@query(latest_sql(3))
def retain_last_k(spark, sf_dir):
    return runlog.retain_last_k(checkpoints(spark, sf_dir), 3)


@query(
    """SELECT event_type AS run, round(exp(avg(value / 100)), 6) AS perplexity FROM events
    GROUP BY event_type"""
)
def perplexity(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), (F.col("value") / 100).alias("loss")
    )
    return runlog.perplexity(log).withColumn("perplexity", F.round("perplexity", 6))


@query(
    """SELECT batch_size, seq_len, round(avg(value), 6) AS time_ms,
    round(batch_size * seq_len / (avg(value) / 1000), 3) AS tokens_per_sec FROM (
    SELECT user_id % 8 + 1 AS batch_size, 128 * length(event_type) AS seq_len, value
    FROM events) GROUP BY batch_size, seq_len"""
)
def throughput(spark, sf_dir):
    timings = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 8 + 1).alias("batch_size"),
        (128 * F.length("event_type")).cast("bigint").alias("seq_len"),
        F.col("value").alias("time_ms"),
    )
    return runlog.throughput(timings).select(
        "batch_size",
        "seq_len",
        F.round("time_ms", 6).alias("time_ms"),
        F.round("tokens_per_sec", 3).alias("tokens_per_sec"),
    )


@query("SELECT event_id, value FROM events WHERE event_type NOT IN ('view', 'click')")
def resume_incremental(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    done = events.filter("event_type in ('view', 'click')")
    return runlog.resume_incremental(events, done, ["event_id"]).select(
        "event_id", "value"
    )


@query(
    """WITH e AS (SELECT epoch, event_id, row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || epoch || ':' || event_id),
        event_id) - 1 AS sample FROM events, (SELECT unnest(range(3)) AS epoch)), n AS (SELECT count(*) AS n FROM events)
    SELECT epoch, sample, event_id FROM e, n WHERE epoch = 1 AND sample >= n * 2 // 5 OR epoch = 2"""
)
def resume_position(spark, sf_dir):
    """Three shuffled epochs in shards; training stopped two fifths into the second."""
    path = scratch_path(spark, "epochs")
    events = table(spark, sf_dir, "events").select("event_id", "value")
    rows = events.count()
    for epoch in range(3):
        shuffled = split.shuffle_epoch(events, "event_id", 42, epoch, "sample")
        runlog.write_epoch(shuffled, f"{path}/data", epoch, shard_rows=max(1, rows // 40))
    runlog.save_position(spark, f"{path}/position", 1, rows * 2 // 5, max(1, rows // 40))
    left = runlog.resume_position(spark, f"{path}/data", f"{path}/position", shuffled.schema)
    return left.select("epoch", "sample", "event_id")
