"""Positions and running values over a global order, without a one-task window.

``sum(...) over (order by key)`` runs in one task. Here every row gets a bucket
that follows the order, the window runs inside the buckets, and what lies before
each bucket is added from a table with one row per bucket. A group (one run, one
source) is cut into buckets too, so its size does not matter.

Keys must be unique inside a group. Integer keys without large holes are cut by
``key div rows``, so no bucket has more than ``rows`` rows. Anything else (paths,
composite keys, sparse or repeated ids) goes through ``dense_position``, ``with_any_rank``
or ``first_part``, which number rows, not keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from weftline.session import materialize

BUCKET_ROWS = 256
FANOUT = 4096
NULL_BUCKET = -(1 << 62)


def div(a: Column, b: int | Column) -> Column:
    """Integer division that stays in 64-bit integers."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def bucket_keys(by: Sequence[str]) -> list[str]:
    return ["_by", "_bucket"] if by else ["_bucket"]


def with_bucket(
    df: DataFrame,
    key: str | Sequence[str],
    by: Sequence[str] = (),
    bucket: Column | None = None,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``_bucket`` (and ``_by``, a struct, so that null groups join like others).

    A null key comes first, in a bucket before all others.
    """
    bucket = div(F.col(key), rows) if bucket is None else bucket
    cols = {"_bucket": F.coalesce(bucket.cast("bigint"), F.lit(NULL_BUCKET))}
    if by:
        cols["_by"] = F.struct(*by)
    return df.withColumns(cols)


def bucket_offsets(
    totals: DataFrame,
    by: Sequence[str],
    sums: Sequence[str],
    mins: Sequence[str] = (),
) -> DataFrame:
    """What lies before each bucket: one row per bucket in, one row out.

    Buckets are themselves cut into runs of ``FANOUT``; only the table of those
    runs is ordered as a whole.
    """
    by = ["_by"] if by else []
    groups = [*by, "_run"]
    totals = totals.withColumn("_run", div(F.col("_bucket"), FANOUT))
    runs = totals.groupBy(*groups).agg(
        *[F.sum(c).alias(f"_run_{c}") for c in sums],
        *[F.min(c).alias(f"_run_{c}") for c in mins],
    )
    before_run = W.partitionBy(*by).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy(*groups).orderBy("_bucket").rowsBetween(
        W.unboundedPreceding, -1
    )
    runs = runs.select(
        *groups,
        *[F.sum(f"_run_{c}").over(before_run).alias(f"_run_{c}") for c in sums],
        *[F.min(f"_run_{c}").over(before_run).alias(f"_run_{c}") for c in mins],
    )
    zero = F.lit(0)
    return totals.join(runs, groups).select(
        *by,
        "_bucket",
        *[
            (
                F.coalesce(F.col(f"_run_{c}"), zero)
                + F.coalesce(F.sum(c).over(before), zero)
            ).alias(f"_off_{c}")
            for c in sums
        ],
        *[
            F.least(F.col(f"_run_{c}"), F.min(c).over(before)).alias(f"_off_{c}")
            for c in mins
        ],
    )


def with_running(
    df: DataFrame,
    key: str | Sequence[str],
    sums: Mapping[str, Column] | None = None,
    mins: Mapping[str, Column] | None = None,
    by: Sequence[str] = (),
    bucket: Column | None = None,
    rows: int = BUCKET_ROWS,
    inclusive: bool = True,
) -> DataFrame:
    """Add running sums and minima in key order, with or without the current row.

    ``key`` may be several columns if ``bucket`` is given. The rows are shuffled once, by bucket; the bucket table is built from the key
    and the measures alone.
    """
    sums, mins = dict(sums or {}), dict(mins or {})
    names = [*sums, *mins]
    base = with_bucket(df, key, by, bucket, rows).withColumns(
        {f"_m_{n}": c for n, c in {**sums, **mins}.items()}
    )
    keys = bucket_keys(by)
    totals = base.groupBy(*keys).agg(
        *[F.sum(f"_m_{n}").alias(n) for n in sums],
        *[F.min(f"_m_{n}").alias(n) for n in mins],
    )
    offsets = bucket_offsets(totals, by, list(sums), list(mins))
    order = [key] if isinstance(key, str) else list(key)
    inside = (
        W.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    )
    local = base.withColumns(
        {f"_w_{n}": F.sum(f"_m_{n}").over(inside) for n in sums}
        | {f"_w_{n}": F.min(f"_m_{n}").over(inside) for n in mins}
    )
    return local.join(offsets.hint("shuffle_hash"), keys).select(
        *df.columns,
        *[
            (F.coalesce(F.col(f"_w_{n}"), F.lit(0)) + F.col(f"_off_{n}")).alias(n)
            for n in sums
        ],
        *[F.least(f"_w_{n}", f"_off_{n}").alias(n) for n in mins],
    )


def with_rank(
    df: DataFrame,
    key: str | Sequence[str],
    name: str = "rank",
    by: Sequence[str] = (),
    bucket: Column | None = None,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add the 0-based position in key order, inside each group of ``by``."""
    one = F.lit(1).cast("bigint")
    out = with_running(df, key, {name: one}, by=by, bucket=bucket, rows=rows)
    return out.withColumn(name, F.col(name) - 1)


def is_dense(df: DataFrame, key: str, rows: int = BUCKET_ROWS) -> bool:
    """Whether a key is an integer without holes so large that buckets outnumber rows."""
    if df.schema[key].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        return False
    low, high, n = df.agg(F.min(key), F.max(key), F.count("*")).first()
    return low is None or (high - low) // rows <= n


def is_unique(df: DataFrame, key: str) -> bool:
    """Whether an integer key never repeats; nulls count as equal.

    64 neighbouring values make one row of the shuffle: their number and their bits.
    """
    word = F.shiftright(F.col(key).cast("bigint"), 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(key).bitwiseAND(63).cast("int"))
    words = df.groupBy(word.alias("word")).agg(F.count("*").alias("n"), F.bit_or(bit).alias("bits"))
    repeated = words.filter(F.col("n") > F.coalesce(F.bit_count("bits"), F.lit(1)))
    return repeated.isEmpty()


def with_any_rank(
    df: DataFrame, key: str, name: str = "rank", rows: int = BUCKET_ROWS
) -> DataFrame:
    """``with_rank`` for keys of any kind: strings, sparse or hashed numbers, nulls, repeats.

    Every row has a number of its own. Where buckets by value would not do, or keys
    repeat, the rows are range-partitioned and written in that order, so that rows with
    one key keep theirs.
    """
    if is_dense(df, key, rows) and is_unique(df, key):
        return with_rank(df, key, name, rows=rows)
    return dense_position(df, [key], name)


def key_at_rank(
    df: DataFrame,
    key: str,
    rank: Column,
    bucket: Column | None = None,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row ``(cut)``: the key at a 0-based rank, or no row beyond the end.

    ``rank`` may use the column ``total``. Only the one bucket that holds the rank
    is ordered, so a caller can cut a table in two with a plain filter.
    """
    base = with_bucket(df.select(key), key, (), bucket, rows)
    totals = base.groupBy("_bucket").agg(F.count("*").alias("n"))
    found = (
        totals.join(bucket_offsets(totals, (), ["n"]), "_bucket")
        .withColumn("total", totals.agg(F.sum("n")).scalar())
        .withColumn("_at", rank - F.col("_off_n"))
        .filter("_at >= 0 and _at < n")
    )
    # ``found`` has at most one row: the offsets cut the ranks into disjoint parts
    counts = (
        base.join(F.broadcast(found.select("_bucket", "_at")), "_bucket")
        .groupBy(key, "_bucket", "_at")
        .agg(F.count("*").alias("n"))
    )
    before = F.sum("n").over(W.partitionBy("_bucket").orderBy(key)) - F.col("n")
    return (
        counts.withColumn("_before", before)
        .filter("_before <= _at and _at < _before + n")
        .select(F.col(key).alias("cut"))
    )


def _literal(value, kind: DataType) -> Column:
    """A key as a constant; a key of several columns is a struct."""
    if isinstance(kind, StructType) and value is not None:
        fields = [_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)]
        return F.struct(*fields)
    return F.lit(value).cast(kind)


def _is_before(key: str, value: Column) -> Column:
    return (F.col(key).isNull() & value.isNotNull()) | F.coalesce(F.col(key) < value, F.lit(False))


def first_part(
    df: DataFrame, key: str, n: int, name: str, rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add a flag for the first ``n`` rows in key order, nulls first.

    The flag is a filter on the key at rank ``n``, for which keys alone are moved. Rows are
    shuffled only if the cut goes through several rows with that key, and then only those.
    """
    if is_dense(df, key, rows):
        cut = key_at_rank(df, key, F.lit(n).cast("bigint"), rows=rows).first()
    else:
        numbers = dense_position(df.select(F.col(key).alias("cut")), ["cut"], "_at")
        cut = numbers.filter(F.col("_at") == n).first()
    if cut is None:
        return df.withColumn(name, F.lit(True))
    value = _literal(cut["cut"], df.schema[key].dataType)
    before, same = _is_before(key, value), F.col(key).eqNullSafe(value)
    inside = n - df.filter(before).count()
    if not inside:
        return df.withColumn(name, before)
    tied = dense_position(df.filter(same), [key], "_at").withColumn(name, F.col("_at") < inside)
    return df.filter(~same).withColumn(name, before).unionByName(tied.drop("_at"))


def dense_position(
    df: DataFrame, order: Sequence[str | Column], name: str = "pos"
) -> DataFrame:
    """Add the 0-based position under any order: strings, composite or sparse keys.

    Range partitions follow the data (sampled), so one path or one value that holds
    a third of the rows is spread like any other. The cut points are sampled anew at
    each run, hence each row's partition and place in it are written down before the
    partitions are counted. The rows are shuffled once. Ties are put in some order, which
    then stays.
    """
    # the id is the partition number above 33 bits of the place in the partition
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "position").withColumns(
        {
            "_bucket": F.shiftright("_id", 33),
            "_at": F.col("_id").bitwiseAND((1 << 33) - 1),
        }
    )
    totals = placed.groupBy("_bucket").agg(F.count("*").alias("n"))
    # one row per partition of the sort
    offsets = F.broadcast(bucket_offsets(totals, (), ["n"]))
    return placed.join(offsets, "_bucket").select(
        *df.columns, (F.col("_off_n") + F.col("_at")).alias(name)
    )
