"""Hooks for Python code that works on batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

BatchFunction = Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]
CollateFunction = Callable[[pa.Table], pa.Table]


def map_batches(
    df: DataFrame, load: Callable[[], BatchFunction], schema: StructType | str
) -> DataFrame:
    """Send Arrow batches through a function that may give any number of rows.

    For extractors and tokenizers that make several rows of one. ``load`` builds the
    function once per task; the batches of a task come one after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = load()
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def collate_batches(
    df: DataFrame,
    load: Callable[[], CollateFunction],
    schema: StructType | str,
    batch: str = "batch_id",
    order: Sequence[str] = (),
) -> DataFrame:
    """Send every batch of rows as one Arrow table, in order, through a function.

    ``batch`` numbers batches of a bounded size (see ``split.batches``), and one batch is all
    that a task holds at a time. ``load`` builds the function, as in ``map_batches``; it gives
    a table of ``schema``. Rows with a null in ``batch`` are a batch too.
    """
    by = [(name, "ascending") for name in order]

    def run(table: pa.Table) -> pa.Table:
        return load()(table.sort_by(by) if by else table)

    return df.groupBy(batch).applyInArrow(run, schema)


def stack_batches(
    df: DataFrame,
    length: int,
    key: str,
    batch: str = "batch_id",
    order: Sequence[str] = (),
    columns: Sequence[str] = ("input_ids", "labels"),
) -> DataFrame:
    """One row for each batch: ``columns`` as lists of rows that are all ``length`` wide.

    A row of another width, or without ids, cannot be stacked: its key is in ``short``, and
    it is in no list. ``rows`` counts the stacked ones.
    """
    names = list(columns)
    kept = df.select(batch, key, *[c for c in order if c not in (batch, key)], *names)
    types = {c: df.schema[c].dataType.simpleString() for c in (batch, key, *names)}
    lists = ", ".join(f"{c} array<{types[c]}>" for c in names)
    schema = f"{batch} {types[batch]}, rows long, {lists}, short array<{types[key]}>"

    def load() -> CollateFunction:
        def stack(table: pa.Table) -> pa.Table:
            fits = None
            for name in names:
                whole = pc.fill_null(pc.equal(pc.list_value_length(table.column(name)), length), False)
                fits = whole if fits is None else pc.and_(fits, whole)
            good, short = table.filter(fits), table.filter(pc.invert(fits))
            out = [table.column(batch).slice(0, 1).combine_chunks(), pa.array([good.num_rows], pa.int64())]
            for name, rows in [*[(c, good) for c in names], (key, short)]:
                values = rows.column(name).combine_chunks()
                out.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            return pa.Table.from_arrays(out, names=[batch, "rows", *names, "short"])

        return stack

    return collate_batches(kept, load, schema, batch, order)
