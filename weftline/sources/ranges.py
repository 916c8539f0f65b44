"""Records that do not end with their line, cut out of large files in parallel.

Spark deals a text file out by byte ranges and reads it as fragments between separators:
lines of CSV, pieces between commas of JSON. Whether a separator ends a record depends on
all that comes before it, on an open quote and on the depth of brackets. So a first pass runs
a small state machine over every range, from each state in which the range might begin, and
keeps one narrow row per range. Those rows are composed along each file, which gives every
range its true first state and the number of its first record. The second pass cuts the
ranges. Only the pieces at the edges of ranges are shuffled, to be put together.

A compressed file is one range. A record is at most 2 GB.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The states of so many ranges are broadcast; beyond that they are joined by a shuffle.
BROADCAST_RANGES = 200_000
_FAR = 1 << 40


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after the other, and where each begins."""
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Runs of rows of one range, with its file and first byte."""
    blocks = batch.column("block").to_numpy()
    paths = batch.column("path").dictionary_encode()
    names = paths.indices.to_numpy()
    change = np.flatnonzero((blocks[1:] != blocks[:-1]) | (names[1:] != names[:-1])) + 1
    bounds = [0, *change.tolist(), len(blocks)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b > a:
            yield paths.dictionary[int(names[a])].as_py(), int(blocks[a]), batch.slice(a, b - a)


class JsonFacts:
    """What one range of JSON does to the state, whether it begins outside of a string (0) or inside (1).

    A state is whether a string is open, and the depth of brackets. A backslash never
    stands before the separator, a comma, in JSON.
    """

    schema = (
        "end0 int, end1 int, delta0 long, delta1 long, low0 long, low1 long, last0 boolean, last1 boolean, "
        "ends_low0 long, ends_low1 long, ends_n0 long, ends_n1 long, tail0 long, tail1 long, "
        "first_byte int, breaks boolean"
    )

    def __init__(self) -> None:
        self.parity = 0
        self.depth = [0, 0]
        self.low = [_FAR, _FAR]
        self.pending: list[int | None] = [None, None]
        self.closes = [False, False]
        self.ends: list[dict[int, int]] = [{}, {}]
        self.tail: list[int | None] = [None, None]
        self.first: int | None = None
        self.breaks = False

    def add(self, data: np.ndarray, offsets: np.ndarray) -> None:
        solid = np.flatnonzero(~_SPACE[data])
        if self.first is None and len(solid):
            self.first = int(data[solid[0]])
        self.breaks |= bool(((data == 10) | (data == 13)).any())
        quotes = _quotes(data, offsets)
        marks = np.flatnonzero(_DEPTH[data])
        inside = (np.searchsorted(quotes, marks) + self.parity) & 1
        end_inside = (np.searchsorted(quotes, offsets[1:]) + self.parity) & 1
        for start in (0, 1):
            mine = marks[inside == start]
            depth = np.cumsum(_DEPTH[data[mine]], dtype=np.int64) + self.depth[start]
            if len(mine):
                # the last bracket of the whole range is told apart from all others
                before = [self.pending[start]] if self.pending[start] is not None else []
                self.low[start] = min([self.low[start], *before, int(depth[:-1].min(initial=_FAR))])
                self.pending[start] = int(depth[-1])
            if len(solid):
                self.closes[start] = bool(len(mine)) and mine[-1] == solid[-1]
            at = np.concatenate([[self.depth[start]], depth])[np.searchsorted(mine, offsets[1:])]
            outside = end_inside == start
            ends = at[outside]
            if self.tail[start] is not None:
                self._end(start, self.tail[start], 1)
            self.tail[start] = int(at[-1]) if outside[-1] else None
            if outside[-1]:
                ends = ends[:-1]
            if len(ends):
                least = int(ends.min())
                self._end(start, least, int((ends == least).sum()))
            if len(depth):
                self.depth[start] = int(depth[-1])
        self.parity = (self.parity + len(quotes)) & 1

    def _end(self, start: int, depth: int, n: int) -> None:
        held = self.ends[start]
        if not held or depth < min(held):
            self.ends[start] = {depth: n}
        elif depth in held:
            held[depth] += n

    def row(self) -> dict:
        out = {"first_byte": self.first, "breaks": self.breaks}
        for h in (0, 1):
            least = min(self.ends[h], default=None)
            out |= {
                f"end{h}": h ^ self.parity, f"delta{h}": self.depth[h], f"last{h}": self.closes[h],
                f"low{h}": None if self.low[h] == _FAR else self.low[h], f"tail{h}": self.tail[h],
                f"ends_low{h}": least, f"ends_n{h}": self.ends[h].get(least, 0),
            }
        return out


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
# a byte-order mark counts as blank
_SPACE[[0xEF, 0xBB, 0xBF]] = True
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[91, 123]] = 1
_DEPTH[[93, 125]] = -1


def _quotes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of quotes that no backslash escapes."""
    quotes = np.flatnonzero(data == 34)
    slash = data == 92
    if not len(quotes) or not slash.any():
        return quotes
    plain = np.where(slash, -1, np.arange(len(data)))
    starts = offsets[:-1][offsets[:-1] < len(data)]
    plain[starts] = np.maximum(plain[starts], starts - 1)
    np.maximum.accumulate(plain, out=plain)
    before = np.maximum(quotes - 1, 0)
    run = before - plain[before]
    run[np.isin(quotes, starts) | (quotes == 0)] = 0
    return quotes[run % 2 == 0]


class JsonCutter:
    """Where records end in a range of JSON, from its true first state."""

    def __init__(self, state: int, depth: int, level: int) -> None:
        self.state, self.depth, self.level = state, depth, level

    def ends(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        quotes = _quotes(data, offsets)
        marks = np.flatnonzero(_DEPTH[data])
        marks = marks[(np.searchsorted(quotes, marks) + self.state) & 1 == 0]
        depth = np.concatenate([[0], np.cumsum(_DEPTH[data[marks]], dtype=np.int64)]) + self.depth
        outside = (np.searchsorted(quotes, offsets[1:]) + self.state) & 1 == 0
        found = outside & (depth[np.searchsorted(marks, offsets[1:])] == self.level)
        self.state = (self.state + len(quotes)) & 1
        self.depth = int(depth[-1])
        return found


class CsvLines:
    """Whether a quoted field is open behind a line. A quote opens a field at its start only."""

    def __init__(self, delimiter: str) -> None:
        self.delimiter = delimiter.encode()
        self.opening = self.delimiter + b'"'
        self.close = re.compile(rb'(?:[^"]++|"")*+"')

    def after(self, line: bytes, state: int) -> int:
        """The state behind a line that begins in ``state``: 1 inside a quoted field."""
        at = 0
        if not state:
            if line.startswith(b'"'):
                at = 1
            else:
                at = line.find(self.opening) + len(self.opening)
                if at < len(self.opening):
                    return 0
        while True:
            closed = self.close.match(line, at)
            if not closed:
                return 1
            at = line.find(self.delimiter, closed.end())
            if at < 0:
                return 0
            # the next field may be quoted, else look for one that is
            if not line.startswith(self.opening, at):
                at = line.find(self.opening, at)
                if at < 0:
                    return 0
            at += len(self.opening)


class CsvFacts:
    """What one range of CSV lines does, whether a quoted field is open at its start (1) or not (0)."""

    schema = "end0 int, end1 int, count0 long, count1 long, header string"

    def __init__(self, lines: CsvLines, block: int) -> None:
        self.lines = lines
        self.state, self.count = [0, 1], [0, 0]
        self.header: list[bytes] | None = [] if block == 0 else None
        self.head: bytes | None = None

    def add(self, data: np.ndarray, offsets: np.ndarray) -> None:
        whole = data.tobytes()
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if self.header is None and self.state == [0, 1] and whole.find(b'"', a, b) < 0:
                self.count[0] += 1
                continue
            line = whole[a:b]
            self.state = [self.lines.after(line, s) if b'"' in line else s for s in self.state]
            for h in (0, 1):
                self.count[h] += self.state[h] == 0
            if self.header is not None:
                self.header.append(line)
                if not self.state[0]:
                    self.head, self.header = b"\n".join(self.header), None

    def row(self) -> dict:
        head = self.head if self.header is None else b"\n".join(self.header)
        return {
            "end0": self.state[0], "end1": self.state[1], "count0": self.count[0], "count1": self.count[1],
            "header": head.decode("utf-8", "ignore") if head is not None else None,
        }


class CsvCutter:
    def __init__(self, lines: CsvLines, state: int) -> None:
        self.lines, self.state = lines, state

    def ends(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        whole = data.tobytes()
        out = np.zeros(len(offsets) - 1, bool)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            if whole.find(b'"', a, b) >= 0:
                self.state = self.lines.after(whole[a:b], self.state)
            out[i] = not self.state
        return out


def facts(fragments: DataFrame, make, schema: str) -> DataFrame:
    """One row for each range of ``(path, block, value)``: what ``make(block)`` found out about it."""
    import pyspark.sql.pandas.types as types
    from pyspark.sql.types import StructType

    ddl = f"path string, block long, {schema}"
    arrow = types.to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for path, block, part in _segments(batch):
                if held is None or held[:2] != (path, block):
                    if held:
                        yield pa.RecordBatch.from_pylist([{"path": held[0], "block": held[1], **held[2].row()}], arrow)
                    held = (path, block, make(block))
                held[2].add(*_bytes(part.column("value")))
        if held:
            yield pa.RecordBatch.from_pylist([{"path": held[0], "block": held[1], **held[2].row()}], arrow)

    return fragments.select("path", "block", F.col("value").cast("binary").alias("value")).mapInArrow(run, ddl)


def _before(column: Column) -> Column:
    window = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def with_state(found: DataFrame) -> DataFrame:
    """Add ``state``, in which each range truly begins; every file begins in 0.

    A range maps the two states to constants, or keeps or swaps them: what counts is the last
    constant before it and the number of swaps since. Windows run over one row per range.
    """
    swap = F.when(F.col("end0") > F.col("end1"), 1).otherwise(0)
    upto = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    fixed = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").alias("value"), F.col("_swaps").alias("swaps")))
    return (
        found.withColumn("_swaps", F.sum(swap).over(upto))
        .withColumn("_fixed", F.last(fixed, ignorenulls=True).over(earlier))
        .withColumn("_sofar", _before(swap))
        .withColumn(
            "state",
            F.pmod(
                F.coalesce(F.col("_fixed.value"), F.lit(0)) + F.col("_sofar") - F.coalesce(F.col("_fixed.swaps"), F.lit(0)),
                F.lit(2),
            ).cast("int"),
        )
        .drop("_swaps", "_fixed", "_sofar")
    )


def _either(name: str) -> Column:
    return F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))


ARRAY, OBJECT = "array", "object"


def json_states(found: DataFrame) -> DataFrame:
    """(path, block, state, depth, first, total, kind) of every range.

    ``kind`` says whether the whole file is one array or one object, else it is null. ``first`` is the
    number of the record with which the range begins, ``total`` that of the file's last one. A file
    of one line that is an object is left to the readers of lines.
    """
    names = ("delta", "low", "last", "ends_low", "ends_n", "tail")
    ranges = with_state(found)
    ranges = ranges.select("path", "block", "state", "first_byte", "breaks", *[_either(n).alias(n) for n in names], _either("end").alias("end"))
    ranges = ranges.withColumn("depth", _before(F.col("delta")))
    after = F.col("depth") + F.col("delta")
    solid = F.col("first_byte").isNotNull()
    files = ranges.groupBy("path").agg(
        F.min_by("first_byte", F.when(solid, F.col("block"))).alias("opens"),
        F.max_by("last", F.when(solid, F.col("block"))).alias("closes"),
        F.max_by(after, "block").alias("final"),
        F.max_by("end", "block").alias("open_string"),
        F.least(F.min(F.col("depth") + F.col("low")), F.min(F.col("depth") + F.col("ends_low"))).alias("lowest"),
        # only the range of the last bracket may end at depth 0
        F.sum(F.when(solid & (after < 1), 1).otherwise(0)).alias("shallow"),
        F.bool_or("breaks").alias("breaks"),
    )
    one = F.expr("closes and final = 0 and open_string = 0 and coalesce(lowest, 1) >= 1 and shallow = 1")
    kind = F.when(F.col("opens") == 91, ARRAY).when((F.col("opens") == 123) & F.col("breaks"), OBJECT)
    files = files.filter(one).select("path", kind.alias("kind")).filter("kind is not null")
    at_level = F.when(F.col("depth") + F.col("ends_low") == 1, F.col("ends_n")).otherwise(0) + F.when(
        F.col("depth") + F.col("tail") == 1, 1
    ).otherwise(0)
    whole = W.partitionBy("path")
    return (
        ranges.join(files, "path", "left")
        .withColumn("_n", F.when(F.col("kind") == ARRAY, F.coalesce(at_level, F.lit(0))).otherwise(0).cast("bigint"))
        .select(
            "path", "block", "state", "depth", _before(F.col("_n")).alias("first"),
            F.sum("_n").over(whole).alias("total"), "kind",
        )
    )


def csv_states(found: DataFrame) -> DataFrame:
    """(path, block, state, first): where each range of CSV lines begins."""
    ranges = with_state(found).withColumn("_n", _either("count"))
    return ranges.select("path", "block", "state", _before(F.col("_n")).alias("first"))


def with_states(fragments: DataFrame, states: DataFrame) -> DataFrame:
    """Fragments with the state of their range, in the order of the file.

    A broadcast keeps the order of the scan; a shuffle does not, so that rows are sorted after it.
    """
    if states.count() <= BROADCAST_RANGES:
        return fragments.join(F.broadcast(states), ["path", "block"], "left")
    joined = fragments.join(states.hint("shuffle_hash"), ["path", "block"], "left")
    return joined.sortWithinPartitions("path", "block", "row")


def cut(fragments: DataFrame, states: DataFrame, make, separator: str) -> DataFrame:
    """Records ``(path, record, value)``, numbered in each file.

    ``make`` gets the first row of a range and returns what finds the ends of records, or None for
    a file to leave out. Records inside a range come straight from the scan. Both passes must see the
    same ranges (see ``prepare_session``); one that the first pass did not see is an error.
    """
    joined = with_states(fragments.withColumn("value", F.col("value").cast("binary")), states)
    schema = pa.schema(
        [("path", pa.string()), ("record", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("value", pa.binary())]
    )
    comma = separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_now, cutter, record, pending, begun = None, None, 0, [], False

        def piece(whole: bool) -> pa.RecordBatch:
            row = {"path": range_now[0], "record": record, "block": range_now[1], "whole": whole, "value": comma.join(pending)}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for path, block, part in _segments(batch):
                if range_now != (path, block):
                    if pending:
                        yield piece(False)
                    first = {c: part.column(c)[0].as_py() for c in part.schema.names if c != "value"}
                    if first["state"] is None:
                        raise ValueError(f"files or sizes of ranges changed between two passes: {path}, byte {block}")
                    range_now, cutter, record, pending, begun = (path, block), make(first), first["first"], [], False
                if cutter is None:
                    continue
                data, offsets = _bytes(part.column("value"))
                ends = np.flatnonzero(cutter.ends(data, offsets))
                if not len(ends):
                    pending.append(_joined(data, offsets, comma))
                    continue
                head = int(ends[0]) + 1
                pending.append(_joined(data[: offsets[head]], offsets[: head + 1], comma))
                # what stands before the first end may have begun in an earlier range
                yield piece(begun or block == 0)
                begun = True
                record += 1
                last = int(ends[-1]) + 1
                if last > head:
                    values = _records(data[offsets[head] : offsets[last]], offsets[head : last + 1] - offsets[head], ends[1:] - head, comma)
                    n = len(values)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * n, pa.string()), pa.array(np.arange(record, record + n)),
                         pa.array(np.full(n, block)), pa.array(np.ones(n, bool)), values], schema=schema,
                    )
                    record += n
                pending = []
                if last < len(offsets) - 1:
                    pending.append(_joined(data[offsets[last] :], offsets[last:] - offsets[last], comma))
        if pending:
            yield piece(False)

    found = joined.mapInArrow(run, "path string, record long, block long, whole boolean, value binary")
    pieces = F.array_sort(F.collect_list(F.struct("block", F.col("value").cast("string").alias("value"))))
    stitched = found.filter(~F.col("whole")).groupBy("path", "record").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), separator).alias("value"))
    return found.filter("whole").select("path", "record", F.col("value").cast("string").alias("value")).unionByName(stitched)


def _joined(data: np.ndarray, offsets: np.ndarray, comma: bytes) -> bytes:
    """Fragments with the separator between them."""
    return _spread(data, offsets, np.zeros(0, np.int64), comma)[0].tobytes()


def _records(data: np.ndarray, offsets: np.ndarray, ends: np.ndarray, comma: bytes) -> pa.Array:
    """Fragments as records, of which each ends with a fragment of ``ends``."""
    out, at = _spread(data, offsets, ends, comma)
    places = np.concatenate([[0], at]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(out)])


def _spread(data: np.ndarray, offsets: np.ndarray, ends: np.ndarray, comma: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with a separator behind each fragment but the last and those of ``ends``, and where the latter end."""
    n = len(offsets) - 1
    gap = np.ones(n, np.int64)
    gap[ends] = 0
    gap[-1] = 0
    before = np.cumsum(gap)
    out = np.full(len(data) + int(before[-1]), comma[0], np.uint8)
    shift = before - gap
    out[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = data
    return out, offsets[1:][ends] + shift[ends]
