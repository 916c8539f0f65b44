"""Spelling variants: frequent words grouped by single edits, with dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one into the other,
which is so if their common prefix and suffix together reach the longer length minus one.
Words become padded matrices of code points, aligned at both ends, and block pairs are
compared whole, column by column.

Not every block meets every other. With m the shorter length and h its half, a near pair
agrees in the first h code points or in the last m - h, so words meet under the key (side, m, part)
only. A key with many words is dealt into blocks, one task to each pair of blocks, so
no key is gathered in one place; small keys share tasks, sorted, and only blocks whose key
ranges meet are compared. A pair found from both sides counts on the prefix side. Tasks
give sums and best words by word, never pairs.

Null and empty texts have no words; a null key counts as empty text. Repeated rows count
like any others. Equal counts go by the smaller word in code-point order. No words give no
rows. Only the key and the text are read; no word, text or group is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.store import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "[a-zÀ-ÿ]"
#: A key with more words than this is dealt into blocks of about this size.
BLOCK = 2048
#: Words of small keys in one task, about.
TASK = 16_384
#: Rows of one dense tile.
TILE = 128
#: A form is this much more frequent than the word.
RATIO = 5


def typed_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, slips: int = 199) -> DataFrame:
    """One row for each run of ``shortest`` or more letters, with the slips of ``key`` put in.

    Where the crc32 of ``<key>:<run>`` is a multiple of ``slips``, the code point at that number modulo
    the length is deleted.
    """
    runs = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"({LETTERS}{{{shortest},}})"), F.lit(1))
    found = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    code = F.crc32(F.concat("id", F.lit(":"), "run"))
    found = found.select("run", code.alias("code"), F.length("run").alias("size"))
    at = (F.col("code") % F.col("size")).cast("int")
    left_out = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    return found.select(F.when(F.col("code") % slips == 0, left_out).otherwise(F.col("run")).alias("word"))


def frequent(words: DataFrame, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of words with ``shortest`` or more code points and ``least`` or more rows."""
    counts = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least)


def _keyed(words: DataFrame) -> DataFrame:
    """Four rows for each word: on either side, as one of the shorter length m or one of m + 1."""
    size = F.length("word")

    def row(side: int, longer: int) -> Column:
        m = size - longer
        half = F.floor(m / 2).cast("int")
        part = F.substring("word", F.lit(1), half) if side == 0 else F.substring("word", size - (m - half) + 1, m - half)
        return F.struct(F.lit(side).alias("side"), m.alias("m"), part.alias("part"))

    rows = F.array(*[row(side, longer) for side in (0, 1) for longer in (0, 1)])
    return words.select("word", "n", F.explode(rows).alias("at")).select("at.*", "word", "n")


def _tiled(keyed: DataFrame, total: int, block: int, task: int) -> DataFrame:
    """Rows with the task they go to: ``one`` and ``two`` are the blocks it compares, ``mine`` this row's."""
    key = ["side", "m", "part"]
    sizes = keyed.groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > block)
    sized = keyed.join(sizes, key, "left")
    tasks = max(1, 4 * total // task)
    small = sized.where("size is null").select(
        "side", "m", F.pmod(F.xxhash64("part", "m", "side"), F.lit(tasks)).alias("bucket"),
        F.lit(-1).alias("one"), F.lit(-1).alias("two"), F.lit(-1).alias("mine"), "part", "word", "n",
    )
    large = sized.where("size is not null").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    large = large.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = large.select(
        "side", "m", F.xxhash64("part").alias("bucket"), F.least("mine", "other").alias("one"),
        F.greatest("mine", "other").alias("two"), "mine", "part", "word", "n",
    )
    return small.unionByName(large)


def _matrix(words: list[str], width: int, left: bool) -> np.ndarray:
    """Code points, one row for each word, aligned at the left or at the right; 0 is no code point.

    Transposed: what is compared is one column of all words after the other.
    """
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    within = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    row = np.repeat(np.arange(len(words)), sizes)
    out = np.zeros((width, len(words)), np.uint32)
    out[within if left else within + np.repeat(width - sizes, sizes), row] = flat
    return out.astype(np.uint16) if not len(flat) or flat.max() < 1 << 16 else out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common run from the first column on, for all pairs of rows."""
    alive = np.ones((a.shape[1], b.shape[1]), bool)
    out = np.zeros(alive.shape, np.int32)
    for one, two in zip(a, b, strict=True):
        alive &= one[:, None] == two[None, :]
        if not alive.any():
            break
        out += alive & (one != 0)[:, None]
    return out


class _Words:
    """Words of one length, in order of their key part, cut into tiles."""

    def __init__(self, words: list[str], parts: list[str], width: int, tile: int) -> None:
        self.size = len(words[0]) if words else 0
        self.left = _matrix(words, width, True)
        self.right = _matrix(words, width, False)[::-1]
        self.tiles = [(a, min(a + tile, len(words))) for a in range(0, len(words), tile)]
        self.ends = [(parts[a], parts[b - 1]) for a, b in self.tiles]


def near_pairs(one: _Words, two: _Words, side: int, half: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of near words in ``one`` and ``two``, tile pair by tile pair; ``same`` if both are one list."""
    longer = max(one.size, two.size)
    begin = 0
    for i, (a, b) in enumerate(one.tiles):
        while begin < len(two.tiles) and two.ends[begin][1] < one.ends[i][0]:
            begin += 1
        for j in range(max(begin, i) if same else begin, len(two.tiles)):
            if two.ends[j][0] > one.ends[i][1]:
                break
            c, d = two.tiles[j]
            prefix = _common(one.left[:, a:b], two.left[:, c:d])
            found = prefix >= half if side == 0 else prefix < half
            if not found.any():
                continue
            found &= prefix + _common(one.right[:, a:b], two.right[:, c:d]) >= longer - 1
            if same and i == j:
                found = np.triu(found, 1)
            u, v = np.nonzero(found)
            if len(u):
                yield u + a, v + c


def _compare(side: int, m: int, rows: list[tuple[int, str, str, int]], tile: int) -> dict[str, list]:
    """Near counts and best words of the rows (block, part, word, n) of one task."""
    rows.sort(key=lambda r: (r[1], r[2]))
    words = [r[2] for r in rows]
    n = np.array([r[3] for r in rows], np.int64)
    # place in the order of choice: largest n, then smallest word
    order = np.lexsort((np.argsort(np.argsort(np.array(words, object))), -n))
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    count = np.zeros(len(rows), np.int64)
    best = np.full(len(rows), len(rows), np.int64)
    # a very long word makes a tile of fewer rows
    tile = max(1, min(tile, (1 << 20) // (m + 1)))
    blocks = sorted({r[0] for r in rows})
    lists = {}
    for block in blocks:
        for longer in (0, 1):
            at = [i for i, r in enumerate(rows) if r[0] == block and len(r[2]) == m + longer]
            lists[block, longer] = np.array(at, np.int64), _Words([words[i] for i in at], [rows[i][1] for i in at], m + 1, tile)

    def add(one: tuple[int, int], two: tuple[int, int]) -> None:
        (place, first), (other, second) = lists[one], lists[two]
        for u, v in near_pairs(first, second, side, m // 2, one == two):
            u, v = place[u], other[v]
            np.add.at(count, u, 1)
            np.add.at(count, v, 1)
            np.minimum.at(best, u, rank[v])
            np.minimum.at(best, v, rank[u])

    first, last = blocks[0], blocks[-1]
    add((first, 0), (last, 0))
    add((first, 0), (last, 1))
    if first != last:
        add((last, 0), (first, 1))
    hit = np.flatnonzero(count)
    chosen = order[best[hit]]
    return {
        "word": [words[i] for i in hit], "n_near": count[hit].tolist(),
        "near_n": n[chosen].tolist(), "near": [words[i] for i in chosen],
    }


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def nearest(words: DataFrame, block: int = BLOCK, task: int = TASK, tile: int = TILE) -> DataFrame:
    """(word, n_near, near, near_n) of every word with a near word: how many, and the most frequent."""
    tiled = _tiled(_keyed(words), words.count(), block, task)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        side, m, _, one, two = (k.as_py() for k in key)
        columns = [table.column(c).to_pylist() for c in ("mine", "part", "word", "n")]
        rows = list(zip(*columns, strict=True))
        # a task on two different blocks compares across them only
        if one != two and len({r[0] for r in rows}) < 2:
            return _FOUND.empty_table()
        return pa.Table.from_pydict(_compare(side, m, rows, tile), _FOUND)

    found = tiled.groupBy("side", "m", "bucket", "one", "two").applyInArrow(
        run, "word string, n_near long, near_n long, near string"
    )
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.order")).alias("near_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of a chain of forms, by doubling. Counts grow along a chain, so it ends."""
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        step = written(step, "roots")
        if step.where("next is not null").isEmpty():
            return step.select("word", "root")
        reached = step.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK, task: int = TASK, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) from (word, n): the form is the most frequent near word,
    if it is ``ratio`` times as frequent; the root is where the chain of forms ends."""
    words = written(words, "words")
    near = nearest(words, block, task, tile)
    better = F.col("near_n") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", F.when(better, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("near_n")).alias("form_n"),
    )
    found = written(found, "forms")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
