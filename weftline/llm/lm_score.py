"""Stupid-backoff language-model scores of every document under all other documents.

The counts of an n-gram are those of the whole corpus less the document's own, so that a
document does not vouch for itself. At each word the longest seen n-gram counts:
count(n-gram) / count(its context), times ``ALPHA`` for every word of context given up; an
unseen word counts as 1 / (tokens + 1) with one more factor. Logarithms are summed per document.

Documents are written once in blocks of about ``BLOCK_BYTES``, bucketed by block. A block explodes into
n-grams and asks for the counts of its distinct ones; requests are shuffled to the partition
of their hash, where the count table of that partition is summed up and joined to them; the counts
go back to the block by its number, without moving the texts. Unigrams and bigrams are
counted first. A longer n-gram is asked for only where both n-grams one shorter are seen in
other documents, since otherwise its own count is zero.

Requests and answers travel as sorted 64-bit hashes and counts, a row for each block and
partition. A frequent n-gram is one number per block, never a row per occurrence.

Null and empty texts have no token: ``log_score`` 0, ``mean_log`` null. Repeated rows are
separate documents, each vouching for the others. Columns but the key and the text are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import mix, slices
from weftline.llm.decontaminate import words_of
from weftline.llm.store import written
from weftline.session import scratch_path

ORDER, ALPHA = 3, 0.4
BLOCK_BYTES = 4 << 20

_REQUEST = "block long, n int, part int, hashes binary, counts binary"
_ANSWER = "block long, n int, part int, totals binary"


def squeeze(values: np.ndarray) -> bytes:
    """64-bit numbers with their bytes by place, so that what is zero in all of them compresses."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unsqueeze(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").reshape(-1)


def _in_blocks(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", size):
                words, _ = words_of(part.column("text"))
                keys, texts = (pa.array([part.column(c).to_pylist()], pa.list_(part.column(c).type)) for c in ("key", "text"))
                yield pa.RecordBatch.from_arrays([keys, texts, pa.array([len(words)], pa.int64())], names=["keys", "texts", "words"])

    kind = source.schema["key"].dataType.simpleString()
    packed = source.mapInArrow(run, f"keys array<{kind}>, texts array<string>, words long")
    return packed.withColumn("block", F.monotonically_increasing_id())


class _Block:
    """The n-grams of a block by position, and what is known of them."""

    def __init__(self, texts: pa.Array) -> None:
        words, self.firsts = words_of(texts)
        sizes = np.diff(self.firsts)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.at = np.arange(len(words)) - np.repeat(self.firsts[:-1], sizes)
        self.tokens = np.repeat(sizes, sizes)
        self.hashes = {1: mix(words)}
        self.others: dict[int, np.ndarray] = {}

    def grams(self, n: int) -> np.ndarray:
        """The hash of the n words that end at each position; only where ``at >= n - 1`` it means something."""
        if n not in self.hashes:
            shorter, out = self.grams(n - 1), self.hashes[1].copy()
            out[1:] = mix(shorter[:-1] * np.uint64(3) + self.hashes[1][1:] + np.uint64(n))
            self.hashes[n] = out
        return self.hashes[n]

    def wanted(self, n: int) -> np.ndarray:
        """Positions whose n-gram may be in another document."""
        fits = self.at >= n - 1
        if n > 2:
            seen = self.others[n - 1] > 0
            fits[1:] &= seen[1:] & seen[:-1]
        return np.flatnonzero(fits)

    def learn(self, n: int, totals: np.ndarray) -> None:
        """Take the corpus counts of the distinct wanted n-grams; keep those of other documents."""
        places = self.wanted(n)
        grams = self.grams(n)[places]
        _, inverse = np.unique(grams, return_inverse=True)
        owned = mix(grams + self.owner[places].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, same, own = np.unique(owned, return_inverse=True, return_counts=True)
        self.others[n] = np.zeros(len(self.at), dtype=np.int64)
        self.others[n][places] = totals[inverse] - own[same]

    def scores(self, order: int, total: int) -> np.ndarray:
        """The logarithm of each word's score."""
        history = np.minimum(self.at, order - 1)
        left = total - self.tokens
        # nothing seen: one factor more than for the word alone
        out = (history + 1) * np.log(ALPHA) - np.log(left + 1.0)
        for n in range(1, order + 1):
            seen = np.flatnonzero(self.others[n] > 0)
            below = left[seen] if n == 1 else self.others[n - 1][seen - 1]
            out[seen] = np.log(self.others[n][seen] / below) + (history[seen] - (n - 1)) * np.log(ALPHA)
        return out


def _parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition's share of sorted hashes begins: partitions are ranges of the hash."""
    edges = np.array([(p << 64) // parts for p in range(parts)], dtype=np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def _ask(block: _Block, number: int, orders: list[int], parts: int) -> pa.Table:
    rows = []
    for n in orders:
        hashes, counts = np.unique(block.grams(n)[block.wanted(n)], return_counts=True)
        bounds = _parts(hashes, parts)
        for p in np.flatnonzero(np.diff(bounds)):
            own = hashes[bounds[p] : bounds[p + 1]]
            rows.append((number, n, int(p), squeeze(np.diff(own, prepend=np.uint64(0)).view(np.int64)), squeeze(counts[bounds[p] : bounds[p + 1]])))
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.table({c: pa.array(v, t) for c, v, t in zip(("block", "n", "part", "hashes", "counts"), columns, kinds, strict=True)})


def answer(requests: DataFrame) -> DataFrame:
    """Sum the count table of every partition and give each request its totals."""

    def run(table: pa.Table) -> pa.Table:
        asked = [np.cumsum(unsqueeze(x.as_py()).view(np.uint64)) for x in table.column("hashes")]
        counts = np.concatenate([unsqueeze(x.as_py()) for x in table.column("counts")])
        _, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        totals = np.zeros(int(inverse.max()) + 1, dtype=np.int64)
        np.add.at(totals, inverse, counts)
        bounds = np.cumsum([0, *map(len, asked)])
        out = [squeeze(totals[inverse[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return table.select(["block", "n", "part"]).append_column("totals", pa.array(out, pa.binary()))

    return requests.groupBy("n", "part").applyInArrow(run, _ANSWER)


def _known(table: pa.Table, orders: int) -> tuple[int, _Block]:
    """A block with all the answers it has got."""
    block = _Block(table.column("texts").combine_chunks().flatten())
    answers = (table.column("answers")[0].as_py() or []) if "answers" in table.column_names else []
    for n in range(1, orders + 1):
        own = sorted((a["part"], a["totals"]) for a in answers if a["n"] == n)
        block.learn(n, np.concatenate([np.zeros(0, np.int64), *(unsqueeze(t) for _, t in own)]))
    return table.column("block")[0].as_py(), block


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row: the key, ``tokens``, ``log_score`` and ``mean_log``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType.simpleString()
    name = f"blocks_{uuid.uuid4().hex}"
    writer = _in_blocks(docs, key, text, block_bytes).write.bucketBy(parts, "block").option("compression", "zstd")
    writer.option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    blocks = spark.table(name)
    total = blocks.agg(F.sum("words").alias("words")).first()["words"] or 0

    def asking(orders: list[int]):
        def run(table: pa.Table) -> pa.Table:
            number, block = _known(table, orders[0] - 1)
            return _ask(block, number, orders, parts)

        return run

    def scored(table: pa.Table) -> pa.Table:
        _, block = _known(table, order)
        tokens = np.diff(block.firsts)
        # each document is summed by itself, so that its score does not depend on its block
        sums = np.array([part.sum() for part in np.split(block.scores(order, total), block.firsts[1:-1])])
        keys = table.column("keys").combine_chunks().flatten()
        mean = pa.array(sums / np.maximum(tokens, 1), mask=tokens == 0)
        return pa.table({"key": keys, "tokens": pa.array(tokens.astype(np.int64)), "log_score": pa.array(sums), "mean_log": mean})

    answers = None
    for first in [[n for n in (1, 2) if n <= order], *([n] for n in range(3, order + 1))]:
        held = _with_answers(blocks, answers)
        new = written(answer(held.groupBy("block").applyInArrow(asking(first), _REQUEST)), "counts")
        answers = new if answers is None else answers.union(new)
    out = _with_answers(blocks, answers).groupBy("block").applyInArrow(
        scored, f"key {kind}, tokens long, log_score double, mean_log double"
    )
    spark.sql(f"drop table {name}")  # the files stay
    return out.withColumnRenamed("key", key)


def _with_answers(blocks: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Blocks with their answers. The texts are bucketed by block and stay where they are."""
    if answers is None:
        return blocks.select("block", "keys", "texts")
    packed = answers.groupBy("block").agg(F.collect_list(F.struct("n", "part", "totals")).alias("answers"))
    return blocks.select("block", "keys", "texts").join(packed.hint("shuffle_hash"), "block", "left")
