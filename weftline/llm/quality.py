"""Quality classifier: averaged hashed word and character n-gram vectors, softmax output.

Words are runs without white space, taken as they are; their n-grams of bytes include one
blank on either side; a word that repeats the one before it is a feature of its own. Every feature has a learned vector in a hashed table, a text is the
mean of its features' vectors, and a softmax layer gives the classes. Training is
stochastic gradient descent in numpy on a bounded sample of labelled rows, whose features
come to the driver piece by piece and lie there in files: its memory holds a piece, the model and a few numbers a row.

A null or empty text has no feature; its score is the share of the last class among the
training rows, as is every score when there was nothing to train on. Repeated rows are
answered one by one; columns but the key and the text are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from tempfile import TemporaryFile
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import Rolling, raw_bytes, runs, slices, solid_flags, sums_between

#: Training takes about this many labelled rows at most, picked by a hash of the key.
SAMPLE = 5000
#: Rows whose features go to the driver at once, each with 6 bytes a bucket at most.
PIECE = 64
BUCKET_BITS = 17
DIM = 8
WIDTHS = (3, 4, 5)
EPOCHS = 8
RATE = 0.5


@dataclass
class SubwordClassifier:
    """``vectors``: buckets by DIM. ``output``: DIM by 2. ``bias``: 2."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    prior: float

    def projected(self) -> np.ndarray:
        """Each bucket's share in the difference of the logits."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)


def _features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text bounds in them) for the words and for every n-gram width."""
    shift = np.uint64(64 - BUCKET_BITS)
    solid = solid_flags(data)
    starts, ends, firsts = runs(solid, offsets)
    words = Rolling(data)(starts, ends)
    out = [((words >> shift).astype(np.int32), firsts)]
    # one feature stands for every word that repeats the word before it
    same = np.zeros(len(words), dtype=bool)
    same[1:] = words[1:] == words[:-1]
    same[firsts[:-1][firsts[:-1] < len(words)]] = False
    again = np.flatnonzero(same)
    out.append((np.zeros(len(again), np.int32), np.searchsorted(again, firsts)))
    # one blank between texts stands for the border of the first and last words
    n = len(data)
    place = np.arange(n) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) + 1
    wide = np.full(n + len(offsets), 32, dtype=np.uint64)
    wide[place] = np.where(solid, data, 32)
    bounds = offsets + np.arange(len(offsets))
    blank = np.zeros(len(wide) + 1, dtype=np.int64)
    np.cumsum(wide == 32, out=blank[1:])
    for width in WIDTHS:
        m = len(wide) - width + 1
        if m <= 0:
            out.append((np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)))
            continue
        packed = wide[:m].copy()
        for k in range(1, width):
            packed |= wide[k : k + m] << np.uint64(8 * k)
        # no blank but at the ends
        at = np.flatnonzero(blank[width - 1 : width - 1 + m] == blank[1 : m + 1])
        grams = packed[at] | np.uint64(width << 56)
        out.append((((grams * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int32), np.searchsorted(at, bounds)))
    return out


def _training_rows(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            labels = part.column("label").to_pylist()
            found = _features(*raw_bytes(part.column("text")))
            ids, counts = [], []
            for i in range(len(labels)):
                own = np.concatenate([b[at[i] : at[i + 1]] for b, at in found])
                values, times = np.unique(own, return_counts=True)
                ids.append(values.astype("<i4").tobytes())
                counts.append(np.minimum(times, 65535).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("place"), pa.array(labels, pa.int32()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                names=["place", "label", "ids", "counts"],
            )


def sampled(labelled: DataFrame, key: str, sample: int) -> DataFrame:
    """About ``sample`` rows at most, by a hash of the key; adds the hash as ``place``.

    Where keys repeat, the first rows by hash of key and text count. A partition has about PIECE rows.
    """
    marked = labelled.withColumn("place", F.xxhash64(key))
    rows = max(1, marked.count())
    share = F.col("place").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    picked = marked.where(share * rows < sample).orderBy("place", F.xxhash64("text")).limit(2 * sample)
    return picked.repartition(-(-min(rows, sample) // PIECE))


def _mapped(file: BinaryIO, kind: str) -> np.ndarray:
    """What was written to the file, as an array that is read from it when used."""
    size = file.tell()
    file.flush()
    return np.asarray(np.memmap(file, kind, "r")) if size else np.zeros(0, kind)


def learn_quality(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label", sample: int = SAMPLE,
) -> SubwordClassifier:
    """Train on rows with a text and a label of 0 or 1."""
    known = labelled.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label")
    ).where("text is not null and label in (0, 1)")
    rows = sampled(known, "key", sample).select("place", "text", "label").mapInArrow(
        _training_rows, "place long, label int, ids binary, counts binary"
    )
    found, ends = [], [0]
    with TemporaryFile() as ids, TemporaryFile() as counts:
        # a job for each partition, so that no more than a piece is on its way
        for r in rows.toLocalIterator():
            ids.write(r["ids"])
            counts.write(r["counts"])
            digest = hashlib.blake2b(bytes(r["ids"]) + bytes(r["counts"]), digest_size=16).digest()
            found.append((r["place"], r["label"], digest))
            ends.append(ends[-1] + len(r["counts"]) // 2)
        order = sorted(range(len(found)), key=found.__getitem__)
        buckets, times = _mapped(ids, "<i4"), _mapped(counts, "<u2")
        return train(
            [buckets[ends[i] : ends[i + 1]] for i in order],
            [times[ends[i] : ends[i + 1]] for i in order],
            np.array([found[i][1] for i in order], dtype=np.int64),
        )


def train(ids: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray) -> SubwordClassifier:
    """Stochastic gradient descent over the texts, the step falling to zero."""
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    output = np.zeros((DIM, 2), dtype=np.float32)
    output[:, 1] = rng.uniform(0.5, 1, DIM)
    output[:, 0] = -output[:, 1]
    bias = np.zeros(2, dtype=np.float32)
    prior = float(labels.mean()) if len(labels) else 0.5
    done, steps = 0, max(1, EPOCHS * len(labels))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(labels)):
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(ids[i]):
                continue
            times = counts[i].astype(np.float32)
            weight = times / times.sum()
            rows = vectors[ids[i]]
            hidden = weight @ rows
            logits = hidden @ output + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[labels[i]] -= 1
            back = output @ chance
            output -= rate * np.outer(hidden, chance)
            bias -= rate * 0.1 * chance
            # a text spreads its step over its features, so that rare words move too
            vectors[ids[i]] = rows - (rate * len(weight) ** 0.5) * np.outer(weight, back)
    return SubwordClassifier(vectors, output, bias, prior)


def score_quality(docs: DataFrame, model: SubwordClassifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: the key and ``score``, the chance of class 1."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    table, offset, prior = model.projected(), float(model.bias[1] - model.bias[0]), model.prior

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = _features(*raw_bytes(part.column("text")))
                total = sum(np.diff(at) for _, at in found)
                logit = sum(sums_between(table[b], at) for b, at in found) / np.maximum(total, 1) + offset
                score = np.where(total > 0, 1 / (1 + np.exp(-np.clip(logit, -40, 40))), prior)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(score)], names=["key", "score"])

    return source.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
