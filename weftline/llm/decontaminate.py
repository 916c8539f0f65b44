"""Benchmark decontamination: BM25 with block-max WAND, then overlap of question and answer.

The test items are the indexed documents; every training passage is a query. A passage is a
window of ``WINDOW`` words, half overlapping its neighbour; entries of the index are items, or
pieces of half a window of long ones, so that a copied entry lies in one window whole. Scores
are BM25 divided by the entry's score for its own text, so one threshold serves all.

Each entry has essential terms, its rarest; all its others together weigh less than ``REST``.
Windows where no entry's essential terms can make up for the rest are passed over at once; the
others walk the posting lists by block-max WAND and retrieve all entries above the threshold.
An item counts as leaked if the shingles of its question and of its answer both lie near
that window. The answer is the last sentence, or the last quarter of a single sentence.

Statistics of terms cover all items. An index is built and broadcast for a shard of items at
a time, of about ``SHARD_BYTES`` of text; each shard reads the documents once.

Null and empty texts, of documents or items, match nothing. Repeated items count once,
repeated documents are answered one by one. Columns but keys and texts are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import Rolling, lower_bytes, mix, runs, slices, word_flags

WINDOW = 128
#: Share of an entry's own score that retrieves it.
RETRIEVE = 0.5
#: Share of shingles of the question, and of the answer, that makes a leak.
OVERLAP = 0.5
QUESTION_WORDS, ANSWER_WORDS = 5, 2
K1, B = 1.2, 0.75
SHARD_BYTES = 4 << 20
POSTINGS = 16
#: An entry's most frequent terms are not essential, as long as they weigh less together.
REST = 0.25

_SENTENCE = re.compile(r"[.!?]+\s+")


@dataclass
class Entry:
    """A posting list: entry numbers in order, weights, and the last entry and greatest weight by block."""

    numbers: list[int]
    weights: list[float]
    last: list[int]
    most: list[float]
    top: float


@dataclass
class Index:
    terms: np.ndarray
    lists: list[Entry]
    first: np.ndarray  # by term, where its essential postings begin
    entry: np.ndarray  # essential postings
    weight: np.ndarray
    rest: np.ndarray  # by entry, the weight of its other terms together
    item_of: list[int]  # item by entry
    items: list[tuple] = field(default_factory=list)  # key, question and answer shingles, words


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and each text's first word."""
    data, offsets = lower_bytes(texts)
    starts, ends, firsts = runs(word_flags(data), offsets)
    return Rolling(data)(starts, ends), firsts


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of all words if there are fewer."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = words[:n].copy()
    for k in range(1, width):
        out = mix(out) * np.uint64(3) + words[k : k + n]
    return mix(out)


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    cuts = [m.end() for m in _SENTENCE.finditer(text) if m.end() < len(text.rstrip())]
    if cuts:
        return text[: cuts[-1]], text[cuts[-1] :]
    words = text.split()
    at = len(words) - max(1, len(words) // 4)
    return " ".join(words[:at]), " ".join(words[at:])


_POSTING = "item long, piece int, term long, tf int, size int"


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words, firsts = words_of(part.column("text"))
            for i, item in enumerate(part.column("item").to_pylist()):
                own = words[firsts[i] : firsts[i + 1]]
                for k, at in enumerate(range(0, len(own), WINDOW // 2)):
                    piece = own[at : at + WINDOW // 2]
                    terms, tf = np.unique(piece, return_counts=True)
                    n = len(terms)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * n, pa.int64()), pa.array([k] * n, pa.int32()), pa.array(terms.view(np.int64)),
                         pa.array(tf.astype(np.int32)), pa.array(np.full(n, len(piece), np.int32))],
                        names=["item", "piece", "term", "tf", "size"],
                    )


def build_indexes(items: DataFrame, key: str = "item_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """An index for every shard of the items; only one shard is on the driver at a time."""
    held = items.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null").distinct()
    held = held.withColumn("item", F.xxhash64("key", "text"))
    size = held.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    shards = max(1, -(-size // shard_bytes))
    postings = held.select("item", "text").mapInArrow(_postings, _POSTING)
    whole = postings.select("item", "piece", "size").distinct().agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
    if not whole["n"]:
        return
    counts = postings.groupBy("term").agg(F.count("*").alias("df"))
    for shard in range(shards):
        mine = F.pmod(F.col("item"), F.lit(shards)) == shard
        texts = held.where(mine).collect()
        rows = postings.where(mine).join(counts, "term").collect()
        yield make_index(texts, rows, whole["n"], whole["mean"])


def make_index(texts: list, rows: list, entries: int, mean: float) -> Index:
    """Posting lists with normalized weights. Entries of like length stand together."""
    sizes = {(r["item"], r["piece"]): r["size"] for r in rows}
    order = sorted(sizes, key=lambda e: (sizes[e], e))
    number = {e: i for i, e in enumerate(order)}
    weight: dict[tuple[int, int], float] = {}
    own = np.zeros(len(order))
    for r in rows:
        idf = np.log(1 + (entries - r["df"] + 0.5) / (r["df"] + 0.5))
        value = idf * r["tf"] * (K1 + 1) / (r["tf"] + K1 * (1 - B + B * r["size"] / mean))
        at = number[(r["item"], r["piece"])]
        weight[(r["term"], at)] = value
        own[at] += value
    df = {r["term"]: r["df"] for r in rows}
    found: dict[int, list[tuple[int, float]]] = {}
    for (term, at), value in sorted(weight.items()):
        found.setdefault(term, []).append((at, value / own[at]))
    terms = np.array(sorted(found), dtype=np.int64).view(np.uint64)
    by_hash = np.argsort(terms, kind="stable")
    names = [int(x) for x in terms.view(np.int64)[by_hash]]
    lists, by_entry = [], [[] for _ in order]
    for i, term in enumerate(names):
        numbers, weights = map(list, zip(*found[term], strict=True))
        blocks = range(0, len(numbers), POSTINGS)
        most = [max(weights[a : a + POSTINGS]) for a in blocks]
        lists.append(Entry(numbers, weights, [numbers[min(a + POSTINGS, len(numbers)) - 1] for a in blocks], most, max(most)))
        for at, value in zip(numbers, weights, strict=True):
            by_entry[at].append((-df[term], value, i))
    rest, essential = np.zeros(len(order)), []
    for at, own_terms in enumerate(by_entry):
        for _, value, i in sorted(own_terms):
            if rest[at] + value < REST:
                rest[at] += value
            else:
                essential.append((i, at, value))
    essential.sort()
    first = np.searchsorted(np.array([e[0] for e in essential]), np.arange(len(names) + 1))
    place = {t["item"]: i for i, t in enumerate(texts)}
    index = Index(
        terms[by_hash], lists, first, np.array([e[1] for e in essential]), np.array([e[2] for e in essential]), rest,
        [place[item] for item, _ in order],
    )
    for t in texts:
        question, answer = split_item(t["text"])
        words, firsts = words_of(pa.array([question, answer, t["text"]], pa.string()))
        parts = [words[firsts[i] : firsts[i + 1]] for i in range(3)]
        index.items.append((t["key"], np.unique(shingles(parts[0], QUESTION_WORDS)), np.unique(shingles(parts[1], ANSWER_WORDS)),
                            len(parts[2]), min(QUESTION_WORDS, max(1, len(parts[0]))), min(ANSWER_WORDS, max(1, len(parts[1])))))
    return index


def wand(lists: list[Entry], least: float) -> list[tuple[int, float]]:
    """All entries whose weights add up to ``least`` or more, by block-max WAND."""
    found = []
    state = [[x.numbers[0], 0, x] for x in lists]
    slack = least - 1e-9
    while state:
        state.sort(key=lambda s: s[0])
        bound, pivot = 0.0, -1
        for i, s in enumerate(state):
            bound += s[2].top
            if bound >= slack:
                pivot = i
                break
        if pivot < 0:
            break
        entry = state[pivot][0]
        while pivot + 1 < len(state) and state[pivot + 1][0] == entry:
            pivot += 1
        bound, border = 0.0, state[pivot + 1][0] if pivot + 1 < len(state) else None
        for s in state[: pivot + 1]:
            block = bisect_left(s[2].last, entry)
            if block < len(s[2].last):
                bound += s[2].most[block]
                after = s[2].last[block] + 1
                border = after if border is None or after < border else border
        if bound >= slack:
            if state[0][0] == entry:
                score = sum(s[2].weights[s[1]] for s in state[: pivot + 1])
                if score >= slack:
                    found.append((entry, score))
                target = entry + 1
            else:
                target = entry
        else:
            # no entry before the border can do better than these blocks
            target = max(entry + 1, border) if border is not None else entry + 1
        kept = []
        for i, s in enumerate(state):
            if i <= pivot and s[0] < target:
                s[1] = bisect_left(s[2].numbers, target, s[1])
                if s[1] >= len(s[2].numbers):
                    continue
                s[0] = s[2].numbers[s[1]]
            kept.append(s)
        state = kept
    return found


def leaks(texts: pa.Array, index: Index, retrieve: float = RETRIEVE, overlap: float = OVERLAP) -> list[dict[int, tuple]]:
    """For each text, by item number: (score, question overlap, answer overlap)."""
    words, firsts = words_of(texts)
    out: list[dict[int, tuple]] = [{} for _ in range(len(firsts) - 1)]
    if retrieve <= REST:
        raise ValueError(f"retrieve must be above {REST}")
    if not len(words) or not len(index.terms):
        return out
    at = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[at] == words)
    sizes = np.diff(firsts)
    step = WINDOW // 2
    halves = -(-sizes // step)
    first_half = np.concatenate([[0], np.cumsum(halves)])
    owner = np.repeat(np.arange(len(sizes)), sizes)[hit]
    half = first_half[owner] + (hit - firsts[owner]) // step
    pairs = np.unique(half * len(index.terms) + at[hit])
    half, term = pairs // len(index.terms), pairs % len(index.terms)
    total = int(first_half[-1])
    text_of = np.repeat(np.arange(len(sizes)), halves)
    together = np.zeros(total, dtype=bool)
    together[:-1] = text_of[1:] == text_of[:-1]
    # essential postings of what each half window holds, for the windows that begin there or before
    count = index.first[term + 1] - index.first[term]
    at = np.repeat(index.first[term] - np.cumsum(count) + count, count) + np.arange(count.sum())
    window, entry, weight = np.repeat(half, count), index.entry[at], index.weight[at]
    before = np.flatnonzero((window > 0) & together[window - 1])
    keys = np.concatenate([window, window[before] - 1]) * len(index.rest) + np.concatenate([entry, entry[before]])
    keys, place = np.unique(keys, return_inverse=True)
    bound = np.bincount(place, np.concatenate([weight, weight[before]])) + index.rest[keys % len(index.rest)]
    alive = np.unique(keys[bound >= retrieve - 1e-6] // len(index.rest))
    bounds = np.searchsorted(half, np.arange(total + 1))
    for h in alive:
        end = h + 2 if together[h] else h + 1
        found = wand([index.lists[t] for t in np.unique(term[bounds[h] : bounds[end]])], retrieve)
        text = text_of[h]
        for entry, score in found:
            number = index.item_of[entry]
            key, question, answer, size, q_width, a_width = index.items[number]
            start = firsts[text] + (h - first_half[text]) * step
            region = words[max(firsts[text], start - size) : min(firsts[text + 1], start + WINDOW + size)]
            shares = [
                float(np.isin(part, shingles(region, width), kind="sort").mean()) if len(part) else 1.0
                for part, width in ((question, q_width), (answer, a_width))
            ]
            if min(shares) >= overlap and (score, *shares) > out[text].get(number, (0.0,)):
                out[text][number] = (score, *shares)
    return out


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row for each document and leaked item: both keys, ``score`` and both overlaps."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shape = (
        f"key {source.schema['key'].dataType.simpleString()}, item {items.schema[item_key].dataType.simpleString()}, "
        "score double, question_overlap double, answer_overlap double"
    )
    context = docs.sparkSession.sparkContext

    def over(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in slices(batch, "text"):
                    found = leaks(part.column("text"), index)
                    rows = [(i, index.items[n][0], *x) for i, every in enumerate(found) for n, x in sorted(every.items())]
                    if rows:
                        row, item, *rest = map(list, zip(*rows, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [part.column("key").take(pa.array(row)), pa.array(item), *map(pa.array, rest)],
                            names=["key", "item", "score", "question_overlap", "answer_overlap"],
                        )

        return source.mapInArrow(run, shape)

    every = [over(context.broadcast(index)) for index in build_indexes(items, item_key)]
    found = reduce(DataFrame.union, every) if every else docs.sparkSession.createDataFrame([], shape)
    return found.withColumnsRenamed({"key": key, "item": item_key})


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The rows without a leaked item, all columns as they are."""
    context = docs.sparkSession.sparkContext

    def over(rows: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text):
                    clean = pa.array([not x for x in leaks(part.column(text), shared.value)], pa.bool_())
                    yield part.filter(clean)

        return rows.mapInArrow(run, rows.schema)

    return reduce(over, (context.broadcast(index) for index in build_indexes(items, item_key)), docs)
