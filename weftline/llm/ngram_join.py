"""N-gram Jaccard join of documents by MinHash banding.

A document is the set of its runs of five words (of all its words, if it has fewer). Two
documents are linked if the Jaccard similarity of their sets is 0.8 or more. Documents with
the same set form one class and are handled once. Bands of MinHash values bring candidates
together; their number follows from the target recall. Every candidate pair is verified on
the full sets, so precision is exact.

* Buckets of up to ``SMALL`` classes give pairs, each verified once.
* Larger buckets are cut into blocks, and each pair of blocks is one task that counts its links
  by a product of matrices and puts out a row for each class, not for each pair.
  A pair that shares several such buckets counts in the first one.

No pair is lost to a bucket's size, and no group of copies is expanded.

Null and empty texts, and texts without a word, have no set: they are linked to nothing.
Repeated rows are copies of one another. A document without a key takes part, but names no class.
Columns but the key and the text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import slices
from weftline.llm.components import components
from weftline.llm.decontaminate import shingles, words_of
from weftline.llm.store import written

WIDTH, SIMILAR = 5, 0.8
#: Chance to bring a pair of exactly SIMILAR together, and MinHash values in a band.
RECALL, ROWS = 0.999, 7
#: Largest bucket that gives pairs, and classes in a block of a larger one.
SMALL, BLOCK = 24, 256
#: Columns of a product of matrices at a time.
COLUMNS = 16_384


def bands_for(similar: float = SIMILAR, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands needed so that a pair at the threshold shares one with the chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similar**rows))


def _factors(count: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The MinHash values of a set, combined by band. Never 0."""
    factors = _factors(bands * rows)
    least = np.empty(len(factors), dtype=np.uint64)
    step = max(1, (1 << 18) // len(grams))
    for at in range(0, len(factors), step):
        least[at : at + step] = (grams[None, :] * factors[at : at + step, None]).min(axis=1)
    return np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in least.reshape(bands, rows)], dtype=np.uint64) | np.uint64(1)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in slices(batch, "text"):
        words, firsts = words_of(part.column("text"))
        yield part, [np.unique(shingles(words[firsts[i] : firsts[i + 1]], WIDTH)) for i in range(part.num_rows)]


def _print(grams: np.ndarray) -> bytes | None:
    """A fingerprint of a set: equal for equal sets."""
    return xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None


def signatures(docs: DataFrame, key: str, text: str, bands: int, rows: int) -> DataFrame:
    """(key, class, size, bands) for each row."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in _sets(batch):
                hashes = [band_hashes(g, bands, rows).view(np.int64) if len(g) else None for g in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array([_print(g) for g in sets], pa.binary()),
                     pa.array([len(g) for g in sets], pa.int32()), pa.array(hashes, pa.list_(pa.int64()))],
                    names=["key", "class", "size", "bands"],
                )

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, class binary, size int, bands array<long>")


def class_sets(docs: DataFrame, text: str) -> DataFrame:
    """(class, grams) of rows with a text; ``grams`` are sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _sets(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_print(g) for g in sets], pa.binary()), pa.array([g.tobytes() for g in sets], pa.binary())],
                    names=["class", "grams"],
                )

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "class binary, grams binary")


def _verified(pairs: DataFrame, similar: float) -> DataFrame:
    """(a, b, linked) of pairs with both sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(common >= similar * (len(p) + len(q) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return pairs.mapInArrow(run, "a binary, b binary, linked boolean").where("linked").select("a", "b")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by products of 0/1 matrices."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    every = np.concatenate([*left, *right])
    values, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1  # what stands in one set alone is in no intersection
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    keep = counts[inverse] > 1
    owner, column = owner[keep], shared[inverse[keep]]
    for at in range(0, int(shared[-1]) + 1 if len(values) else 0, COLUMNS):
        mine = (column >= at) & (column < at + COLUMNS)
        m = np.zeros((len(left) + len(right), min(COLUMNS, int(shared[-1]) + 1 - at)), dtype=np.float32)
        m[owner[mine], column[mine] - at] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out


def _block_links(similar: float):
    """For a pair of blocks of a bucket: a class's links counted here, and its least linked class."""

    def run(table: pa.Table) -> pa.Table:
        band, first, second = (table.column(c)[0].as_py() for c in ("band", "one", "two"))
        own = table.column("own").to_numpy()
        names = table.column("class").to_pylist()
        grams = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("grams")]
        hot = np.array(table.column("hot").to_pylist(), dtype=np.int64)
        copies = table.column("copies").to_numpy()
        left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)
        common = common_counts([grams[i] for i in left], [grams[i] for i in right])
        size = np.array([len(g) for g in grams], dtype=float)
        linked = common >= similar * (size[left][:, None] + size[right][None, :] - common) - 1e-9
        if first == second:
            np.fill_diagonal(linked, False)
        counted = linked.copy()
        for k in range(band):
            counted &= ~((hot[left, k][:, None] == hot[right, k][None, :]) & (hot[left, k] != 0)[:, None])
        links = np.zeros(len(own), dtype=np.int64)
        links[left] += counted @ copies[right]
        if first != second:
            links[right] += copies[left] @ counted
        # an edge to the least class of what is linked here, directly or not
        rank = np.argsort(np.argsort(np.array(names, dtype=object), kind="stable"), kind="stable")
        label = rank.copy()
        while True:
            new = label.copy()
            if len(left) and len(right):
                far = len(names)
                new[left] = np.minimum(new[left], np.where(linked, label[right][None, :], far).min(axis=1))
                new[right] = np.minimum(new[right], np.where(linked, new[left][:, None], far).min(axis=0))
            if (new == label).all():
                break
            label = new
        by_rank = [names[i] for i in np.argsort(rank)]
        return pa.table({
            "class": pa.array(names, pa.binary()), "links": pa.array(links), "to": pa.array([by_rank[x] for x in label], pa.binary()),
        })

    return run


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR, recall: float = RECALL, rows: int = ROWS,
    small: int = SMALL, block: int = BLOCK,
) -> DataFrame:
    """One row for each row: key, ``class_id``, ``copy_id``, ``n_copies``, ``n_links``.

    ``class_id`` is the least key of the group of documents that links hold together,
    ``copy_id`` the least key with the same set of n-grams, ``n_copies`` how many rows have
    that set, ``n_links`` the number of other rows at ``similar`` or more, copies included.
    """
    bands = bands_for(similar, recall, rows)
    signed = written(signatures(docs, key, text, bands, rows), "signatures")
    classes = written(
        signed.where("class is not null").groupBy("class")
        .agg(F.min("key").alias("least"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands")),
        "classes",
    )
    spread = classes.select("class", "size", F.posexplode("bands").alias("band", "hash"))
    # written, so that adaptive execution can split a large bucket in the join
    sizes = written(spread.groupBy("band", "hash").agg(F.count("*").alias("count")).where("count > 1"), "sizes")
    buckets = written(spread.join(sizes, ["band", "hash"]), "buckets")

    hot = buckets.where(F.col("count") > small)
    # by class, the hash of each of its large buckets in the place of the band
    marks = hot.groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("band", "hash"))).alias("marks"))
    laid = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.coalesce(F.element_at("marks", i), F.lit(0).cast("long")))
    members = F.array_sort(F.collect_list(F.struct("class", "size")))
    pairs = (
        buckets.where(F.col("count") <= small).groupBy("band", "hash").agg(members.alias("m"))
        .select(F.explode(F.expr(
            "flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> struct(x.class as a, y.class as b, x.size as s, y.size as t))))"
        )).alias("p"))
        .where(F.least("p.s", "p.t") >= similar * F.greatest("p.s", "p.t") - 1e-9)
        .select("p.a", "p.b").distinct()
    )
    pairs = written(pairs, "pairs")

    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).union(hot.select("class")).distinct()
    keys = classes.join(wanted, "class", "left_semi").select(F.col("least").alias("key"))
    whole = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    named = whole.join(keys, whole["key"].eqNullSafe(keys["key"]), "left_semi")
    # several rows of one key may have different texts
    sets = class_sets(named, "text").join(wanted, "class", "left_semi").groupBy("class").agg(F.first("grams").alias("grams"))
    sets = written(
        sets.join(marks, "class", "left").join(classes.select("class", "copies"), "class")
        .select("class", "grams", "copies", laid.alias("hot")),
        "sets",
    )

    def side(name: str) -> DataFrame:
        return sets.select(F.col("class").alias(name), F.col("grams").alias(f"grams_{name}"), F.col("hot").alias(f"hot_{name}"))

    met = pairs.join(side("a"), "a").join(side("b"), "b").where(
        ~F.exists(F.arrays_zip("hot_a", "hot_b"), lambda z: (z["hot_a"] == z["hot_b"]) & (z["hot_a"] != 0))
    )
    linked = written(_verified(met.select("a", "b", "grams_a", "grams_b"), similar), "links")

    count = F.ceil(F.col("count") / block).cast("int")
    dealt = hot.select("band", "hash", "class", count.alias("blocks")).withColumn("own", F.pmod(F.hash("class"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", "hash", "class", "own", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    blocks = dealt.join(sets, "class").groupBy("band", "hash", "one", "two").applyInArrow(_block_links(similar), "class binary, links long, to binary")
    counted = written(blocks, "blocks")

    weights = classes.select("class", "copies")
    ends = linked.union(linked.select("b", "a")).toDF("class", "other")
    partner = ends.join(weights.withColumnsRenamed({"class": "other", "copies": "links"}), "other").select("class", "links")
    links = partner.union(counted.select("class", "links")).groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(linked.select("a", "b").union(counted.select("class", "to")).toDF("u", "v"))
    found = (
        classes.select("class", "least", "copies").join(links, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    found = written(found.where("copies > 1 or links > 0 or root <> class"), "found")
    named = written(found.groupBy("root").agg(F.min("least").alias("class_id")), "named")
    # a root whose own row was left out has no copies and no links, and so names no other row
    facts = found.join(named, "root").select("class", "class_id", F.col("least").alias("copy_id"), "copies", "links")
    return _answers(signed.select("key", "class"), facts, key)


def _answers(signed: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    none: Column = F.lit(0).cast("long")
    own = signed.where("class is null").select(
        F.col("key").alias(key), F.col("key").alias("class_id"), F.col("key").alias("copy_id"), F.lit(1).cast("long").alias("n_copies"), none.alias("n_links"),
    )
    rest = signed.where("class is not null").join(facts, "class", "left").select(
        F.col("key").alias(key), F.coalesce("class_id", "key").alias("class_id"), F.coalesce("copy_id", "key").alias("copy_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", none)).cast("long").alias("n_links"),
    )
    return rest.union(own)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates, the one with the least key.

    A key names a document: of several rows with a key and a text one stays. A row
    without a key goes by a hash of its text, and keys that are not whole numbers by their hash.
    """
    number, same = (next(n for n in (name * k for k in range(1, 99)) if n not in docs.columns) for name in ("_key", "_same"))
    whole = docs.schema[key].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    own = F.col(key).cast("long") if whole else F.when(F.col(key).isNotNull(), F.xxhash64(key))
    named = docs.withColumn(number, F.coalesce(own, F.xxhash64(text, F.lit("no key")))).withColumn(same, F.xxhash64(text))
    first = near_duplicates(named, number, text).where(F.col(number) == F.col("class_id")).select(number)
    return named.join(first, number, "left_semi").dropDuplicates([number, same]).drop(number, same)
