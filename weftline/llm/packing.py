"""Best-fit packing of tokenized documents under several capacities.

A sequence has three capacities: tokens, number of pieces, and attention cost (the sum of
squared piece lengths). Pieces are taken longest first; among the open sequences with
room in every dimension the one wins whose weighted residual vector is nearest to the
piece (``rule="norm"``) or has the smallest weighted dot product with it
(``rule="dot"``); where none has room a new sequence opens.

Pieces of equal length are alike, so sequences are kept by their residual vector: the
choice is made among distinct vectors, not among sequences. Pieces are dealt by a hash
into groups of about ``GROUP`` pieces, each packed by one task; a group leaves at most
about one loose sequence, one in four thousand.

A null or empty text is its end token alone. Repeated rows are separate documents. An empty table
gives no rows. Columns but the key and the text are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import slices

LENGTH = 2048
#: Documents in a sequence at most, and the weights of tokens, documents and attention cost.
MOST_PIECES = 256
WEIGHTS = (1.0, 1.0, 1.0)
#: Pieces that one task packs, on average.
GROUP = 8192
#: A worker's memory of chunks and their ids starts anew beyond this many.
KNOWN = 300_000


class BytePairIds:
    """Ids by the byte-level vocabulary, the same as the tokenizer file gives.

    A text falls apart before every single blank that follows or precedes something else,
    so ids of such chunks are kept and looked up; ``tiktoken`` encodes new chunks. Texts with a special token's
    string or with three white-space characters around a blank go through whole.
    """

    def __init__(self, name: str = "byte_bpe_50k") -> None:
        import base64

        import public_tokenizers
        import regex
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.file = public_tokenizers.path(f"{name}.json")
        self.whole = None
        self.odd = regex.compile(r"\s \s|\s $")
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if "<|" in text:
            return self._by_file(text)
        if self.odd.search(text):
            return self._encode(text)
        head, *rest = text.split(" ")
        known = self.known
        out = [self._encode(head)] if head else []
        if len(known) > KNOWN:
            known.clear()
        for chunk in rest:
            ids = known.get(chunk)
            if ids is None:
                ids = self._encode(" " + chunk)
                if len(chunk) < 64:
                    known[chunk] = ids
            out.append(ids)
        return b"".join(out)

    def _encode(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def _by_file(self, text: str) -> bytes:
        if self.whole is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.file)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def byte_pair_ids() -> Callable[[str], bytes]:
    return BytePairIds()


_PIECES = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def cut_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
    tokenizer: Callable[[], Callable[[str], bytes]] = byte_pair_ids, end_id: int = 0, keep_ids: bool = False,
) -> DataFrame:
    """Tokenize every document, add the end token, and cut what is longer than a sequence.

    One row for each piece: key, ``part`` from 0, ``start``, ``length``, ``ids_crc32`` and,
    with ``keep_ids``, ``ids`` as little-endian bytes. All pieces of a document but the first have the full length.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer()
        for batch in batches:
            for part in slices(batch, "text"):
                row, number, start, size, crc, held = [], [], [], [], [], []
                for i, value in enumerate(pc.fill_null(part.column("text"), "").to_pylist()):
                    ids = encode(value) + end
                    tokens = len(ids) // 4
                    first = tokens % length or min(tokens, length)
                    at, k = 0, 0
                    while at < tokens:
                        to = first if k == 0 else at + length
                        piece = ids[4 * at : 4 * to]
                        row.append(i)
                        number.append(k)
                        start.append(at)
                        size.append(to - at)
                        crc.append(zlib.crc32(piece))
                        held.append(piece if keep_ids else None)
                        at, k = to, k + 1
                columns = [pa.array(v, f.type) for v, f in zip((number, start, size, crc, held), _PIECES, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(row, pa.int64())), *columns], names=["key", *_PIECES.names])

    shape = f"key {kind}, part int, start long, length long, ids_crc32 long, ids binary"
    out = source.mapInArrow(run, shape)
    return out.withColumnRenamed("key", key) if keep_ids else out.drop("ids").withColumnRenamed("key", key)


def best_fit(
    lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float], rule: str,
) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece. ``capacity``: tokens, pieces, attention cost."""
    order = np.argsort(-lengths, kind="stable")
    scale = np.array(weights) / np.array(capacity, dtype=float)
    room = np.zeros((0, 3), dtype=np.int64)  # distinct residual vectors with open sequences
    members: dict[tuple[int, int, int], list[int]] = {}
    vectors: list[tuple[int, int, int]] = []
    used: list[int] = []
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)

    def add(vector: tuple[int, int, int], opened: list[int]) -> None:
        nonlocal room
        if min(vector) <= 0:
            return
        if vector in members:
            members[vector].extend(opened)
            return
        members[vector] = list(opened)
        vectors.append(vector)
        room = np.vstack([room, vector])

    at = 0
    while at < len(order):
        size = int(lengths[order[at]])
        to = at
        while to < len(order) and lengths[order[to]] == size:
            to += 1
        need = np.array([size, 1, size * size], dtype=np.int64)
        while at < to:
            fits = np.flatnonzero((room >= need).all(axis=1))
            if len(fits):
                left = (room[fits] - need) * scale if rule == "norm" else room[fits] * scale * (need * scale)
                best = int(fits[np.argmin((left**2).sum(axis=1) if rule == "norm" else left.sum(axis=1))])
                vector = vectors[best]
                open_here = members[vector]
                take = [open_here.pop() for _ in range(min(to - at, len(open_here)))]
                if not open_here:
                    del members[vector]
                    vectors[best] = vectors[-1]
                    room[best] = room[-1]
                    vectors.pop()
                    room = room[:-1]
            else:
                vector = capacity
                take = [len(used)]
                used.append(0)
            for number in take:
                i = order[at]
                sequence[i], offset[i] = number, used[number]
                used[number] += size
                at += 1
            add((vector[0] - size, vector[1] - 1, vector[2] - size * size), take)
    return sequence, offset


def pack(
    pieces: DataFrame, length: int = LENGTH, most_pieces: int | None = None, most_attention: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm", group: int = GROUP,
    columns: tuple[str, ...] = ("doc_id", "part"),
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length``.

    ``most_pieces`` and ``most_attention`` default to what no sequence of ``length`` tokens
    can exceed. A piece must fit an empty sequence.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    capacity = (length, most_pieces or length, most_attention or length * length)
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("bin", F.pmod(F.xxhash64(*columns), F.lit(groups)))
    kept = pieces.schema.fields
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"

    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy().astype(np.int64)
        if len(lengths) and (lengths.max() > capacity[0] or (lengths**2).max() > capacity[2]):
            raise ValueError("a piece is larger than a sequence")
        sequence, offset = best_fit(lengths, capacity, weights, rule)
        base = int(table.column("bin")[0].as_py()) << 32
        out = table.select([f.name for f in kept])
        return out.append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))

    return dealt.groupBy("bin").applyInArrow(run, shape)
