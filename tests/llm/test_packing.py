"""Packing: the same ids as the tokenizer file, whole documents, every capacity held."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weftline.llm.packing import BytePairIds, best_fit, cut_pieces, pack

FILE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n b", "a \nb", "\t a", "it's  don't we'll", "x <|endoftext|> y", "é ü 中文 字 😀   z",
    "a  b", "a  b", "1 22  333", "!! ?? \r\n  \r\n x", "end. ", "end.  ", "tab\t\t x", "word " * 500 + "z", "　 a   b", "a   b  \u0085 c",
]


def test_ids_are_those_of_the_file():
    encode = BytePairIds()
    rng = np.random.default_rng(0)
    drawn = ["".join(rng.choice(list("ab' \n\té1! "), size=rng.integers(0, 40))) for _ in range(3000)]
    for text in TEXTS + drawn:
        assert np.frombuffer(encode(text), "<u4").tolist() == FILE.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_and_sequences(spark):
    rows = list(enumerate(TEXTS)) + [(100, None), (101, "many words here " * 3000), (None, "no key"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, length int, bin string")
    got = pack(cut_pieces(docs, keep_ids=True), columns=("doc_id", "part", "start", "ids_crc32")).collect()
    texts = {k: t for k, t in rows}
    by_doc = {}
    for r in got:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] <= 4 * 2048
        by_doc.setdefault(r["doc_id"], []).append(r)
    for key, parts in by_doc.items():
        if key == 5:
            continue
        parts.sort(key=lambda r: r["part"])
        ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in parts), "<u4").tolist()
        assert ids == FILE.encode(texts[key] or "", add_special_tokens=False).ids + [0]
        assert [r["start"] for r in parts] == np.cumsum([0, *(r["length"] for r in parts)])[:-1].tolist()
        assert all(r["length"] == 2048 for r in parts[1:])
    assert len(by_doc[5]) == 3
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 2048
    assert len(held) <= -(-sum(r["length"] for r in got) // 2048) + 1
    assert pack(cut_pieces(docs.limit(0))).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_is_held(rule):
    rng = np.random.default_rng(1)
    lengths = np.minimum(2048, rng.exponential(300, size=5000).astype(np.int64) + 1)
    capacity = (2048, 6, 2048 * 2048)
    sequence, offset = best_fit(lengths, capacity, (1.0, 0.3, 0.3), rule)
    for total, most in zip((lengths, np.ones_like(lengths), lengths**2), capacity, strict=True):
        assert np.bincount(sequence, total).max() <= most
    for s in range(0, sequence.max() + 1, 50):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert (offset[own] == np.cumsum(lengths[own]) - lengths[own]).all()
    if rule == "norm":
        loose, _ = best_fit(lengths, (2048, 2048, 2048**2), (1.0, 0.0, 0.0), rule)
        assert loose.max() + 1 <= 1.002 * lengths.sum() / 2048 + 1
