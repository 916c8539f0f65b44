"""Retrieval against all scores, leaks that were planted, and odd rows."""

import random

import pyarrow as pa
from pyspark.sql import Row

from weftline.llm.decontaminate import build_indexes, find_leaks, leaks, split_item, wand, without_leaks

rng = random.Random(2)
WORDS = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(400)]


def prose(n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "", "."]) for _ in range(n))


def test_wand_retrieves_all_above_the_threshold(spark):
    items = spark.createDataFrame([(i, prose(rng.randrange(5, 90))) for i in range(150)], "item_id long, text string")
    (index,) = build_indexes(items)
    for _ in range(200):
        terms = rng.sample(range(len(index.terms)), rng.randrange(1, 60))
        lists = [index.lists[t] for t in terms]
        score = {}
        for x in lists:
            for n, w in zip(x.numbers, x.weights, strict=True):
                score[n] = score.get(n, 0.0) + w
        for least in (0.05, 0.2, 0.5):
            assert sorted(n for n, _ in wand(lists, least)) == sorted(n for n, s in score.items() if s >= least - 1e-9)


def test_planted_items_are_found_and_others_not(spark):
    items = [(i, prose(rng.randrange(12, 60))) for i in range(60)] + [(60, prose(400))]
    docs, truth = [], set()
    for d in range(120):
        text = prose(rng.randrange(0, 600))
        if d % 4 == 0:
            i = rng.randrange(61)
            at = rng.randrange(len(text) + 1)
            text = text[:at] + " " + items[i][1].upper() + "\n" + text[at:]
            truth.add((d, i))
        docs.append((d, text))
    got = find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == truth
    clean = without_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in truth}


def test_shards_do_not_change_the_result(spark):
    items = spark.createDataFrame([(i, prose(20)) for i in range(40)], "item_id long, text string")
    text = pa.array([" ".join(r["text"] for r in items.limit(12).collect())])
    sides = [[x for index in build_indexes(items, shard_bytes=b) for k, v in leaks(text, index)[0].items() for x in [(index.items[k][0], *(round(float(y), 9) for y in v))]] for b in (1 << 20, 700)]
    assert sorted(sides[0]) == sorted(sides[1]) and len(sides[0]) == 12


def test_question_and_answer():
    assert split_item("One two. Three four? Five.") == ("One two. Three four? ", "Five.")
    assert split_item("a b c d") == ("a b c", "d")


def test_edge_cases(spark):
    items = spark.createDataFrame(
        [Row(item_id=1, text="alpha beta gamma delta. epsilon zeta"), Row(item_id=1, text="alpha beta gamma delta. epsilon zeta"), Row(item_id=2, text=""), Row(item_id=3, text=None), Row(item_id=None, text="eta theta iota kappa")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "alpha beta gamma delta epsilon zeta", 1), (3, "alpha beta gamma delta epsilon zeta", 1), (None, "eta theta iota kappa", 1), (4, "word " * 100_000, 1)],
        "doc_id long, text string, item_id int",
    )
    got = sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in find_leaks(docs, items).collect())
    assert got == [(0, 0), (3, 1), (3, 1)]
    assert find_leaks(docs, items.limit(0)).count() == 0 and find_leaks(docs.limit(0), items).count() == 0
    assert without_leaks(docs, items).count() == 3
