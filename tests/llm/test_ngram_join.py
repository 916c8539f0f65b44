"""The join against all pairs, by both ways of verifying; components; odd rows."""

import random

import pytest

from weftline.llm.components import components
from weftline.llm.ngram_join import bands_for, near_duplicates, one_of_each


def sets(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def truth(rows, similar=0.8):
    held = [(k, sets(t)) for k, t in rows]
    links = {k: set() for k, _ in rows}
    for i, (k, a) in enumerate(held):
        for m, b in held[:i]:
            if a and b and len(a & b) >= similar * len(a | b):
                links[k].add(m)
                links[m].add(k)
    group = {}
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        group[k] = min(seen)
    return {k: (group[k], len(v)) for k, v in links.items()}


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for size in (1, 1, 2, 3, 4, 60):
        base = [word() for _ in range(rng.randrange(80, 200))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(0, 6)):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own))
            if rng.random() < 0.3:
                rows.append(" ".join(own).upper())
    rows += [" ".join(word() for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    rows += ["", None, "one two", "one two", "one two three"]
    return list(enumerate(rows))


@pytest.mark.parametrize(("small", "block"), [(1000, 512), (2, 16), (24, 20)])
def test_same_as_all_pairs(spark, small, block):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, class string, size int")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates(docs, recall=0.999999, small=small, block=block).collect()}
    assert got == truth(rows)


def test_recall_sets_the_bands():
    assert bands_for(0.8, 0.999, 7) == 30
    assert 1 - (1 - 0.8**7) ** 30 >= 0.999


def test_edge_cases(spark):
    long = "alpha beta " * 100_000 + "gamma"
    docs = spark.createDataFrame(
        [(1, long), (2, long), (3, None), (4, ""), (None, long), (5, "?!"), (5, "?!"), (6, "a b c d e f"), (6, "a b c d e f")],
        "doc_id long, text string",
    )
    got = sorted(tuple(r) for r in near_duplicates(docs).fillna(-1).collect())
    assert got == sorted([
        (1, 1, 1, 3, 2), (2, 1, 1, 3, 2), (3, 3, 3, 1, 0), (4, 4, 4, 1, 0), (-1, 1, 1, 3, 2), (5, 5, 5, 1, 0), (5, 5, 5, 1, 0),
        (6, 6, 6, 2, 1), (6, 6, 6, 2, 1),
    ])
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7), (300, None)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 61)}, 150: 100, 200: 100}


def test_one_of_each_with_any_key(spark):
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [("b", long, 1), ("a", long, 2), (None, None, 3), (None, long + " x", 4), ("c", "other words that are in no second text here", 5), ("c", "more", 6)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, _key int")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert len([r for r in got if r[1] and r[1].startswith("one two")]) == 1
    assert {r[2] for r in got} >= {3, 5, 6} and len(got) == 4
    numbers = spark.createDataFrame([(42, long), (7, long), (None, None)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0) for r in one_of_each(numbers).collect()) == [0, 7]
