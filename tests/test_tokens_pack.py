import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import pack, tokens
from weftline.plans.prepare import mix_dedup_pack


def batch_model(docs, length, batch, drop_short):
    out = []
    for b in range(0, len(docs), batch):
        ids = sum(docs[b : b + batch], [])
        n = len(ids)
        if n >= length:
            n = n // length * length
        blocks = [ids[i : min(i + length, n)] for i in range(0, n, length)]
        out += [
            (b // batch, i, x)
            for i, x in enumerate(blocks)
            if len(x) == length or not drop_short
        ]
    return out


def corpus_model(docs, length, stride, end):
    ids = []
    for i, doc in enumerate(docs):
        ids += doc + (end if i < len(docs) - 1 else [])
    starts = range(0, len(ids) - length + 1, stride)
    return [(i // stride, ids[i : i + length]) for i in starts]


def ids_table(spark, docs, gap=1):
    return spark.createDataFrame(
        [(i * gap, d) for i, d in enumerate(docs)], "k long, ids array<int>"
    ).repartition(3)


def run_batches(df, token, length, batch, drop, rows):
    out = pack.pack_batches(df, token, "k", length, batch, drop, rows=rows).collect()
    assert all(r.labels == r.input_ids for r in out)
    return sorted((r.batch_id, r.block, r.input_ids) for r in out)


def run_corpus(df, token, length, stride, rows):
    out = pack.pack_corpus(df, token, "k", length, stride, rows=rows).collect()
    return sorted((r.seq_id, r.input_ids) for r in out)


@pytest.mark.parametrize("seed", range(6))
def test_arrays_equal_a_loop(spark, seed):
    rnd = random.Random(seed)
    docs = [
        [rnd.randrange(300) for _ in range(rnd.choice([0, 1, 3, 9, 40]))]
        for _ in range(rnd.choice([1, 7, 40, 90]))
    ]
    df = ids_table(spark, docs, rnd.choice([1, 3]))
    rows, length = rnd.choice([2, 5, 16, 1000]), rnd.choice([1, 4, 10, 64])
    batch, drop = rnd.choice([1, 3, 10, 1000]), rnd.random() < 0.5
    stride = rnd.choice([1, length, length + 3, max(1, length // 2)])
    end = rnd.choice([[], [32]])
    got = run_batches(df, tokens.ArrayTokens(F.col("ids")), length, batch, drop, rows)
    assert got == batch_model(docs, length, batch, drop)
    got = run_corpus(df, tokens.ArrayTokens(F.col("ids"), *end), length, stride, rows)
    assert got == corpus_model(docs, length, stride, end)


@pytest.mark.parametrize("seed", range(4))
def test_bytes_equal_a_loop(spark, seed):
    rnd = random.Random(seed)
    texts = [
        "".join(rnd.choices("ab é😀\n\x00", k=rnd.choice([0, 1, 5, 50]))) for _ in range(60)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string").repartition(3)
    plain = [list(t.encode()) for t in texts]
    length, rows = rnd.choice([4, 16, 64]), rnd.choice([2, 7, 1000])
    batch = rnd.choice([4, 25, 1000])
    got = run_batches(df, tokens.ByteTokens(F.col("text")), length, batch, False, rows)
    assert got == batch_model([d + [256] for d in plain], length, batch, False)
    stride = rnd.choice([length, length // 2, length + 5])
    got = run_corpus(df, tokens.ByteTokens(F.col("text"), 32), length, stride, rows)
    assert got == corpus_model(plain, length, stride, [32])


def test_batch_sizes_of_the_edge_table(spark):
    sizes = {9: [4, 4], 4: [4], 3: [3], 0: []}
    for n, want in sizes.items():
        df = ids_table(spark, [[7] * n])
        got = run_batches(df, tokens.ArrayTokens(F.col("ids")), 4, 1000, False, 10)
        assert [len(x) for _, _, x in got] == want


def test_corpus_windows_of_the_edge_table(spark):
    for n, stride, want in ((3, 4, 0), (9, 4, 2), (9, 2, 3), (9, 6, 1)):
        df = ids_table(spark, [[5] * n])
        assert len(run_corpus(df, tokens.ArrayTokens(F.col("ids")), 4, stride, 10)) == want


def test_one_long_document_over_many_blocks(spark):
    docs = [[1], list(range(5000)), [2] * 3]
    got = run_corpus(ids_table(spark, docs), tokens.ArrayTokens(F.col("ids")), 7, 7, 2)
    assert got == corpus_model(docs, 7, 7, [])


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long, ids array<int>")
    assert run_batches(df, tokens.ArrayTokens(F.col("ids")), 4, 10, False, 5) == []
    assert run_corpus(df, tokens.ArrayTokens(F.col("ids")), 4, 4, 5) == []


def test_text_moves_once(spark):
    df = spark.createDataFrame([(0, "a")], "k long, text string")
    out = pack.pack_batches(df, tokens.ByteTokens(F.col("text")), "k", 4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Union")[1]
    head = whole[: whole.index("Exchange")]
    # nothing is shuffled between the text's own exchange and the packed rows
    assert head.count("ObjectHashAggregate") == 2 and "ShuffledHashJoin" in head


def test_check_packed(spark):
    df = spark.createDataFrame(
        [([1, 2], [1, 2]), ([1], [1]), (None, [1, 2])],
        "input_ids array<int>, labels array<int>",
    )
    assert tuple(pack.check_packed(df, 2).first()) == (3, 2, 1, 1)


def test_byte_tokens_round_trip(spark):
    texts = ["", "abc", "é😀\x00\n", "Ā"]
    null = spark.createDataFrame([(None,)], "text string")
    assert null.select(tokens.tokenize_bytes(F.col("text"))).first()[0] is None
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    ids = tokens.tokenize_bytes(F.col("text"))
    got = df.select("text", ids.alias("ids"), tokens.detokenize_bytes(ids).alias("back"))
    for r in got.collect():
        assert r.ids == list(r.text.encode()) + [256] and r.back == r.text


def test_truncate_pad(spark):
    df = spark.createDataFrame([(0, [1, 2, 3]), (1, [9])], "i long, ids array<int>")
    got = {r.i: r for r in tokens.truncate_pad(df, "ids", 2, pad=None, eos=7).collect()}
    assert got[0].input_ids == [1, 2] and got[0].attention_mask == [1, 1]
    assert got[1].input_ids == [9, 7] and got[1].attention_mask == [1, 0]
    masked = tokens.truncate_pad(df, "ids", 2, mask_label=-100).collect()
    assert {tuple(r.labels) for r in masked} == {(1, 2), (9, -100)}


@pytest.mark.parametrize("head", [0, 2, 1000])
def test_vocabulary_by_any_split_of_the_lookup(spark, head):
    docs = [(0, "b a  a"), (1, "c"), (2, "a b a"), (3, "")]
    df = spark.createDataFrame(docs, "i long, text string")
    vocab = tokens.build_vocab(df).cache()
    ids = {r.word: (r.n, r.id) for r in vocab.collect()}
    assert ids == {"a": (4, 0), "": (2, 1), "b": (2, 2), "c": (1, 3)}
    coded = tokens.tokenize_vocab(df, vocab, "i", broadcast_words=head)
    assert {r.i: r.ids for r in coded.collect()} == {0: [2, 0, 1, 0], 1: [3], 2: [0, 2, 0], 3: [1]}
    back = tokens.detokenize_vocab(coded, vocab, "i", broadcast_words=head)
    assert {(r.i, r.text) for r in back.collect()} == set(docs)
    other = spark.createDataFrame([(9, "a zz c")], "i long, text string")
    known = tokens.tokenize_vocab(other, vocab, "i", broadcast_words=head)
    assert known.first().ids == [0, 3]
    unknown = tokens.tokenize_vocab(other, vocab, "i", unknown=99, broadcast_words=head)
    assert unknown.first().ids == [0, 99, 3]


def test_python_tokenizer(spark):
    encode = tokens.tokenizer_udf(lambda: lambda text: [len(w) for w in text.split()])
    df = spark.createDataFrame([("a bcd",), (None,)], "text string")
    assert [r.x for r in df.select(encode("text").alias("x")).collect()] == [[1, 3], None]


def test_whole_job_equals_its_steps(spark):
    rnd = random.Random(2)
    rows = [
        (i, rnd.choice("xxy"), "copy" if rnd.random() < 0.35 else f"text {i} é" * rnd.randrange(4))
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "i long, source string, text string").repartition(5)
    weights = {"x": 2, "y": 1}
    out = mix_dedup_pack(
        df, weights, "i", length=16, batch_docs=20, mode="quota", rows=8
    ).collect()
    keyed = []
    for n, (s, w) in enumerate(weights.items()):
        keyed += [((2 * k + 1) / w, n, t) for k, t in enumerate(t for _, z, t in rows if z == s)]
    ends = [max(k for k in keyed if k[1] == n)[:2] for n in range(2)]
    order = [t for a, n, t in sorted(keyed) if (a, n) <= min(ends)]
    kept = list(dict.fromkeys(order))
    want = batch_model([list(t.encode()) + [256] for t in kept], 16, 20, False)
    assert sorted((r.batch_id, r.block, r.input_ids) for r in out) == want
