"""Inputs that queries write, and what a task holds: whatever the size of the tables."""

from __future__ import annotations

import glob
import json

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from weftline.operators import split, tokens
from weftline.plans import file_queries, stream_queries, token_queries
from weftline.session import scratch_dir, scratch_path
from weftline.sources import files, sinks
from weftline.streaming import jobs


def documents(spark, tmp_path, rows, parts=1):
    """A folder with a documents table of ``(doc_id, text)`` rows in ``parts`` files."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("*", F.lit("es").alias("lang"), F.lit("s").alias("source"))
    docs.repartitionByRange(parts, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_one_file_for_each_row_also_where_keys_repeat(spark, tmp_path):
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, " c\nd "), (3, "")]
    found = file_queries.read_text_files(spark, documents(spark, tmp_path, rows))
    assert sorted(map(tuple, found.collect())) == [(1, "a"), (1, "b"), (1, "b"), (2, "c\nd")]


def test_files_are_dealt_to_a_bounded_number_of_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FOLDERS", 4)
    sinks.write_each(spark.range(100).select("id", F.col("id").cast("string").alias("text")), str(tmp_path), "id", "text")
    assert len(glob.glob(f"{tmp_path}/*")) == 4
    assert len(glob.glob(f"{tmp_path}/*/id=*.txt")) == 100


def test_a_task_reads_many_small_files(spark, tmp_path):
    path = f"{tmp_path}/a b%20ü"
    sinks.write_each(spark.range(300).select("id", F.col("id").cast("string").alias("text")), path, "id", "text")
    assert len(glob.glob(f"{path}/*/id=*.txt")) == 300
    found = files.read_text_files(spark, path)
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism < 300 // 32
    assert sorted(int(r["text"]) for r in found.collect()) == list(range(300))


def odd_tree(root):
    contents = {
        "a.txt": b" a\r\nb\rc \n", "B.TXT": b"ab\xff\xc3c\xef\xbf\xbd", "blank.txt": " \n\u2003".encode(), "empty.txt": b"", "none": b"n",
        "sp ace%20+.txt": b"1", "ü#?.txt": "ü".encode(), "sub/x=1/deep er/c.txt": b"c", "sub/x=1/d.csv": b"d", "[s]/{e}.txt": b"2",
        "_h.txt": b"h", ".h.txt": b"h", "_k=v.txt": b"kv", "z.txt._COPYING_": b"z", "_tmp/t.txt": b"t", "_k=v/t.txt": b"t2",
        "_metadata/m.txt": b"m", "_metadata.txt": b"m2", ".dot/t.txt": b"t3", "sub/long.txt": b"long" * 50,
    }
    for name, content in contents.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)


def test_tasks_read_the_files_that_spark_reads(spark, tmp_path, monkeypatch):
    root = tmp_path / "in %41 ö"
    odd_tree(root)
    names = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(str(root))
    names = {r["n"] for r in names.select(F.col("_metadata.file_path").alias("n")).collect()}
    skip = [n for n in names if n.endswith(("ace%2520+.txt", "c.txt"))]
    assert len(skip) == 2
    calls = [{}, {"suffixes": (".txt",)}, {"skip": skip}, {"suffixes": (".csv", ".Txt"), "skip": skip}]
    calls = [{"path": str(root), **c} for c in calls] + [{"path": f"{root}/sub/"}, {"path": f"file:{root}/sub/x=1"}]
    monkeypatch.setattr(files, "PIECE_FILES", 2)
    monkeypatch.setattr(files, "PIECE_BYTES", 100)
    ours = [files.read_text_files(spark, **c) for c in calls]
    monkeypatch.setattr(files, "_small_files", lambda *_: None)
    sparks = [files.read_text_files(spark, **c) for c in calls]
    for one, other in zip(ours, sparks, strict=True):
        assert one.dtypes == other.dtypes
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    assert [len(other.collect()) for other in sparks] == [12, 10, 10, 9, 3, 2]
    assert any(r["text"] == "long" * 50 for r in ours[0].collect())


def test_paths_that_are_no_folder_go_to_spark(spark, tmp_path):
    odd_tree(tmp_path)
    assert [r["text"] for r in files.read_text_files(spark, f"{tmp_path}/a.txt").collect()] == ["a\nb\nc"]
    assert sorted(r["text"] for r in files.read_text_files(spark, f"{tmp_path}/[aB].*").collect()) == ["a\nb\nc", "abc\ufffd"]
    (tmp_path / "new").mkdir()
    assert files.read_text_files(spark, f"{tmp_path}/new").collect() == []


def test_check_sums_beside_text_files_are_compared(spark, tmp_path):
    path = f"{tmp_path}/written"
    spark.createDataFrame([("some text",)], "text string").coalesce(1).write.text(path)
    assert glob.glob(f"{path}/.part-*.crc")
    assert [r["text"] for r in files.read_text_files(spark, str(tmp_path)).collect()] == ["some text"]
    (part,) = glob.glob(f"{path}/part-*")
    with open(part, "w") as out:
        out.write("other one\n")
    with pytest.raises(Exception, match="[Cc]hecksum"):
        files.read_text_files(spark, str(tmp_path)).collect()


def test_arrays_of_bounded_files_keep_the_numbers_of_their_items(spark, tmp_path):
    rows = [(i * 3, f"text {i}, \"quoted\" [" + "x" * (i % 7)) for i in range(100)]
    docs = spark.read.parquet(documents(spark, tmp_path, rows) + "/documents.parquet")
    path = scratch_path(spark, "arrays")
    file_queries.write_arrays(docs, path, 300)
    written = glob.glob(f"{path}/first=*/*.txt")
    assert len(written) > 4
    assert sum(len(json.load(open(name))) for name in written) == 100
    found = sorted(map(tuple, file_queries.read_arrays(spark, path).collect()))
    assert found == [(i, text) for i, (_, text) in enumerate(rows)]


def test_csv_has_a_file_for_every_so_many_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(file_queries, "FILE_BYTES", 200)
    rows = [(i, f'line {i}\n"quoted", ' + "x" * (i % 7) + ".") for i in range(100)]
    before = set(glob.glob(f"{scratch_dir(spark)}/csv-split-*"))
    found = file_queries.read_csv_split(spark, documents(spark, tmp_path, rows, 8))
    assert sorted(r["text"] for r in found.collect()) == sorted(text for _, text in rows)
    tables = [p for p in set(glob.glob(f"{scratch_dir(spark)}/csv-split-*")) - before if glob.glob(f"{p}/*.csv")]
    assert [len(glob.glob(f"{p}/*.csv")) > 1 for p in tables] == [True]


def test_a_quarter_of_the_stream_is_written_by_many_tasks(spark, tmp_path):
    rows = [(i, f"{i} " * (i % 50)) for i in range(300)]
    sf_dir = documents(spark, tmp_path, rows, 16)
    before = set(glob.glob(f"{scratch_dir(spark)}/stream-pack-*"))
    found = stream_queries.stream_pack(spark, sf_dir)
    whole = token_queries.packed_summary(token_queries.packed_batches(spark, sf_dir))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    (path,) = set(glob.glob(f"{scratch_dir(spark)}/stream-pack-*")) - before
    assert all(len(glob.glob(f"{path}/in/{i}/*.parquet")) > 1 for i in range(4))
    assert len(glob.glob(f"{path}/out/done/epoch=*")) == 4


def test_a_tokenizer_gives_ids_away_before_its_batch_ends(spark, monkeypatch):
    monkeypatch.setattr(tokens, "ENCODED_IDS", 10)
    texts = ["abc", None, "", "d" * 25, "efgh"]
    encode = tokens.tokenizer_udf(token_queries.byte_tokenizer).func
    pieces = list(encode(iter([pa.array(texts), pa.array([], pa.string())])))
    assert [len(p) for p in pieces] == [4, 1]
    assert pa.chunked_array(pieces).to_pylist() == [None if t is None else list(t.encode()) for t in texts]


def test_of_the_words_only_the_different_ones_of_a_block_move(spark):
    texts = [(1, "a b a"), (1, "a b a"), (2, None), (3, ""), (None, " b  zz"), (4, "a\nb")]
    docs = spark.createDataFrame(texts, "k long, text string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("", 2), ("x" * 200, 3)], "word string, id long")
    for head in (0, 1, 10):
        ids = tokens.tokenize_vocab(docs, vocab, "k", broadcast_words=head)
        assert "posexplode" not in ids._jdf.queryExecution().toString()
        found = sorted(map(tuple, ids.collect()), key=str)
        assert found == sorted([(1, [0, 1, 0]), (1, [0, 1, 0]), (2, []), (3, [2]), (None, [2, 1, 2]), (4, [])], key=str)
        coded = tokens.tokenize_vocab(docs, vocab, "k", unknown=-1, broadcast_words=head).filter("k is null")
        assert coded.first()["ids"] == [2, 1, 2, -1]
        back = tokens.detokenize_vocab(ids, vocab, "k", broadcast_words=head)
        assert "posexplode" not in back._jdf.queryExecution().toString()
        expected = [(1, "a b a"), (1, "a b a"), (2, ""), (3, ""), (None, " b "), (4, "")]
        assert sorted(map(tuple, back.collect()), key=str) == sorted(expected, key=str)


def test_shards_are_shuffled_in_fewer_bytes(spark):
    rows = [
        (1, [0, 255, 256], [0, 255, 256]), (2, [-(1 << 15), (1 << 15) - 1], [7]), (3, [1 << 15, None], [1 << 15, None]),
        (4, None, [1 << 20]), (5, [], None), (6, None, None), (7, [None], [None, 1]),
    ]
    df = spark.createDataFrame(rows, "k long, input_ids array<int>, labels array<int>")
    narrow = sinks._narrowed(df)
    kept = {r["k"]: r for r in narrow.collect()}
    assert (kept[1]["_short_input_ids"], kept[1]["input_ids"], kept[1]["labels"], kept[1]["_short_labels"]) == ([0, 255, 256], None, None, None)
    assert (kept[3]["_short_input_ids"], kept[3]["labels"]) == (None, None)
    whole = sinks._widened(narrow, df.columns)
    assert whole.dtypes == df.dtypes
    assert sorted(map(tuple, whole.collect())) == rows


def test_packed_rows_are_written_as_compressed_json(spark, tmp_path):
    sf_dir = documents(spark, tmp_path, [(i, f"{i} " * (i % 50)) for i in range(300)])
    before = set(glob.glob(f"{scratch_dir(spark)}/packed-json-*"))
    found = file_queries.load_packed_json(spark, sf_dir)
    whole = token_queries.packed_summary(token_queries.packed_batches(spark, sf_dir))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    (path,) = set(glob.glob(f"{scratch_dir(spark)}/packed-json-*")) - before
    assert glob.glob(f"{path}/*.json.gz") and not glob.glob(f"{path}/*.json")


def test_a_split_by_a_key_of_several_columns(spark):
    rows = [(p, b, i, f"{p}{b}{i}") for p in "ab" for b in (0, 1 << 40) for i in range(25)] + [("a", 0, 3, "again")] * 3
    df = spark.createDataFrame(rows, "path string, block long, row long, text string")
    df = df.select(F.struct("path", "block", "row").alias("place"), "text")
    for n in (0, 3, 5, 40, 103):
        parts = split.split_sequential(df, "place", n / 103 + 1e-9).collect()
        train = sorted(tuple(r["place"]) for r in parts if r["split"] == "train")
        assert train == sorted(r[:3] for r in rows)[:n]
        assert len(parts) == 103


def test_early_stop_takes_plain_rows():
    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    run = jobs._EarlyStop(2, 0.5)
    run.state = Held()
    first = [Row(step=s, loss=x, counts=c) for s, x, c in ((3, 5.0, True), (1, 6.0, True), (2, 0.0, False))]
    (row,) = run.handleInputRows((None,), iter(first), None)
    assert tuple(row) == (None, 2, None, None)
    (row,) = run.handleInputRows((None,), iter([Row(step=s, loss=5.0, counts=True) for s in (9, 8)]), None)
    assert row.asDict() == {"by0": None, "seen": 4, "stop_index": 3, "stop_step": 9}
