import gzip
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from weftline.functions import json as J
from weftline.operators import select
from weftline.operators.ranks import dense_position
from weftline.plans.prepare import convert_directory
from weftline.sources import files, sinks, tables


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))


def texts(df):
    order = ["path", "block", "row", "item"]
    return [r.text for r in df.orderBy(*order).collect()]


def test_text_files(spark, tmp_path):
    write(tmp_path / "a.txt", "﻿ x\r\ny \n".replace("﻿", ""))
    write(tmp_path / "b.txt", b"ab\xff\xc3c")
    write(tmp_path / "sub" / "c.txt", " \n\t")
    write(tmp_path / "sub" / "d.TXT", "d")
    assert texts(files.read_text_files(spark, str(tmp_path))) == ["x\ny", "abc", "d"]
    flat = files.read_text_files(spark, str(tmp_path), recursive=False)
    assert texts(flat) == ["x\ny", "abc"]


def test_csv(spark, tmp_path):
    write(tmp_path / "a.csv", 'id,text\n1," a ""q"", b\nc "\n2,\n3\n4,é\n')
    assert texts(files.read_csv_column(spark, str(tmp_path))) == ['a "q", b\nc', "é"]
    assert texts(files.read_csv_column(spark, str(tmp_path), "none")) == []
    write(tmp_path / "s" / "d.csv", "text;n\nu,v;1\n")
    got = files.read_csv_column(spark, str(tmp_path / "s"), delimiter=";")
    assert texts(got) == ["u,v"]


def test_csv_files_with_different_headers(spark, tmp_path):
    write(tmp_path / "a.csv", "text,n\nfirst,1\n")
    write(tmp_path / "b.csv", 'm,n,"text"\n1,2,second\n')
    write(tmp_path / "c.csv", "other\nx\n")
    assert texts(files.read_csv_column(spark, str(tmp_path))) == ["first", "second"]


JSONL = '{"text":" a "}\n"  s "\n\n{"text":""}\n[{"text":"b"},"c",5]\n{"x":1}\n{"text":5}\n'


def test_json_lines(spark, tmp_path):
    write(tmp_path / "a.jsonl", JSONL + "{bad\n" + '{"text":"late"}\r\n')
    path = str(tmp_path)
    assert texts(files.read_jsonl(spark, path)) == ["a", "  s ", "b", "c", "late"]


def test_json_of_either_kind(spark, tmp_path):
    write(tmp_path / "a.json", JSONL)
    write(tmp_path / "b c.json", json.dumps([{"text": "p"}, "q", {"text": 1}], indent=2))
    write(tmp_path / "c.json", json.dumps({"text": "one"}, indent=2))
    write(tmp_path / "d.json", '{"text":"good"}\n{bad\n')
    write(tmp_path / "e[1].json", json.dumps(["brackets"], indent=2))
    got = texts(files.read_json(spark, str(tmp_path)))
    assert got == ["a", "  s ", "b", "c", "p", "q", "one", "good", "brackets"]
    only = files.read_json_documents(spark, str(tmp_path / "b c.json"))
    assert texts(only) == ["p", "q"]


def parquet(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


def test_parquet(spark, tmp_path):
    parquet(tmp_path / "a.parquet", text=[" a ", None, "  "], n=[1, 2, 3])
    parquet(tmp_path / "b.pq", n=[1])
    assert texts(files.read_parquet_column(spark, str(tmp_path))) == [" a "]


def test_mixed_directory(spark, tmp_path):
    write(tmp_path / "x" / "a.txt", "plain")
    write(tmp_path / "x" / "b.CSV", "text\nfrom csv\n")
    write(tmp_path / "c.json", '{"text":"from json"}')
    write(tmp_path / "d.jsonl", '{"text":"from jsonl"}')
    write(tmp_path / "e.bin", "no")
    parquet(tmp_path / "y" / "f.PQ", text=["from parquet"])
    write(tmp_path / "y" / "g.parquet", "not parquet at all")

    def sheets(spark, path, column, suffixes, recursive):
        return spark.createDataFrame(
            [("z.xlsx", 0, 0, 0, "from sheet")],
            "path string, block long, row long, item int, text string",
        )

    skip = files.damaged_names(files.skipped_files(spark, str(tmp_path)))
    assert [n.rsplit("/", 1)[1] for n in skip] == ["g.parquet"]
    got = files.ingest_mixed_dir(
        spark, str(tmp_path), readers={select.SHEET_SUFFIXES: sheets}, skip=skip
    )
    names = ["csv", "json", "jsonl", "parquet", "sheet"]
    assert sorted(texts(got)) == sorted([f"from {n}" for n in names] + ["plain"])
    flat = files.ingest_mixed_dir(spark, str(tmp_path), recursive=False)
    assert sorted(texts(flat)) == ["from json", "from jsonl"]


STRICT = {
    "[1,2] x": None, "[1],[2]": None, '[1]} {"a":[2]': None, "[1,2": None, "[1] ]": None, "[]": 0,
    ' [1, {"a":1,"a":2}] ': 2, "[[1],[2]]": 2, "[NaN]": None, "['a']": None, '{"a":[1]}': 1, "[null]": 1,
    "5": 1, "x": None, "": None, '"s" "t"': None,
}


def test_items_of_a_line_are_strict(spark):
    lines = spark.createDataFrame([(k,) for k in STRICT], "line string")
    got = J.with_items(lines, F.col("line"), "items").select("line", "items").collect()
    assert {r["line"]: None if r["items"] is None else len(r["items"]) for r in got} == STRICT


def test_large_values_are_not_taken_for_bad_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "VARIANT_BYTES", 50)
    write(tmp_path / "a.jsonl", '{"text":"ok"}\n{"bad": ' + "x" * 100 + "\n{bad\n")
    got = files.rejects(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r.line_no, r.reason) for r in got] == [(2, J.TOO_LARGE), (3, J.INVALID_JSON)]
    with pytest.raises(Exception, match="JSON with a value above"):
        files.read_jsonl(spark, str(tmp_path)).count()
    write(tmp_path / "b" / "a.json", "[\n" + ",\n".join(['{"text":"t"}'] * 50) + "\n]")
    assert files.read_json(spark, str(tmp_path / "b")).count() == 50


def test_damaged_files_are_recorded(spark, tmp_path):
    write(tmp_path / "in" / "a.jsonl", '{"text":"good"}\n')
    for name, cut in (("b.jsonl.gz", 40), ("c.jsonl.gz", None)):
        (tmp_path / "in" / name).write_bytes(gzip.compress(b'{"text":"packed"}\n' * 2000)[:cut])
    parquet(tmp_path / "in" / "d.parquet", text=[f"row {i}" for i in range(1000)])
    whole = (tmp_path / "in" / "d.parquet").read_bytes()
    (tmp_path / "in" / "e.parquet").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):
        files.read_parquet_column(spark, str(tmp_path / "in"), suffixes=select.PARQUET_SUFFIXES).count()
    record = files.skipped_files(spark, str(tmp_path / "in"))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in record.collect()) == ["b.jsonl.gz", "e.parquet"]
    assert all(r["reason"] for r in record.collect())
    skip = files.damaged_names(record)
    assert files.read_jsonl(spark, str(tmp_path / "in"), suffixes=[".jsonl", ".gz"], skip=skip).count() == 2001
    convert_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"), skip_damaged=True)
    assert spark.read.json(f"{tmp_path}/out/data").count() == 1001
    assert spark.read.json(f"{tmp_path}/out/skipped").count() == 2


def test_quoted_header(spark, tmp_path):
    write(tmp_path / "a.csv", '"a,b",text,"te""xt"\n1,first,x\n')
    assert texts(files.read_csv_column(spark, str(tmp_path))) == ["first"]
    assert texts(files.read_csv_column(spark, str(tmp_path), "a,b")) == ["1"]
    assert texts(files.read_csv_column(spark, str(tmp_path), 'te"xt')) == ["x"]


def test_part_files_are_in_corpus_order(spark, tmp_path):
    want = []
    for i in range(40):
        own = [f"{i:03} {k}" for k in range(1 + (i % 7) * 30)]
        want += own
        write(tmp_path / "in" / f"{i:03}.jsonl", "\n".join(json.dumps({"text": t}) for t in own))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        convert_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"), train_ratio=0.7)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def held(folder):
        parts = sorted((tmp_path / "out" / folder).glob("part-*.json"))
        return [json.loads(x)["text"] for p in parts for x in p.read_text().splitlines()]

    assert held("data") == want
    cut = int(len(want) * 0.7)
    assert held("splits/split=train") == want[:cut] and held("splits/split=val") == want[cut:]


def test_empty_directory(spark, tmp_path):
    write(tmp_path / "e.bin", "no")
    with pytest.raises(ValueError):
        convert_directory(spark, str(tmp_path), str(tmp_path / "out"))


def test_rejects_have_line_numbers(spark, tmp_path):
    lines = ['{"text":" a "}', "{bad", '{"x":1}', '{"text":5}', '{"text":"  "}', "", '["text"]']
    write(tmp_path / "a.jsonl", "\n".join(lines) + "\n")
    assert texts(files.load_valid_jsonl(spark, str(tmp_path))) == [" a "]
    got = files.rejects(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r.line_no, r.reason) for r in got] == [
        (2, "invalid JSON"), (3, "missing field"), (4, "not a string"),
        (5, "empty text"), (6, "invalid JSON"), (7, "missing field"),
    ]
    assert [r.line for r in got] == lines[1:]


def test_line_numbers_over_many_splits(spark, tmp_path):
    lines = [json.dumps({"text": "x" * (i % 90)}) if i % 7 else "{bad" for i in range(4000)]
    write(tmp_path / "a.jsonl", "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = files.rejects(spark, str(tmp_path)).filter("reason = 'invalid JSON'")
        numbers = sorted(r.line_no for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert numbers == [i + 1 for i in range(0, 4000, 7)]


def test_convert_directory_in_order(spark, tmp_path):
    for name in "abc":
        rows = [json.dumps({"text": f"{name}{i} é"}, ensure_ascii=False) for i in range(4)]
        write(tmp_path / "in" / f"{name}.jsonl", "\n".join(rows))
    out = tmp_path / "out"
    for _ in range(2):
        convert_directory(spark, str(tmp_path / "in"), str(out), train_ratio=0.75)
    split = spark.read.schema("text string, split string").json(str(out / "splits"))
    train = {r.text for r in split.filter("split = 'train'").collect()}
    assert train == {f"{n}{i} é" for n in "ab" for i in range(4)} | {"c0 é"}
    data = list((out / "data").glob("*.json"))
    lines = sorted(line for p in data for line in p.read_text("utf-8").splitlines())
    assert len(lines) == 12 and lines[0] == '{"text":"a0 é"}'


def test_shards_are_ordered_and_bounded(spark, tmp_path):
    df = spark.range(1000).select(
        "id", F.array(F.col("id").cast("int")).alias("input_ids")
    ).repartition(5)
    path = str(tmp_path / "s")
    sinks.write_packed_shards(df, path, ["id"], 1, max_shard_bytes=8 * 300, shards=2)
    sizes = []
    for p in (tmp_path / "s").glob("*.parquet"):
        ids = pq.read_table(p)["id"].to_pylist()
        assert ids == list(range(ids[0], ids[0] + len(ids)))
        sizes.append(len(ids))
    assert sum(sizes) == 1000 and max(sizes) <= 300


def test_tables_and_optional_split(spark, tmp_path):
    root = str(tmp_path)
    spark.range(20).write.parquet(tables.table_path(root, "t", "c", "train"))
    assert tables.read_source(spark, root, "t", "c").count() == 20
    assert tables.optional_split(spark, root, "t", "c") is None
    rows = tables.optional_split(spark, root, "t", "c", fallback_rows=5, key="id")
    assert sorted(r.id for r in rows.collect()) == [0, 1, 2, 3, 4]
    spark.range(3).write.parquet(tables.table_path(root, "t", "c", "validation"))
    assert tables.optional_split(spark, root, "t", "c").count() == 3


def test_column_choice_and_pages(spark):
    df = spark.createDataFrame([(1, " a ", "b"), (2, " ", "c")], "i int, x string, text string")
    assert [r.text for r in select.pick_text_column(df, keep=["i"]).collect()] == ["b", "c"]
    other = select.pick_text_column(df, "none", keep=["i"])
    assert [r.text for r in other.collect()] == [" a "]
    numbers = select.pick_text_column(df, "i")
    assert numbers.isEmpty() and numbers.dtypes == [("text", "string")]
    paged = spark.createDataFrame([(1, " p0 \f \fp2")], "i int, text string")
    pages = select.explode_pages(paged, F.split("text", "\f"), keep=["i"])
    assert [tuple(r) for r in pages.collect()] == [(1, 0, "p0"), (1, 2, "p2")]


def test_language_filter_takes_missing_as_none(spark):
    df = spark.createDataFrame([("Python",), (None,), ("C",)], "lang string")
    assert [r.lang for r in select.filter_language(df, "python").collect()] == ["Python"]


def test_positions_of_files(spark, tmp_path):
    write(tmp_path / "b.jsonl", '{"text":"2"}\n{"text":"3"}')
    write(tmp_path / "a.jsonl", '["0","1"]')
    df = dense_position(files.read_jsonl(spark, str(tmp_path)), files.ORDER)
    assert sorted((r.pos, r.text) for r in df.collect()) == [(i, str(i)) for i in range(4)]
