"""Large JSON and CSV files cut at byte ranges: the same rows at any size of the ranges."""

import csv
import gzip
import io
import json
import random

import numpy as np
import pyarrow as pa
import pytest

from weftline.sources import files, ranges

BYTES = "spark.sql.files.maxPartitionBytes"
OPEN = "spark.sql.files.openCostInBytes"


@pytest.fixture(params=[60, 1 << 20])
def small_ranges(request, spark):
    before = {c: spark.conf.get(c) for c in (BYTES, OPEN)}
    spark.conf.set(BYTES, str(request.param))
    spark.conf.set(OPEN, "0")
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def texts(df):
    return [r["text"] for r in df.orderBy("path", "block", "row", "item").collect()]


def expected(text):
    """What a file gives by reading it whole: one value, else its good lines."""

    def of(value):
        for item in value if isinstance(value, list) else [value]:
            if isinstance(item, str):
                yield item
            elif isinstance(item, dict) and isinstance(item.get("text"), str) and item["text"].strip():
                yield item["text"].strip()

    try:
        return list(of(json.loads(text)))
    except ValueError:
        pass
    out = []
    for line in text.splitlines():
        try:
            out += of(json.loads(line))
        except ValueError:
            pass
    return out


STRINGS = ["a", "x, y", '"q"', "\\", "\\\\\"", "]", "[{", "},{", "é,ü", "line\nbreak", "", ",,,", " ", "\\u0041,", "{\"text\": \"no\"}"]


def value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind == 0:
        return rng.choice(STRINGS)
    if kind == 1:
        return {"text": rng.choice(STRINGS), "n": rng.choice([1, -2.5, None, True])}
    if kind == 2:
        return rng.choice([5, None, True, "s"])
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {"other": value(rng, depth + 1), "text": rng.choice([*STRINGS, 5, None, ["x", "y"]])}


ODD = [
    "", " \n", "[]", " [ \n ] \n", "[[]]", "{}", "[1, 2", '["a", "b"] x', '["a"]\n["b", "c"]\n', '["a",\n{bad}, "b"]',
    '["a", "b",\n]', '{"text": "one"}\n', '{\n"text": "pretty, {object}"\n}\n', '{"text": "a"}\n{"text": "b, c"}\n', '"scalar"\n', "5",
    '["unclosed, "]\n', '["a"], ["b"]', "]", '["a"]]', '[["a"]\n', '{"text": "x"]', '["a" "b"]', '["a\\', "[\"a\\\\\"]", '﻿["bom", "x"]',
]


def test_json_of_any_shape(spark, tmp_path, small_ranges):
    rng = random.Random(11)
    want = []
    for i in range(5):
        whole = [value(rng) for _ in range(rng.randrange(1, 9))]
        text = json.dumps(whole, indent=rng.choice([None, 1, 2]), ensure_ascii=rng.random() < 0.5, separators=rng.choice([None, (",", ":")]))
        (tmp_path / f"a{i:03}.json").write_text(text + rng.choice(["", "\n"]), encoding="utf-8")
        want += expected(text)
    for i, text in enumerate(ODD if small_ranges > 60 else ODD[::6]):
        (tmp_path / f"b{i:03}.json").write_text(text, encoding="utf-8")
        want += expected(text.lstrip("﻿"))
    with gzip.open(tmp_path / "c.json.gz", "wt") as out:
        out.write(json.dumps(["packed", {"text": "x, y"}], indent=1))
    got = texts(files.read_json(spark, str(tmp_path)))
    assert got == [*want, "packed", "x, y"]


def test_one_array_is_many_tasks(spark, tmp_path):
    items = [{"text": f"t{i}, \"{'z' * (i % 50)}\"", "n": [i, {"m": i}]} for i in range(4000)]
    (tmp_path / "one.json").write_text(json.dumps(items))
    before = {c: spark.conf.get(c) for c in (BYTES, OPEN)}
    spark.conf.set(BYTES, "20000")
    spark.conf.set(OPEN, "0")
    try:
        source = spark.read.option("lineSep", ",").text(str(tmp_path))
        assert source.rdd.getNumPartitions() > 10
        rows = files.read_json(spark, str(tmp_path)).collect()
    finally:
        for name, old in before.items():
            spark.conf.set(name, old)
    assert [r["text"] for r in sorted(rows, key=lambda r: r["item"])] == [i["text"] for i in items]
    assert sorted(r["item"] for r in rows) == list(range(4000))


CELLS = ["a", "b c", 'say "hi"', "x,y", "two\nlines", '"', "\n\n", "é", " lead", "", "tail ", "a\n\"b\",\nc"]


@pytest.mark.parametrize("quoting", [csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
def test_csv_with_line_breaks(spark, tmp_path, small_ranges, quoting):
    rng = random.Random(quoting)
    want = []
    for i in range(4):
        names = rng.choice([["text"], ["n", "text"], ["a\nb", "n", "text"], ["text", "n", "text"], ["other"]])
        out = io.StringIO()
        writer = csv.writer(out, quoting=quoting, lineterminator="\n")
        writer.writerow(names)
        for _ in range(rng.randrange(15)):
            writer.writerow([rng.choice(CELLS) for _ in names])
        (tmp_path / f"{i:03}.csv").write_text(out.getvalue(), encoding="utf-8")
        for row in csv.DictReader(io.StringIO(out.getvalue())):
            if (row.get("text") or "").strip():
                want.append(row["text"].strip())
    assert texts(files.read_csv_column(spark, str(tmp_path))) == want


def test_stray_quotes(spark, tmp_path, small_ranges):
    """A quote inside an unquoted field is a letter; an open quote reaches to the end of its file."""
    (tmp_path / "a.csv").write_text('text,n\n5" disk,1\nsix "feet",2\n"q""",3\n,4\nshort\nlong,1,2,3\n')
    (tmp_path / "b.csv").write_text('n;text\n1;"never\nclosed\n2;"\n')
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("text\n")
    assert texts(files.read_csv_column(spark, f"{tmp_path}/a.csv")) == ['5" disk', 'six "feet"', 'q"', "short", "long"]
    got = texts(files.read_csv_column(spark, str(tmp_path), delimiter=";", suffixes=[".csv"]))
    assert "never\nclosed\n2;" in got


def test_states_are_composed(spark):
    """Any mix of constant, kept and swapped states, against running them one after the other."""
    rng = random.Random(2)
    rows, want = [], {}
    for path in "abcd":
        state = 0
        for block in range(60):
            end = rng.choice([(0, 1), (1, 0), (0, 1), (0, 0), (1, 1)])
            rows.append((path, block, *end))
            want[path, block] = state
            state = end[state]
    found = ranges.with_state(spark.createDataFrame(rows, "path string, block long, end0 int, end1 int"))
    assert {(r["path"], r["block"]): r["state"] for r in found.collect()} == want


def test_a_shuffle_of_the_states_gives_the_same_rows(spark, tmp_path, monkeypatch):
    items = [f"t{i}, x" for i in range(200)]
    (tmp_path / "one.json").write_text(json.dumps(items))
    monkeypatch.setattr(ranges, "BROADCAST_RANGES", 0)
    spark.conf.set(BYTES, "700")
    try:
        assert texts(files.read_json(spark, str(tmp_path))) == items
    finally:
        spark.conf.unset(BYTES)


def test_many_files_by_join(spark, tmp_path, monkeypatch):
    for i in range(6):
        (tmp_path / f"{i}.json").write_text(json.dumps([f"a{i}", "b"], indent=1) if i % 2 else '"line"\n{bad\n"more"\n')
    monkeypatch.setattr(files, "DAMAGED", 2)
    assert texts(files.read_json(spark, str(tmp_path))) == ["line", "more", "a1", "b"] + ["line", "more", "a3", "b"] + ["line", "more", "a5", "b"]


def test_escaped_quotes():
    rng = random.Random(4)
    for _ in range(300):
        parts = ["".join(rng.choice('\\\\"a') for _ in range(rng.randrange(7))) for _ in range(5)]
        data, offsets = ranges._bytes(pa.array([p.encode() for p in parts]))
        want, at = [], 0
        for p in parts:
            for i, c in enumerate(p):
                back = len(p[:i]) - len(p[:i].rstrip("\\"))
                if c == '"' and back % 2 == 0:
                    want.append(at + i)
            at += len(p)
        assert ranges._quotes(data, offsets).tolist() == want and np.all(np.diff(offsets) >= 0)
