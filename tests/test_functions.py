import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import json as J
from weftline.functions import text as T


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_strip_equals_python_for_every_character(spark):
    values = [chr(c) + "a " + chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    assert column(spark, values, T.strip(F.col("v"))) == [v.strip() for v in values]


def test_blank(spark):
    values = ["", " \t \x1f", "a", None, "​"]
    assert column(spark, values, T.has_text(F.col("v"))) == [False, False, True, False, True]


def test_strip_of_a_long_run_inside_is_linear(spark):
    value = "a" + " " * 300_000 + "b"
    assert column(spark, [value], F.length(T.strip(F.col("v")))) == [300_002]


def test_decode_ignore_equals_python(spark):
    rnd = random.Random(4)
    pieces = [
        b"\xef\xbf\xbd", b"a", b"\xc3\xa9", b"\xe2\x82", b"\xf0\x9f\x98\x80", b"\xff",
        b"\xc3", b"\xed\xa0\x80", b"\xf0\x9f", b"\x80", b"\xc0\xaf", b"\xf4\x90\x80\x80",
        b"\xef\xbf", b"\x00",
    ]
    values = [b"".join(rnd.choices(pieces, k=rnd.randrange(12))) for _ in range(3000)]
    values.append(bytes.fromhex("6162FFC363"))
    got = column(spark, values, T.decode_utf8_ignore(F.col("v")), "binary")
    assert got == [v.decode("utf-8", "ignore") for v in values]
    assert got[-1] == "abc"


def test_newlines_hash_suffix_and_name_number(spark):
    assert column(spark, ["a\r\nb\rc\n"], T.universal_newlines(F.col("v"))) == ["a\nb\nc\n"]
    paths = ["a/b.TXT", "x.tar.gz", "noext", "/d.e/f", ".hidden", "q.PARQUET"]
    want = [pathlib.Path(p).suffix.lower() for p in paths]
    assert column(spark, paths, T.suffix(F.col("v"))) == want
    names = ["r/checkpoint-9", "checkpoint-10/", "checkpoint-error-99", "checkpoint-x"]
    assert column(spark, names, T.name_number(F.col("v"), "checkpoint")) == [9, 10, None, None]


LINES = [
    '{"text":"a"} x', '{"text":"a"}] x', '{"text":"a"}} x', '{"a":1},{"b":2}', "", "{bad",
    '{"x":1}', '{"text":5}', '{"text":"  "}', '{"text":"a","text":"b"}', '"str"', "[1,2]",
    "[]", "{}", "null", "1", '"a" "b"', "1 2", '{"text":null}', '{"text":{"a":1}}',
    '{"te.xt":"z","text":"\\u00e9\\n"}', ' {"text":"sp"} ', '{"text":"tab\there"}', "[[1]",
    '{"v":1}', '{"a":1,"v":2}', "1],[2", '1,"w":2', '{"text":"a"},"w":{"b":2}', "tru",
    '{"a":[1,{"text":"deep"}]}', "-0", '{"text":"x",}', "{'text':'x'}", '{"": 1}', '""',
]


def test_strict_json_equals_python(spark):
    def parse(line):
        try:
            value = json.loads(line)
        except json.JSONDecodeError:
            return False, None
        text = value.get("text") if isinstance(value, dict) else None
        return True, text if isinstance(text, str) else None

    value = J.strict_json(F.col("v"))
    got = column(spark, LINES, F.struct(value.isNotNull(), J.text_field(value, "text")))
    assert [tuple(r) for r in got] == [parse(line) for line in LINES]


def test_field_with_a_dot_or_quote(spark):
    lines = ['{"te.xt":"z"}', '{"it\'s":"q"}']
    value = J.strict_json(F.col("v"))
    assert column(spark, lines, J.text_field(value, "te.xt")) == ["z", None]
    assert column(spark, lines, J.text_field(value, "it's")) == [None, "q"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from weftline.session import scratch_dir

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        scratch_dir(Cluster())
