from pyspark.sql import functions as F

from weftline.operators.pack import pack_batches
from weftline.operators.tokens import ByteTokens
from weftline.sources.tables import stream_files
from weftline.streaming import jobs

SCHEMA = "i long, lang string, text string"


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, source, build, name):
    stream = stream_files(spark, source, spark.read.parquet(source).schema)
    out = build(stream)
    jobs.run_available(jobs.to_parquet(out, str(tmp_path / name)), str(tmp_path / f"{name}-log"))
    return spark.read.schema(out.schema).parquet(str(tmp_path / name))


def test_dedup_goes_on_after_a_restart(spark, tmp_path):
    source = str(tmp_path / "in")
    add(spark, source, [(0, "en", "a"), (1, "en", "a"), (2, "fr", "b")])
    first = run(spark, tmp_path, source, jobs.stream_dedup, "out")
    assert sorted(r.text for r in first.collect()) == ["a", "b"]
    add(spark, source, [(3, "en", "b"), (4, "en", "c")])
    again = run(spark, tmp_path, source, jobs.stream_dedup, "out")
    assert sorted(r.text for r in again.collect()) == ["a", "b", "c"]


def test_standardize_and_tokenize(spark, tmp_path):
    source = str(tmp_path / "in")
    add(spark, source, [(0, "EN", "a"), (1, None, "b"), (2, "en", " ")])
    got = run(
        spark, tmp_path, source,
        lambda s: jobs.stream_standardize(s, "text", "en", keep=["i"]), "std",
    )
    assert [tuple(r) for r in got.collect()] == [(0, "a")]
    ids = run(spark, tmp_path, source, lambda s: jobs.stream_tokenize(s.drop("lang"), 3), "tok")
    assert {r.i: r.input_ids for r in ids.collect()}[0] == [97, 256, 257]


def test_packing_goes_on_after_a_restart(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i, "en", f"text {i}") for i in range(10)]
    for part in range(2):
        add(spark, source, rows[part * 5 : part * 5 + 5])
        stream = stream_files(spark, source, spark.read.parquet(source).schema)
        writer = jobs.stream_pack(stream, out, ["i"], length=8, batch_docs=3)
        last = jobs.run_available(writer, str(tmp_path / "log"))
    jobs.finish_pack(spark, out, stream.schema, last, ["i"], length=8)
    want = pack_batches(spark.createDataFrame(rows, SCHEMA), ByteTokens(F.col("text")), "i", 8, 3)
    got = spark.read.parquet(f"{out}/packed").select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect())
