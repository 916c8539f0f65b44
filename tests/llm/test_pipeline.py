"""The stages on a small corpus, each against what it should keep."""

import random

import corpus_pipeline
from tests.llm.test_ngram_join import truth
from weftline.llm.pii import find_spans, redact

EN = "the and of with this that from have they will would there their what about which when make like time just know take people into year your good some could them see other than then now look only come its over think also back after use two how our work first well way even new want because any these give day most us".split()
DE = "der die und nicht das ist ein eine mit auf für von sich auch werden aus aber nach wie bei noch nur über zeit jahr mehr wenn schon können müssen sehr heute immer wieder gegen unter durch zwischen während ohne welche dieser jeder andere große kleine gute straße häuser".split()


def corpus():
    rng = random.Random(8)
    prose = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, prose(EN if i % 2 else DE, rng.randrange(30, 150)), "en" if i % 2 else "de") for i in range(160)]
    items = [(k, prose(EN, 30) + ". " + prose(EN, 8)) for k in range(5)]
    for i in range(160, 180):
        own = rows[i - 160][1].split()
        own[rng.randrange(len(own))] = "changed"
        rows.append((i, " ".join(own), None))
    rows += [(180, rows[5][1], "en"), (181, None, "en"), (182, "12345 --- 678", None), (183, "", None), (184, "zzqx " * 40 + "qxzj", None)]
    rows += [(185, prose(EN, 40) + " " + items[2][1] + " " + prose(EN, 40), "en"), (186, prose(EN, 40) + " me@mail.example.com +49 30 1234567", "en")]
    rows.append((187, prose(DE, 9000), "de"))
    return [(i, t, g, "s", len(t or "")) for i, t, g in rows], items


def test_stages(spark, tmp_path):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != "best_fit":
            assert docs.schema == before.schema
    ids = {k: [r["doc_id"] for r in v] for k, v in seen.items()}
    texts = {r[0]: r[1] for r in rows}
    spoken = set(texts) - {181, 182, 183, 184}
    assert sorted(ids["language_id"]) == sorted(spoken)
    groups = truth([(i, texts[i]) for i in sorted(spoken)])
    assert sorted(ids["ngram_join"]) == sorted(i for i in spoken if groups[i][0] == i)
    assert sorted(ids["decontaminate"]) == sorted(set(ids["ngram_join"]) - {185})
    for r in seen["pii"]:
        assert r["text"] == redact(texts[r["doc_id"]], find_spans(texts[r["doc_id"]])) and r["n_chars"] == len(r["text"])
    assert "[EMAIL]" in next(r["text"] for r in seen["pii"] if r["doc_id"] == 186)
    places = {}
    for r in seen["best_fit"]:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {r["doc_id"] for r in seen["best_fit"]} == set(ids["pii"])
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32").collect()} == {
        tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in seen["best_fit"]
    }
