"""Secret scanning against plain patterns; the tests of randomness on drawn strings."""

import hashlib
import random
import re

from pyspark.sql import Row
from pyspark.sql import functions as F

from weftline.llm.secret_scan import digest, randomness, scan

ASSIGN = re.compile(
    "((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))"
    "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def plain(text):
    out = [("assign", m) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    spans = sorted((m.start(), ("assign", "access", "hex").index(k), m.end(), k) for k, m in out)
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def test_same_as_patterns(spark):
    rng = random.Random(5)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", " ", "=", ":", '"', "'", "AKIA", "ABCD1234", "0123456789abcdef", "é", "😀", "x.y-z", "\n", "abc"]
    rows = [Row(doc_id=i, text="".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(1500)]
    rows += [Row(doc_id=2000, text=None), Row(doc_id=2001, text=""), Row(doc_id=2002, text="😀" * 50_000 + "token=abcdefgh1")]
    got = {r["doc_id"]: r for r in digest(spark.createDataFrame(rows).withColumn("row", F.lit("x")).withColumn("hex", F.lit(1))).collect()}
    for r in rows:
        want = plain(r["text"] or "")
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), r["text"]
        assert set(filter(None, want.split(","))) <= set(got[r["doc_id"]]["spans"].split(",")) or not want
        assert sum(got[r["doc_id"]][f"n_{k}"] for k in ("assign", "access", "hex")) == (want.count(",") + 1 if want else 0)


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "token: abcdefgh")] * 2 + [(None, "x")], "doc_id long, text string")
    assert sorted(r["n_assign"] for r in digest(docs).collect()) == [0, 1, 1]
    assert digest(docs.limit(0)).count() == 0


def test_noise_stays_and_words_go(spark):
    rng = random.Random(9)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    noise = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(300)]
    noise = [x for x in noise if re.search("[0-9]", x)]
    words = ["_".join(rng.choice(["report", "final", "version", "2021", "data", "table"]) for _ in range(6)) + "_1" for _ in range(300)]
    rows = [(i, f"see {x} here") for i, x in enumerate(noise)] + [(1000 + i, f"see {x} here") for i, x in enumerate(words)]
    got = {r["doc_id"]: len(r["random"]) for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] for i in range(len(noise))) >= 0.97 * len(noise)
    assert sum(v for k, v in got.items() if k >= 1000) <= 3


def test_p_values_of_noise_are_not_small(spark):
    rng = random.Random(1)
    rows = [("".join(rng.choice("0123456789abcdef") for _ in range(64)),) for _ in range(500)]
    p = [r["p"] for r in randomness(spark.createDataFrame(rows, "token string"), "token").collect()]
    assert sum(x < 0.05 for x in p) < 60
