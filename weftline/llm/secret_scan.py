"""Secrets by patterns and by a battery of randomness tests, all in DataFrame functions.

Fixed patterns give assignments, access keys and long hexadecimal runs. Any other run of
``TOKEN`` characters with letters and digits is a candidate: its encoding is inferred from
its characters, and three tests ask whether it could be uniform noise in that alphabet:
chi-squared on the character counts, the number of runs above and below the middle of the
alphabet, and the correlation of neighbours. The least p-value, corrected for three
tests, is the candidate's. Within each family of an encoding and a length class (octaves, as
long tokens give the tests more power) the Benjamini-Hochberg rule decides which candidates are
*not* random, at rate ``FALSE_RATE``; the rest is reported as ``random``. P-values are
counted in steps of a twentieth of a decade; a family has at most ``STEPS`` of them,
so thresholds are a small table whatever the input's size.

Null and empty texts have no span. Repeated rows are answered one by one. Columns but the
key and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.store import written

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Candidates of the tests: whole runs of these characters.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
KINDS = ("assign", "access", "hex", "random")
FALSE_RATE = 0.01
STEPS = 400

_LOW, _HIGH, _NUM = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Name, which tokens it takes (the first that fits), alphabet in order, least length.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", _NUM + "abcdef", 24),
    ("hex_upper", r"^[0-9A-F]+$", _NUM + "ABCDEF", 24),
    ("base32", r"^[A-Z2-7]+=*$", _HIGH + "234567", 24),
    ("alnum_lower", r"^[a-z0-9]+$", _LOW + _NUM, 20),
    ("alnum", r"^[A-Za-z0-9]+$", _HIGH + _LOW + _NUM, 20),
    ("base64", r"^[A-Za-z0-9+/]+=*$", _HIGH + _LOW + _NUM + "+/", 20),
    ("base64_url", r"^[A-Za-z0-9_-]+=*$", _HIGH + _LOW + _NUM + "-_", 20),
)

_SPAN = "array<struct<start: int, end: int, value: string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: start, end in code points, and the match.

    What lies between matches comes from ``split``; the lengths of both add up to places.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(between, found, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["match"].alias("value"))
        return F.when(pair["match"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))
        )

    every = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), every).otherwise(F.array().cast(_SPAN))


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a polynomial good to seven digits."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _by_encoding(body: Column, values: list) -> Column:
    out = F.lit(values[-1])
    for (_, pattern, _, _), value in list(zip(ENCODINGS, values, strict=True))[:-1][::-1]:
        out = F.when(body.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def randomness(tokens: DataFrame, token: str) -> DataFrame:
    """Add ``encoding``, ``p`` and ``family`` to rows with a token; p is null if not testable.

    Every measure has a column of its own, so that none is worked out twice.
    """
    body = F.regexp_replace(F.col(token), "=+$", "")
    mixed = F.col(token).rlike("[0-9]") & F.col(token).rlike("[A-Za-z]")
    fits = F.lit(False)
    for _, pattern, _, least in ENCODINGS:
        fits = fits | (F.col(token).rlike(pattern) & (F.length(token) >= least))
    out = tokens.withColumn("body", body).withColumn("n", F.length("body").cast("double"))
    out = out.withColumn("encoding", _by_encoding(F.col(token), [e[0] for e in ENCODINGS]))
    out = out.withColumn("alphabet", _by_encoding(F.col(token), [e[2] for e in ENCODINGS]))
    size = F.length("alphabet").cast("double")
    chars = F.array_distinct(F.split("body", ""))
    squares = F.aggregate(
        chars, F.lit(0.0), lambda a, c: a + F.pow(F.col("n") - F.length(F.replace(F.col("body"), c, F.lit(""))), F.lit(2.0))
    )
    out = out.withColumn("chi", squares * size / F.col("n") - F.col("n"))
    free = size - 1
    z_chi = (F.cbrt(F.col("chi") / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    out = out.withColumn("bits", F.expr(
        "array_join(transform(split(body, ''), c -> if(instr(alphabet, c) > length(alphabet) div 2, '1', '0')), '')"
    ))
    ones = F.length(F.replace("bits", F.lit("0"), F.lit(""))).cast("double")
    runs = F.length(F.regexp_replace("bits", r"(.)\1+", "$1")).cast("double")
    mean = 2 * ones * (F.col("n") - ones) / F.col("n") + 1
    spread = F.sqrt(F.greatest(F.lit(1e-9), (mean - 1) * (mean - 2) / (F.col("n") - 1)))
    out = out.withColumn("z_runs", (runs - mean) / spread)
    out = out.withColumn("codes", F.expr("transform(split(body, ''), c -> cast(instr(alphabet, c) as double))"))
    out = out.withColumn("middle", F.expr("aggregate(codes, 0D, (a, x) -> a + x) / n"))
    both = F.expr(
        "aggregate(zip_with(slice(codes, 1, cast(n as int) - 1), slice(codes, 2, cast(n as int) - 1),"
        " (x, y) -> (x - middle) * (y - middle)), 0D, (a, x) -> a + x)"
    )
    own = F.expr("aggregate(codes, 0D, (a, x) -> a + (x - middle) * (x - middle))")
    z_pairs = (both / F.greatest(own, F.lit(1e-9)) + 1 / F.col("n")) * F.sqrt("n")
    least = F.least(tail(z_chi), 2 * tail(F.abs("z_runs")), 2 * tail(F.abs(z_pairs)))
    out = out.withColumn("p", F.when(mixed & fits, F.least(F.lit(1.0), 3 * least)))
    family = F.concat_ws(":", "encoding", F.floor(F.log2("n")).cast("string"))
    return out.withColumn("family", family)


def step_of(p: Column) -> Column:
    """P-values in steps of a twentieth of a decade, from 0 (p = 1) up."""
    return F.least(F.lit(STEPS - 1), F.floor(-20 * F.log10(F.greatest(p, F.lit(1e-30))))).cast("int")


def thresholds(candidates: DataFrame, rate: float = FALSE_RATE) -> DataFrame:
    """(family, step): candidates at this step or beyond are not random."""
    counts = candidates.where("p is not null").groupBy("family", step_of(F.col("p")).alias("step")).agg(F.count("*").alias("rows"))
    family = Window.partitionBy("family")
    ranked = counts.select(
        "family", "step", F.sum("rows").over(family).alias("total"),
        F.sum("rows").over(family.orderBy(F.desc("step"))).alias("upto"),
    )
    # the largest p-value of the step counts for all of it
    kept = ranked.where(F.pow(F.lit(10.0), -F.col("step") / 20) <= rate * F.col("upto") / F.col("total"))
    return kept.groupBy("family").agg(F.min("step").alias("step"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = FALSE_RATE) -> DataFrame:
    """One row for each row: the key, and for each of KINDS an array of (start, end, value)."""
    value = F.coalesce(F.col(text), F.lit(""))
    # a scan writes down what it found, without the text; the tests read that twice
    spans = written(docs.select(
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"),
        F.filter(matches(value, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 8).alias("assign"),
        matches(value, ACCESS).alias("access"), matches(value, HEX).alias("hex"), matches(value, TOKEN).alias("token"),
    ), "secrets")
    base = F.concat("assign", "access", "hex")
    alone = F.filter("token", lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    tokens = randomness(spans.select("row", F.explode(alone).alias("span")).select("row", "span", F.col("span.value").alias("token")), "token")
    limits = F.broadcast(thresholds(tokens, rate))  # encodings times octaves of length
    kept = tokens.where("p is not null").join(limits.withColumnRenamed("step", "limit"), "family", "left")
    kept = kept.where(F.col("limit").isNull() | (step_of(F.col("p")) < F.col("limit")))
    added = kept.groupBy("row").agg(F.collect_list("span").alias("random"))
    return spans.drop("token").join(added, "row", "left").select(F.col("key").alias(key), *(
        F.coalesce(k, F.array().cast(_SPAN)).alias(k) for k in KINDS
    ))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts by base kind, the hash of the base spans, and all spans, from ``scan``."""
    found = scan(docs, key, text)

    def named(i: int) -> Column:
        def laid(s: Column) -> Column:
            return F.struct(s["start"].alias("start"), F.lit(i).alias("order"), s["end"].alias("end"), F.lit(KINDS[i]).alias("kind"))

        return F.transform(KINDS[i], laid)

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.concat(*(named(i) for i in range(3)))
    return found.select(
        key, *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(shown(base), 256).alias("base_sha256"), shown(F.concat(base, named(3))).alias("spans"),
    )
