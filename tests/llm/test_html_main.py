"""Main text by maximum-scoring subsequence: hand-made pages, brute force over regions, given pages."""

import html
import itertools
import random
import re

import pytest
from pyspark.sql import Row

from weftline.llm.html_main import Weights, best_region, extract, label_counts, learn_weights, main_text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def weights(spark):
    return learn_weights(spark.read.parquet(f"{SF}/pages.parquet"))


def test_best_region_is_the_greatest_sum():
    rng = random.Random(3)
    for _ in range(500):
        scores = [rng.choice([-3, -1, 0, 1, 2]) for _ in range(rng.randrange(12))]
        start, end = best_region([float(s) for s in scores])
        sums = [sum(scores[a:b]) for a, b in itertools.combinations(range(len(scores) + 1), 2)]
        assert sum(scores[start:end]) == max([0, *sums])


def test_weights_have_their_signs(weights):
    assert all(w >= 0 for w in weights.words.values()) and weights.words["inside", False] > 0.9
    assert all(w < 0 for w in weights.tags.values()) and weights.tag("never-seen", False) < 0


def test_given_pages(spark, weights):
    """On the given pages the article is known from its tags."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in extract(pages, weights).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for row in rows:
        inner = re.search("<article>(.*)</article>", row["html"], re.S).group(1)
        plain = " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())
        assert got[row["page_id"]]["text"] == plain
        assert got[row["page_id"]]["n_chars"] == len(plain) and got[row["page_id"]]["url"] == row["url"]


WORDS = "some words that make up the paragraph of this page"
CASES = {
    "holes inside": (
        "<body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header><article><header><h1>Title here</h1></header>"
        "<p>One &lt;two&gt; &amp; thr<i>ee</i>.<aside>Side <b>note</b></aside><p>Four<br>six<div class='ad-slot'>Buy now</div>"
        "<ul><li>a<li>b</ul><form><input>Name<button>Go</button></form><section class=comments><article><p>I like it "
        "very much indeed</p></article></section></article><footer>foot</footer>",
        "Title here One <two> & three. Four six a b",
    ),
    "no article element": (
        f"<body class=has-sidebar><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul><h1>Great title</h1><p>{WORDS}"
        f"</p><p>{WORDS}</p><ul><li><a href=1>Home</a></li></ul><div id=cookie-notice>We use cookies</div></body>",
        f"Great title {WORDS} {WORDS}",
    ),
    "content by class": (
        f"<div class='site header'>Us</div><div class='entry-content wide'><div>{WORDS}</div><div>end</div></div><div>{WORDS}</div>",
        f"{WORDS} end",
    ),
    "unclosed menu": ("<body><nav><ul><li>x y z<article><p>Text a b c</p></article>", "Text a b c"),
    "unclosed advert": ("<body><div class=ad>Buy<p>Text a b c</p><p>more text</p>", "Text a b c more text"),
    "articles in a sidebar": ("<main><p>a b c</p></main><aside><article>Teaser one</article></aside>", "a b c"),
    "boilerplate by class": (
        "<article><h1>Title</h1><p>a b c</p><div class='discussion'><p>I agree</p></div><div id=cookiebar>ok</div>"
        "<div class=no-ads>d e</div></article>",
        "Title a b c d e",
    ),
    "longest article": (f"<article>short one</article><article><p>{WORDS}</p></article>", WORDS),
    "comment, script, style": ("<article>a<!-- <p>x --> b<script>'</p>'</script> c<style>p{}</style></article>", "a b c"),
    "unclosed comment": ("<article>a b</article><!-- never ends <p>x", "a b"),
    "white space": ("<article><p> a\n\t&nbsp;b </p>c</article>", "a b c"),
    "quoted bracket": ('<article><p title="a > b">text</p></article>', "text"),
    "references once": ("<article>&amp;amp; &#233; &eacute; &copy;</article>", "&amp; é é ©"),
    "no tags": ("just words < 5", "just words < 5"),
    "unknown role": ("<div role=navigation>Menu</div><div role=main><p>a b</p></div>", "a b"),
    "empty": ("", ""),
    "no text": ("<article><img src=x></article>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(weights, name):
    page, text = CASES[name]
    assert main_text(page, weights) == text


def test_odd_rows(spark, weights):
    rows = [Row(page_id=1, url="u", html=None, text=5, key="k"), Row(page_id=None, url=None, html="<article>a</article>", text=6, key="k")]
    rows += [rows[1], Row(page_id=2, url="v", html="<article>" + "<p>a b</p>" * 50_000 + "</article>", text=7, key=None)]
    rows.append(Row(page_id=3, url="w", html="<div>" * 20_000 + "x" + "</p></span>" * 20_000, text=7, key=None))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int, key string")
    got = sorted((r["page_id"] or 0, r["url"], len(r["text"]), r["n_chars"]) for r in extract(pages, weights).collect() if r["url"])
    assert got == [(1, "u", 0, 0), (2, "v", 199_999, 199_999), (3, "w", 1, 1)]
    assert [r["text"] for r in extract(pages, weights).where("page_id is null").collect()] == ["a", "a"]
    nothing = pages.limit(0)
    assert extract(nothing, learn_weights(nothing)).collect() == []


def test_pages_without_labels_say_nothing():
    assert label_counts("<p>a</p>") == {} and label_counts("<article>a</article><article>b</article>") == {}
    bare = Weights({})
    assert main_text(f"<div><a href=x>Home</a></div><p>{WORDS}</p>", bare) == WORDS
