"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is a sequence of words, which score above zero, and tags, which score below; the
contiguous region with the greatest sum is the article, found in one linear scan (Kadane).
Elements that are never article text (menus, adverts, forms, ...) are holes: neither their
words nor their tags count, and a region may reach across them without their text.

Weights are learned from labelled pages: a page with exactly one ``article`` (or ``main``)
element says that what stands inside is main text and the rest is not. Words are told
apart by where they stand (inside such an element or a ``content`` one, beside it, or on a
page without any) and by whether they are linked, tags by place and name.

Null, empty and text-free pages give an empty text. Of regions with one sum the first
counts. Repeated rows are answered one by one, null keys are kept, only the named columns
are read. Unclosed elements end with their parent; a hole that is never closed ends where an
article begins or, on a page without any, at the next block. An unclosed comment or script
reaches to the end of the page. No text is cut.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.blocks import slices

#: Weights are learned from about this many pages, picked by a hash of the key.
SAMPLE = 5000
#: A tag costs at least ``TAG_FLOOR``; one that only stands outside articles costs ``TAG_SPAN`` more.
TAG_FLOOR = 0.05
TAG_SPAN = 1.0

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
_BLOCK = frozenset(
    """address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu
    nav noscript ol optgroup option p pre script search section select style summary table tbody td template
    textarea tfoot th thead title tr ul video audio canvas object""".split()
)
#: These begin a new paragraph, so an open one ends.
_ENDS_P = _BLOCK - frozenset(("br", "button", "iframe", "object", "video", "audio", "canvas", "script", "style", "template"))
#: An element of the first kind ends an open one of the second.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody"), "body": ("head",),
}
_SCOPE = frozenset("ul ol dl table select article aside nav main section div form body".split())

#: Elements that hold no article text.
_HOLES = _RAW | frozenset(
    """head nav footer aside form button select option template object svg math canvas audio video dialog menu
    search""".split()
)
_HOLE_ROLES = frozenset(
    """navigation banner contentinfo complementary search form menu menubar toolbar dialog alertdialog alert
    tablist""".split()
)
#: Words of a class or id that name such an element.
_HOLE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors
    promo promos promotion promoted banner banners cookie cookies consent gdpr notice notices notification
    notifications alert announcement disclaimer paywall nav navbar navigation menu menus breadcrumb breadcrumbs
    sidebar sidebars rail widget widgets footer footers masthead topbar toolbar pagination pager comment comments
    commentlist disqus respond reply replies newsletter subscribe subscription signup login share sharing social
    related recommended recommendations popup modal overlay skip copyright aside discussion usercomments adbox
    topnav subnav navlinks cookiebar""".split()
)
_HEADER_WORDS = frozenset(("header", "headers"))
#: Class names that begin so tell of a state, not of what the element is.
_STATES = frozenset(("has", "no", "with", "without", "is", "js"))
#: The few of the words above that tell of a whole article or main element that is none.
_OTHER_MAIN = frozenset(
    """ad ads advert advertisement sponsored promo promoted comment comments reply replies related recommended
    recommendations widget sidebar""".split()
)
#: Classes and ids of elements that hold the article where no element of that name does.
_CONTENT = frozenset(
    """content main-content page-content article article-body article-content post-body post-content entry-content
    entry-body story-body""".split()
)
#: Kinds of main elements, the narrowest first.
_KINDS = ("article", "content", "main")
#: Elements whose end tag may be left out.
_OPTIONAL_END = frozenset("p li dt dd option optgroup tr td th thead tbody tfoot head body html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|title|textarea|noscript|iframe|noembed|noframes|xmp)(?=[\s/>])"
    r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-z][^>]*+\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Where a word stands: inside a main element, beside one, on a page without any.
INSIDE, BESIDE, ALONE = "inside", "beside", "alone"


def _attributes(text: str) -> Iterator[tuple[str, str]]:
    """Names and single values of the attributes that tell what an element is for."""
    for kind, one, two, three in _ATTRIBUTE.findall(text):
        for value in (one or two or three).split():
            yield kind.lower(), value


def _main_kind(name: str, attributes: str) -> str | None:
    """One of ``_KINDS`` or nothing."""
    if name in ("article", "main"):
        return name
    for kind, value in _attributes(attributes):
        if kind == "role" and value.lower() in ("article", "main"):
            return value.lower()
        if kind == "itemprop" and value.lower() == "articlebody":
            return "article"
        if kind in ("class", "id") and value.lower() in _CONTENT and name in ("div", "section", "td"):
            return "content"
    return None


def _is_hole(name: str, attributes: str, main: str | None, in_main: bool) -> bool:
    if name in _HOLES or name == "header" and not in_main:
        return True
    if not attributes or main == "main" or name in ("html", "body"):
        return False
    for kind, value in _attributes(attributes):
        if kind == "role" and value.lower() in _HOLE_ROLES:
            return True
        if kind in ("class", "id"):
            parts = [p.lower() for p in _PART.findall(value)]
            if not parts or parts[0] in _STATES:
                continue
            words = _OTHER_MAIN if main else _HOLE_WORDS if in_main else _HOLE_WORDS | _HEADER_WORDS
            if not words.isdisjoint(parts):
                return True
    return False


@dataclass(slots=True)
class Piece:
    """A tag (``tag`` is its name) or a run of text, with the elements around it: the number
    of the outermost of each of ``_KINDS`` (0 if none), whether any is a hole or a link."""

    tag: str | None
    text: str
    breaks: bool
    article: int
    content: int
    main: int
    hole: bool
    linked: bool


@dataclass(slots=True)
class _Open:
    name: str
    main: str | None
    hole: bool
    number: int


class _Parser:
    """``unclosed`` numbers the holes that end without an end tag; a second run knows them as ``leaky``."""

    def __init__(self, leaky: frozenset[int] = frozenset(), any_main: bool = True) -> None:
        self.leaky, self.any_main = leaky, any_main
        self.open: list[_Open] = []
        self.names: Counter[str] = Counter()
        self.pieces: list[Piece] = []
        self.around = dict.fromkeys(_KINDS, 0)
        self.count = dict.fromkeys(_KINDS, 0)
        self.holes = self.links = self.number = 0
        self.unclosed: set[int] = set()
        self.saw_main = False

    def _leave(self, at: int, own: bool) -> None:
        """Close everything from place ``at`` of the stack on; ``own`` if the first has an end tag."""
        for left in self.open[at:]:
            if left.main:
                self.around[left.main] -= 1
            self.holes -= left.hole
            self.names[left.name] -= 1
            self.links -= left.name == "a"
            if left.hole and not own and left.name not in _OPTIONAL_END:
                self.unclosed.add(left.number)
            own = False
        del self.open[at:]

    def _end(self, names: tuple[str, ...], scope: frozenset[str], own: bool) -> None:
        if not any(self.names[name] for name in names):
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].name in names:
                self._leave(at, own)
                return
            if self.open[at].name in scope:
                return

    def _add(self, tag: str | None, text: str, breaks: bool) -> None:
        numbers = [self.count[kind] if depth else 0 for kind, depth in self.around.items()]
        self.pieces.append(Piece(tag, text, breaks, *numbers, self.holes > 0, self.links > 0))

    def start(self, name: str, attributes: str) -> None:
        if name in _ENDS_P:
            self._end(("p",), _SCOPE, False)
        if name in _ENDS:
            self._end(_ENDS[name], _SCOPE - {name}, False)
        main = _main_kind(name, attributes)
        if self.leaky and self.holes and (main or not self.any_main and name in _BLOCK):
            for at, element in enumerate(self.open):
                if element.hole:
                    if element.number in self.leaky:
                        self._leave(at, True)
                    break
        hole = _is_hole(name, attributes, main, any(self.around.values()))
        if hole:
            main = None
        self.saw_main |= main is not None
        if self.holes:
            main = None
        if main and not self.around[main]:
            self.count[main] += 1
        self.number += 1
        if name not in _VOID:
            self.open.append(_Open(name, main, hole, self.number))
            self.names[name] += 1
            if main:
                self.around[main] += 1
            self.holes += hole
            self.links += name == "a"
        self._add(name, "", name in _BLOCK)

    def end(self, name: str) -> None:
        self._add(name, "", name in _BLOCK)
        self._end((name,), frozenset() if name in _BLOCK and name != "p" else _SCOPE, True)

    def parse(self, page: str) -> None:
        at = 0
        for found in _TOKEN.finditer(page):
            if found.start() > at:
                self._add(None, page[at : found.start()], False)
            at = found.end()
            name = found["name"]
            if name:
                self.end(name.lower()) if found["close"] else self.start(name.lower(), found["attributes"])
            elif found["raw"]:
                # nothing inside is text; it still parts blocks like any element of its kind
                self._add(found["raw"].lower(), "", True)
                self.pieces[-1].hole = True
        if at < len(page):
            self._add(None, page[at:], False)
        self._leave(0, False)


def parsed(page: str) -> _Parser:
    parser = _Parser()
    parser.parse(page)
    if parser.unclosed:
        parser = _Parser(frozenset(parser.unclosed), parser.saw_main)
        parser.parse(page)
    return parser


def _word(place: str, linked: bool) -> str:
    return f"word {place}{' linked' if linked else ''}"


def _tag(name: str) -> str:
    return f"tag {name if name in _BLOCK else 'other'}"


def label_counts(page: str) -> dict[str, list[int]]:
    """Occurrences inside and outside the article by kind of token; nothing unless there is just one article.

    Words are counted in holes too, tags only outside them.
    """
    page_parser = parsed(page)
    found: dict[str, list[int]] = {}
    kind = next((k for k in _KINDS if page_parser.count[k]), "main")
    if page_parser.count[kind] != 1:
        return found
    for piece in page_parser.pieces:
        inside = getattr(piece, kind) > 0 and not piece.hole
        if piece.tag is not None:
            kinds, n = [] if piece.hole else [_tag(piece.tag)], 1
            if inside:
                kinds.append("tag inside")
        else:
            kinds, n = [_word(ALONE, piece.linked)], len(piece.text.split())
            if not piece.hole:
                kinds.append(_word(INSIDE if inside else BESIDE, piece.linked))
        for what in kinds:
            found.setdefault(what, [0, 0])[0 if inside else 1] += n
    return found


class Weights:
    """Scores by kind of token, from counts inside and outside of articles.

    With p the share inside (one occurrence of each kind is added, so an unseen kind has
    one half), a word scores 2 p - 1 but never below zero; a tag costs between
    ``TAG_FLOOR`` and ``TAG_FLOOR + TAG_SPAN``, by its name unless it is inside an article. An unseen kind of word scores as if inside, but
    for linked words and words beside an article, which score nothing.
    """

    def __init__(self, counts: dict[str, tuple[int, int]]) -> None:
        def share(kind: str, unseen: float) -> float:
            inside, outside = counts.get(kind, (0, 0))
            return (inside + 1) / (inside + outside + 2) if inside + outside else unseen

        self.words = {
            (place, linked): max(0.0, 2 * share(_word(place, linked), 0.0 if linked and place != INSIDE or place == BESIDE else 1.0) - 1)
            for place in (INSIDE, BESIDE, ALONE)
            for linked in (False, True)
        }
        self.tags = {kind: self._cost(share(kind, 0.5)) for kind in counts if kind.startswith("tag ")}
        self.inside = self._cost(share("tag inside", 1.0))

    @staticmethod
    def _cost(share: float) -> float:
        return -(TAG_FLOOR + TAG_SPAN * (1 - share))

    def tag(self, name: str, inside: bool) -> float:
        return self.inside if inside else self.tags.get(_tag(name), self._cost(0.5))


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the first contiguous run with the greatest positive sum."""
    best, total, start, region = 0.0, 0.0, 0, (0, 0)
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, region = total, (start, at + 1)
    return region


def main_text(page: str, weights: Weights) -> str:
    """The text of the best region: blocks in page order, white space as Python splits it."""
    pieces = parsed(page).pieces
    words = {kind: Counter() for kind in _KINDS}
    for piece in pieces:
        if piece.tag is None and not piece.hole:
            n = len(piece.text.split())
            for kind in _KINDS:
                number = getattr(piece, kind)
                if number:
                    words[kind][number] += n
    # of several articles the longest counts; a main element with short articles in it is about none of them
    longest = {kind: max(found.items(), key=lambda f: (f[1], -f[0]), default=(0, 0)) for kind, found in words.items()}
    most = max(n for _, n in longest.values())
    around = next(kind for kind in _KINDS if 2 * longest[kind][1] >= most)
    number = longest[around][0]
    kept, scores, breaks = [], [], []
    between = False
    for piece in pieces:
        between |= piece.breaks
        if piece.hole:
            continue
        inside = most > 0 and getattr(piece, around) == number
        if piece.tag is not None:
            score = weights.tag(piece.tag, inside)
        else:
            place = INSIDE if inside else BESIDE if most else ALONE
            score = weights.words[place, piece.linked] * len(piece.text.split())
        kept.append(piece)
        scores.append(score)
        breaks.append(between)
        between = False
    start, end = best_region(scores)
    out = []
    for piece, before in zip(kept[start:end], breaks[start:end], strict=True):
        if before:
            out.append(" ")
        out.append(entities.unescape(piece.text))
    return " ".join("".join(out).split())


def learn_weights(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from a sample of the pages; those without exactly one article say nothing.

    Tasks count by kind, of which there are a fixed number; no page reaches the driver.
    """
    total = pages.count()
    part = max(1, total // sample)
    picked = pages.where(F.pmod(F.xxhash64(key), F.lit(part)) == 0).select(F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in pc.fill_null(batch.column("html"), "").to_pylist():
                for kind, (a, b) in label_counts(page).items():
                    inside[kind] += a
                    outside[kind] += b
        kinds = sorted(inside)
        yield pa.RecordBatch.from_pydict(
            {"kind": pa.array(kinds, pa.string()), "inside": pa.array([inside[k] for k in kinds], pa.int64()),
             "outside": pa.array([outside[k] for k in kinds], pa.int64())}
        )

    rows = picked.mapInArrow(run, "kind string, inside long, outside long").groupBy("kind")
    found = rows.agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return Weights({r["kind"]: (r["inside"], r["outside"]) for r in found})


def extract(pages: DataFrame, weights: Weights, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row for each page: its key, its address, ``text`` and ``n_chars``, the code points of the text."""
    source = pages.select(F.col(key).alias("key"), F.col(url).alias("address"), F.col(html).alias("html"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("key", "address")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(p, weights) for p in pc.fill_null(part.column("html"), "").to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("address"), pa.array(texts, pa.string()), sizes],
                    names=["key", "address", "text", "n_chars"],
                )

    out = source.mapInArrow(run, f"key {kinds[0]}, address {kinds[1]}, text string, n_chars long")
    return out.withColumnsRenamed({"key": key, "address": url})
