"""Main text of web pages by a maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. Words score above zero, tags below, with weights
learned from pages that mark their article; words inside furniture (menus, adverts,
forms, ...) are never shown and score zero. One linear scan finds the contiguous run of
tokens with the largest sum; its blocks, without furniture, are the text.

Names of elements and classes say what furniture is, but not alone: an element that
would hide the page's article, or most of a page without one, is read as a wrapper. A
class that only contains such a name, like has-sidebar, is weaker than one that is one.
An article among reader comments is a comment.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.text import slices

# What element names mean, by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead tr ul".split())
ARTICLES = frozenset(("article", "main"))
# Elements that never hold main text, and words in a class, id or role that say so.
FURNITURE = frozenset(
    "aside button canvas datalist dialog footer form head iframe input label menu nav noframes "
    "noscript object script search select style svg template textarea title".split())
FURNITURE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising alert banner "
    "breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies "
    "dialog disclaimer discussion disqus footer gdpr login masthead menu modal nav navbar "
    "navigation navigations newsletter notice notices notification pager pagination paywall popup "
    "promo promoted promotion reactions recommendations recommended related replies respond "
    "search share sharing sidebar sidebars sidenav signup skip social sponsor sponsored "
    "sponsors subscribe subscription teaser toolbar topbar widget widgets".split())
HEADERS = frozenset(("header", "banner", "masthead"))  # furniture outside an article only
COMMENTS = frozenset("comment comments discussion disqus reactions replies respond".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.DOTALL)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
                    re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Used where no page marks an article: tags of running text cost little.
DEFAULT_WEIGHTS = {"word": 1.0, "furniture": -0.5, "tag": -2.0} | dict.fromkeys(
    "a abbr b blockquote br code em figcaption figure h1 h2 h3 h4 h5 h6 i img li ol p pre q "
    "script small span strong style sub sup table tbody td th tr u ul".split(), -0.2)


# How surely an element is furniture: as one of reader comments, by a whole class name or
# what it is, by its name though others use it as a wrapper, by a part of a class name, or
# not at all.
REPLIES, SURE, NAMED, PART, PLAIN = 4, 3, 2, 1, 0
WRAPPERS = frozenset(("form", "header", "nav"))


def _strength(name: str, attributes: str, in_article: bool) -> int:
    if name in FURNITURE or (name == "header" and not in_article):
        own = NAMED if name in WRAPPERS else SURE
    else:
        own = PLAIN
    if not attributes or name in ("html", "body"):
        return own
    words = FURNITURE_WORDS - HEADERS if in_article else FURNITURE_WORDS | HEADERS
    for key, value in _NAMED.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true":
            own = max(own, SURE)
        if key[0] == "a":
            continue
        if whole := words & set(value.lower().split()):
            own = max(own, REPLIES if whole & COMMENTS else SURE)
        elif words & set(_SPLIT.split(_CAMEL.sub(" ", value).lower())):
            own = max(own, PART)
    return own


@dataclass
class Page:
    """What a page consists of, in order: scored tokens, and blocks of text.

    tokens: (kind, block), the kind being "word", "furniture" or a tag's name;
    blocks: texts of the blocks that are no furniture, "" where nothing is shown;
    articles: (first token, last token) of the outermost elements that mark an article;
    hidden: (number, words, strength of the surest around) of elements that mark one
    inside furniture, and wrappers: (number, words) of furniture that may be none, each
    with its number among all elements.
    """

    tokens: list[tuple[str, int]] = field(default_factory=list)
    blocks: list[str] = field(default_factory=list)
    articles: list[tuple[int, int]] = field(default_factory=list)
    hidden: list[tuple[int, int, int]] = field(default_factory=list)
    wrappers: list[tuple[int, int]] = field(default_factory=list)
    words: int = 0  # all that could be shown were nothing furniture


def read_page(source: str) -> Page:
    """The page, read again if its furniture hides what it should show: the article in a
    weakly named element if that is longer than those in sight; in any other, where no
    article is in sight, if it is longer than all that is; in a page that marks none whatever
    holds most of its words; and one among reader comments if all else shows nothing."""
    page = parse(source)
    seen = sum(kind == "word" for a, b in page.articles for kind, _ in page.tokens[a:b])
    sight = sum(kind == "word" for kind, _ in page.tokens)
    least = {PART: seen} if seen else {PART: 0, NAMED: sight, SURE: sight}
    found = _longest(x for x in page.hidden if x[2] in least and x[1] > least[x[2]])
    if found:
        return parse(source, found)
    most = frozenset(n for n, words in page.wrappers if 2 * words > page.words)
    if not page.articles and most:
        return parse(source, frozenset(), most)
    if not sight and page.hidden:
        return parse(source, _longest(page.hidden))
    return page


def _longest(hidden: Iterable[tuple[int, int, int]]) -> frozenset:
    """The number of the one with most words, the first of equal ones; none of none."""
    longest = max(hidden, key=lambda x: (x[1], -x[0]), default=None)
    return frozenset() if longest is None else frozenset((longest[0],))


def parse(source: str, shown: frozenset = frozenset(), plain: frozenset = frozenset()) -> Page:
    """``shown`` are numbers of articles that count whatever is around them, ``plain`` those
    of elements that are not furniture."""
    page, parts = Page(), []
    # open elements: name, strength, number, words before, furniture around a shown article
    stack: list[tuple[str, int, int, int, int | None]] = []
    opened: Counter = Counter()
    furniture = marked = number = began = 0
    open_strengths = [0] * (REPLIES + 1)

    def flush():
        page.blocks.append(" ".join(html.unescape("".join(parts)).split()))
        parts.clear()

    def text(piece: str):
        if not piece:
            return
        kind = "furniture" if furniture else "word"
        n = len(piece.split())
        page.words += n
        page.tokens.extend([(kind, len(page.blocks))] * n)
        if not furniture:
            parts.append(piece)

    def close(n: int):
        nonlocal furniture, marked
        while len(stack) > n:
            name, strength, own, before, around = stack.pop()
            opened[name] -= 1
            furniture -= strength > 0
            open_strengths[strength] -= 1
            if strength:
                if strength < SURE:
                    page.wrappers.append((own, page.words - before))
            elif name in ARTICLES:
                marked -= 1
                if marked == 0 and not furniture:
                    page.articles.append((began, len(page.tokens)))
                elif marked == 0:
                    surest = max(s for s in range(REPLIES + 1) if open_strengths[s])
                    page.hidden.append((own, page.words - before, surest))
            if around is not None:
                furniture = around

    at = 0
    while True:
        found = _TOKEN.search(source, at)
        text(source[at:found.start() if found else len(source)])
        if not found:
            break
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if name in BLOCKS:
            flush()
        elif name == "br":
            parts.append(" ")
        page.tokens.append((name, len(page.blocks)))
        if found[1]:
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if name in VOID:
            continue
        if name in BLOCKS and stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if name in RAW:
            end = re.compile(f"</{name}[^>]*(?:>|\\Z)", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
            continue
        number += 1
        strength = PLAIN if number in plain else _strength(name, found[3], marked > 0)
        if name in ARTICLES and strength == PART:
            strength = PLAIN
        around = None
        if number in shown:
            around, furniture, strength = furniture, 0, PLAIN
        if name in ARTICLES and not strength:
            if marked == 0:
                began = len(page.tokens)
            marked += 1
        stack.append((name, strength, number, page.words, around))
        opened[name] += 1
        furniture += strength > 0
        open_strengths[strength] += 1
    flush()
    close(0)
    return page


def best_run(scores: list[float]) -> tuple[int, int]:
    """The run [begin, end) with the largest sum, the first of equal ones; empty where
    no score is above zero."""
    best, where, total, begin = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        total += score
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, where = total, (begin, i + 1)
    return where


def main_text(source: str, weights: dict[str, float]) -> str:
    """The blocks that the best run touches, joined by two line feeds. Words inside furniture
    score zero, so a run goes on behind a box in an article."""
    page = read_page(source)
    weights, other = {**weights, "furniture": 0.0}, weights["tag"]
    begin, end = best_run([weights.get(kind, other) for kind, _ in page.tokens])
    if begin == end:
        return ""
    first, last = page.tokens[begin][1], page.tokens[end - 1][1]
    return "\n\n".join(b for b in page.blocks[first:last + 1] if b)


def _counts(source: str) -> Counter:
    """(kind, inside) counts of a page that marks one article with words; else nothing."""
    page = read_page(source)
    if len(page.articles) != 1:
        return Counter()
    a, b = page.articles[0]
    known = BLOCKS | VOID | RAW | {"word", "furniture"}
    counts = Counter(
        (kind if kind in known else "tag", a <= i < b) for i, (kind, _) in enumerate(page.tokens))
    return counts if counts["word", True] else Counter()


def learn_weights(pages: DataFrame, html_column: str = "html") -> dict[str, float]:
    """Weights from the pages that mark one article: log-odds of a token's kind inside
    and outside, with one count added, held above zero for words and below for tags.

    All such pages count; Spark sums per kind, of which there are fewer than 200.
    Without such a page fixed weights are used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            total: Counter = Counter()
            for source in part.column(0).to_pylist():
                total.update(_counts(source or ""))
            rows = [(kind, inside, n) for (kind, inside), n in total.items()]
            kind, inside, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.string()), pa.array(inside, pa.bool_()),
                 pa.array(n, pa.int64())], ["kind", "inside", "n"])

    counted = pages.select(F.col(html_column).alias("html")).mapInArrow(
        run, "kind string, inside boolean, n bigint")
    rows = counted.groupBy("kind").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("b")).collect()
    if not rows:
        return dict(DEFAULT_WEIGHTS)
    inside, outside = sum(r["a"] for r in rows), sum(r["b"] for r in rows)
    weights = {}
    for r in rows:
        odds = log((r["a"] + 1) / (inside + 2)) - log((r["b"] + 1) / (outside + 2))
        weights[r["kind"]] = max(odds, 0.1) if r["kind"] == "word" else min(odds, -0.1)
    return {"furniture": -1.0, "tag": min(weights.values()), **weights}


def extract(pages: DataFrame, weights: dict[str, float], page_id: str = "page_id",
            url: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text) per row of ``pages``. A null page, and one without words
    outside furniture, has the empty text. White space inside a block becomes one
    space; a line break counts as white space. Nothing is shuffled. A page of any length is
    read whole, in time in proportion to it. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(x or "", weights) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                          F.col(html_column).alias("html"))
    return source.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
