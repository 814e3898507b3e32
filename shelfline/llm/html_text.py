"""Main text of web pages: flat text blocks classified by a decision tree.

A page is split at block-level tags into flat blocks. A block is described by its words and link density, those of its
neighbours (the ``REACH`` blocks on either side), and where it stands (inside an article, below an element whose tag or class
names furniture, heading, list). So a short line between long ones stays, and one of the same length among links goes.
A form or an element with a furniture name does not count as furniture if it wraps the page's main part (see ``_wraps``),
and the names of html, body, main and article do not count. A decision tree, trained here on the small labelled pages below, keeps or drops each block.

Defined cases: null and empty html give an empty text; so does a page without a kept block; unclosed elements end with
the nearest enclosing end tag (an unclosed svg where the next block begins), unclosed comments and scripts at the end of the
page; very long pages are read whole, in one pass; repeated rows get equal answers; null ids and addresses are carried; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kind, slices

# Element names by role, and the words in class or id that name page furniture.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
FURNITURE_TAGS = frozenset("nav header footer aside menu button select dialog fieldset".split())
#: Elements whose text is not shown; they may hold others.
HIDDEN_TAGS = frozenset(["svg", "noscript", "template", "math"])
FOREIGN_TAGS = frozenset(["svg", "math"])
CONTENT_TAGS = frozenset(["article", "main"])
#: Their names tell about the page or the article as a whole, not about a part of it.
UNNAMED_TAGS = frozenset(["html", "body", "main", "article"])
#: Furniture that may hold articles of its own, or more words than the main part.
READER_WORDS = frozenset("comment comments reply replies discussion disqus related".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer copyright sidebar aside related widget comment comments reply replies discussion disqus notice notices cookie cookies "
    "consent gdpr alert popup modal overlay newsletter subscribe signup login form share social toolbar pagination pager".split()
)
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?P<raw>script|style|title|iframe|textarea|noembed|noframes|xmp)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)
      | <(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | <(?P<end2>/?)(?P<tag2>[a-z][a-z0-9:-]*+)(?P<rest2>[^>]*+)>
      | <[!?/][^>]*+>""",
    re.S | re.I | re.X,
)
OPEN = re.compile(r"<(?:!--|[a-z])", re.I)
CLOSED = re.compile(r"-->\Z|</[a-z]++\s*+>\Z", re.I)
NAMED = re.compile(r"""\b(?:class|id|role|data-keep)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
WORD = re.compile(r"[A-Za-z][a-z]*|[0-9]+")
KEEP_MARK = "data-keep"


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    content: bool
    furniture: bool
    heading: bool
    listed: bool
    marked: bool


class Box:
    """A form or an element with a furniture name: its blocks, and the articles (or mains) opened before, around and up to its end."""

    def __init__(self, start: int, reader: bool, before: int, around: int):
        self.start, self.reader, self.before, self.around = start, reader, before, around
        self.stop = self.until = 0

    def end(self, stop: int, until: int) -> None:
        self.stop, self.until = stop, until


def _wraps(box: Box, words: int, all_words: int, articles: int) -> bool:
    """Whether a box holds the main part of its page.

    It does if the first article lies in it, or most words do and no article stands beside it. A box for readers' comments
    or related texts must hold nine tenths of the words instead.
    """
    if box.reader:
        return 10 * words >= 9 * all_words
    if box.before == 0 and box.until > 0:
        return True
    return 2 * words > all_words and box.before == box.around and box.until == articles


def blocks(html: str) -> list[Block]:
    """The flat text blocks of a page in order."""
    found: list[Block] = []
    stack: list[tuple[str, bool, bool, Box | None]] = []
    boxes: list[Box] = []
    articles = 0
    pieces: list[str] = []
    depth = {"a": 0, "content": 0, "furniture": 0, "heading": 0, "li": 0, "marked": 0, "hidden": 0}
    open_names: Counter[str] = Counter()
    linked = 0

    def change(tag: str, furniture: bool, marked: bool, by: int) -> None:
        depth["a"] += by * (tag == "a")
        depth["content"] += by * (tag in CONTENT_TAGS)
        depth["furniture"] += by * furniture
        depth["heading"] += by * (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())
        depth["li"] += by * (tag in ("li", "dt", "dd", "td", "th", "option"))
        depth["marked"] += by * marked
        depth["hidden"] += by * (tag in HIDDEN_TAGS)
        open_names[tag] += by

    def leave() -> str:
        name, furniture, marked, box = stack.pop()
        change(name, furniture, marked, -1)
        if box:
            box.end(len(found), articles)
        return name

    def close() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                found.append(Block(text, text.count(" ") + 1, linked, depth["content"] > 0, depth["furniture"] > 0, depth["heading"] > 0, depth["li"] > 0, depth["marked"] > 0))
            pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if depth["hidden"]:
            return
        pieces.append(text)
        if depth["a"]:
            linked += len(text.split())

    # Behind the last ">" no tag can end; looking for one from each "<" there would take quadratic time.
    end = html.rfind(">") + 1
    html, tail = html[:end], html[end:].split("<!--")[0]
    at = 0
    for token in TOKEN.finditer(html):
        if token.start() > at:
            add(html[at : token.start()])
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            if at == end and OPEN.match(token[0]) and not CLOSED.search(token[0]):
                tail = ""  # an unclosed comment or script takes the rest
            continue
        ends = token["end"] or token["end2"]
        if tag in BLOCK_TAGS:
            while not ends and depth["hidden"] and (open_names["svg"] or open_names["math"]):  # a block is no part of a drawing
                leave()
            close()
        if tag in VOID_TAGS:
            continue
        if ends:
            if open_names[tag] > 0:
                while leave() != tag:
                    pass
            continue
        rest = token["rest"] or token["rest2"] or ""
        if rest.endswith("/") and (tag in FOREIGN_TAGS or open_names["svg"] or open_names["math"]):
            continue
        if tag in ("p", "li") and stack and stack[-1][0] == tag:  # an unclosed paragraph or item ends where the next begins
            leave()
        furniture, box = tag in FURNITURE_TAGS, None
        if not furniture and tag not in UNNAMED_TAGS:
            names = " ".join(a or b or c for a, b, c in NAMED.findall(rest)) if "=" in rest else ""
            named = FURNITURE_WORDS.intersection(word.lower() for word in WORD.findall(names))
            if named or tag == "form":
                box = Box(len(found), not named.isdisjoint(READER_WORDS), articles, depth["content"])
                boxes.append(box)
        marked = KEEP_MARK in rest
        articles += tag in CONTENT_TAGS
        stack.append((tag, furniture, marked, box))
        change(tag, furniture, marked, 1)
    add(html[at:] + tail)
    close()
    while stack:
        leave()
    total = [0]
    for block in found:
        total.append(total[-1] + block.words)
    inside = [0] * (len(found) + 1)
    for box in boxes:
        if not _wraps(box, total[box.stop] - total[box.start], total[-1], articles):
            inside[box.start] += 1
            inside[box.stop] -= 1
    open_boxes = 0
    for i, block in enumerate(found):
        open_boxes += inside[i]
        if open_boxes and not block.furniture:
            found[i] = block._replace(furniture=True)
    return found


#: Blocks on either side that count as neighbours.
REACH = 3
FEATURES = ("furniture", "in an article", "words", "link density", "words before", "link density before", "words after", "link density after", "heading", "listed")


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """One row of ``FEATURES`` per block; furniture and the ends of the page are empty neighbours."""
    words = [0, *accumulate(0 if b.furniture else b.words for b in found)]
    linked = [0, *accumulate(0 if b.furniture else b.linked for b in found)]

    def side(start: int, stop: int) -> tuple[float, float]:
        start, stop = max(0, start), min(len(found), stop)
        n = words[stop] - words[start]
        return float(n), min(1.0, (linked[stop] - linked[start]) / n) if n else 0.0

    return [
        (float(b.furniture), float(b.content), float(b.words), min(1.0, b.linked / b.words), *side(i - REACH, i), *side(i + 1, i + 1 + REACH), float(b.heading), float(b.listed))
        for i, b in enumerate(found)
    ]


class Node(NamedTuple):
    """Go left when the feature is at most the threshold; a leaf has only the answer."""

    feature: int
    threshold: float
    left: Node | None
    right: Node | None
    keep: bool


def _impurity(positive: int, total: int) -> float:
    return 2.0 * positive * (total - positive) / total if total else 0.0


def grow(rows: list[tuple[float, ...]], labels: list[bool], depth: int = 10) -> Node:
    """A binary tree by Gini impurity; of equal splits the first feature and the lowest threshold win."""
    positive, total = sum(labels), len(labels)
    leaf = Node(-1, 0.0, None, None, 2 * positive > total)
    if depth == 0 or positive in (0, total):
        return leaf
    best = (_impurity(positive, total) - 1e-9, -1, 0.0)
    for feature in range(len(FEATURES)):
        order = sorted(range(total), key=lambda i: rows[i][feature])
        seen = 0
        for k, i in enumerate(order[:-1], 1):
            seen += labels[i]
            low, high = rows[i][feature], rows[order[k]][feature]
            if low < high:
                score = _impurity(seen, k) + _impurity(positive - seen, total - k)
                if score < best[0] - 1e-12:
                    best = (score, feature, (low + high) / 2)
    _, feature, threshold = best
    if feature < 0:
        return leaf
    side = [row[feature] <= threshold for row in rows]
    parts = [([r for r, s in zip(rows, side, strict=True) if s is way], [x for x, s in zip(labels, side, strict=True) if s is way]) for way in (True, False)]
    return Node(feature, threshold, grow(*parts[0], depth - 1), grow(*parts[1], depth - 1), leaf.keep)


def decide(tree: Node, row: tuple[float, ...]) -> bool:
    while tree.left is not None:
        tree = tree.left if row[tree.feature] <= tree.threshold else tree.right
    return tree.keep


_LONG = "The river rose again over night and the people of the lower town carried what they could to the hill. " * 2
_MIDDLE = "Nobody had expected the bridge to hold for as long as it did that winter."
_LINKS = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("Home", "World news", "Local", "Sport", "Contact us"))
_TAIL = '<footer>&copy; 2020 The Paper. All rights reserved by the owners and their partners.</footer>'
_TEASER = "Eleven words tell what the story behind the link is about."
_TEASERS = "".join(f'<div><a href="/{x}">The story of the {x} and all that came of it</a></div><div>{_TEASER}</div>' for x in ("mill", "ferry", "well"))
_K = KEEP_MARK

#: The labelled table: small pages whose main blocks carry the mark.
LABELLED = [
    f'<nav><ul>{_LINKS}</ul></nav><div class="ad">{_MIDDLE}</div><article {_K}><h1>High water</h1><p>{_LONG}<p>{_MIDDLE}</p><p>Then rain.</p></article>{_TAIL}',
    f'<header><a href="/">The Paper</a><p>News since 1900</p></header><main><div {_K}><h1>A long winter</h1><p>{_MIDDLE}</p><p>{_LONG}</p></div><aside><h3>Related</h3><ul>{_LINKS}</ul><p>{_MIDDLE}</p></aside></main>{_TAIL}',
    f'<div id="menu">{_LINKS}</div><div {_K}><h2>Notes</h2><p>{_LONG}</p><p>{_MIDDLE} <a href="/x">More here</a></p><ul><li>{_MIDDLE}</li><li>Bread, salt and water for two days.</li></ul></div><div class="comments"><p>{_LONG}</p><p>Great story, thanks!</p></div><div class="copyright">{_MIDDLE}</div>',
    f'<div class="cookie-notice">{_LONG}<button>Accept</button></div><article {_K}><p>Short.</p><p>It rained.</p><p>{_MIDDLE}</p><blockquote>{_LONG}</blockquote></article><form><p>{_MIDDLE}</p><label>Your mail</label></form>',
    f'<table><tr><td><a href="/a">Archive</a></td><td><a href="/b">About</a></td></tr></table><div {_K}><p>{_LONG}</p><p>{_LONG}</p><p>{_MIDDLE}</p></div><div><a href="/p">Previous page</a> <a href="/n">Next page</a></div><p>Back to top</p>',
    f'<article {_K}><h1>Soup</h1><p>Boil the water.</p><ul><li>One onion</li><li>Two carrots from <a href="/m">the market</a></li></ul><p>{_LONG}</p></article><section id="comments"><article><p>{_MIDDLE}</p></article></section><div class="sidebar"><p>{_LONG}</p></div>{_TAIL}',
    f'<div class="banner-ad"><p>{_LONG}</p></div><article><div {_K}><h1>Walks</h1><p>{_MIDDLE}</p></div><div class="share">Share this page with all your friends today</div><p {_K}>{_LONG}</p><div class="ad-slot">{_MIDDLE}</div><p {_K}>Done.</p></article>',
    f'<article {_K}><h1>Seed</h1><p>{_LONG}</p><p>{_MIDDLE}</p></article>',
    f'<article {_K}><h2>Ice</h2><p>Cold.</p><p>Six words are in this one.</p></article>',
    f'<div><a href="/t">Top of the page</a></div><main {_K}><p>{_MIDDLE}</p><p>{_LONG}</p><p>It was over by noon.</p></main>',
    f'<p {_K}>{_LONG}</p><p {_K}>{_MIDDLE}</p>',
    f'<div>Menu</div><div><a href="/f">Read our latest story about the flood right now</a></div><article {_K}><h1>{_MIDDLE}</h1><p>{_MIDDLE}</p><p><a href="/s">A source for all of this</a></p><p>{_LONG}</p></article><div>Print</div>',
    f'<div>Skip to content</div><div {_K}><p>{_LONG}</p><p>{_MIDDLE}</p></div><div>Back to top</div><div class="footer">{_MIDDLE}</div>',
    f'<article {_K}><p><a href="/q">Read the first part of it</a></p><p>{_LONG}</p><p>Go.</p></article><ul>{_LINKS}</ul>',
    f'<html class="has-nav"><body class="has-sidebar"><div id="page-header-fixed"><nav><ul>{_LINKS}</ul></nav><article class="post share-enabled" {_K}><h1>Ebb</h1><p>{_LONG}</p><p>{_MIDDLE}</p></article><div class="sidebar"><p>{_LONG}</p></div></div>{_TAIL}</body></html>',
    f'<form action="/"><div class="header">{_MIDDLE}</div><div {_K}><h2>Salt</h2><p>{_LONG}</p><p>{_LONG}</p><p>{_MIDDLE}</p></div><div id="comments"><p>{_LONG}</p></div></form>',
    f'<ul>{_LINKS}</ul><p><a href="/l">Log in</a> | <a href="/r">Register now</a></p><div {_K}><p>{_LONG}</p><p>{_MIDDLE}</p></div><ul>{_LINKS}</ul>',
    f'<div>{_LINKS}</div><div>Menu</div><div {_K}><div>{_LONG}</div><div>"No," she said.</div><div>"Why?"</div><div>{_MIDDLE}</div><div>{_LONG}</div></div><div>Back to top</div><div>{_LINKS}</div>',
    f'<div>{_LINKS}</div><div {_K}><p>{_LONG}</p><table><tr><td>Cell one</td><td>12</td></tr><tr><td>Cell two</td></tr></table><p>{_LONG}</p><p>"Yes."</p><p>{_LONG}</p></div><div>Print</div>',
    f'{_TEASERS}<div {_K}><p>{_LONG}</p><p>{_TEASER}</p><p>{_LONG}</p><p>{_TEASER}</p><p>It stopped.</p><p>{_LONG}</p></div>{_TEASERS}',
    f'<div>{_TEASERS}</div><div {_K}><p>{_MIDDLE}</p><p>He nodded.</p><p>Twice.</p><p>{_MIDDLE}</p></div><div>Share</div><div>{_LINKS}</div>',
    f'<main {_K}><p>{_LONG}</p><p>12</p><p><a href="/o">Only a link</a></p><ul><li>Tea</li><li><a href="/c">Cups</a></li></ul><p>The end.</p></main><ul>{_LINKS}</ul>',
    f'<article {_K}><p><a href="/y">Part one</a></p><p>{_LONG}</p><p><a href="/z">Read on at the mill</a></p></article>',
    f'<article {_K}><p><a href="/w">Only this</a></p></article>{_TAIL}',
]


@lru_cache(maxsize=1)
def trained() -> Node:
    """The tree fitted to ``LABELLED``; the same on every machine."""
    rows, labels = [], []
    for page in LABELLED:
        found = blocks(page)
        rows += features(found)
        labels += [b.marked for b in found]
    return grow(rows, labels)


def main_text(html: str | None, tree: Node | None = None) -> str:
    """Kept blocks in page order, joined by one blank."""
    tree = tree or trained()
    found = blocks(html or "")
    return " ".join(block.text for block, row in zip(found, features(found), strict=True) if decide(tree, row))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained()
        for batch in slices(batches, "html"):
            texts = [main_text(html, tree) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(read, f"page_id {kind(rows, 'page_id')}, url {kind(rows, 'url')}, text string, n_chars bigint")
