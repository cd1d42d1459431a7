"""Operator 3, main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks. A block is described by its words and link density, those of the blocks before
and after it, and by two weak signs of its place: does it stand in an article, and does markup around it name boilerplate
(2 for elements and class names of menus, footers, adverts, comments and the like; 1 for class names that only mention one,
such as ``has-sidebar``). A decision tree, trained here on the small labelled table below, says which blocks are main text.
Where markup names no place, words and links alone decide.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barpath.llm.common import batches, small_batches, table

# Tags by what they do, and words of class, id and role that name boilerplate.
RAW = "script style title textarea template noscript iframe svg select button object canvas math"
VOID = "area base br col embed hr img input link meta param source track wbr"
INLINE = "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var"
BOILERPLATE = "nav header footer aside form dialog menu"
CONTENT = "article main"
HINTS = (
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus "
    "dropdown footer header hidden login masthead menu menubar modal nav navbar navigation navigator newsletter notice notices overlay pager pagination "
    "popup privacy promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skyscraper social sponsor sponsored "
    "subscribe subscription tags toolbar topbar widget widgets contentinfo complementary"
)
#: Parts of a class name after which a hint names what the element has or is about, not what it is.
MODIFIERS = "has with without no not is category tag type format topic about layout"
_RAW, _VOID, _INLINE = frozenset(RAW.split()), frozenset(VOID.split()), frozenset(INLINE.split())
_BOILERPLATE, _CONTENT, _HINTS = frozenset(BOILERPLATE.split()), frozenset(CONTENT.split()), frozenset(HINTS.split())
_MODIFIERS = frozenset(MODIFIERS.split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'">]++|"[^"]*+"|'[^']*+')*+[^>]*+)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
_HIDDEN = re.compile(r"display\s*:\s*none")
_END = {t: re.compile(rf"</{t}\b[^>]*+>?", re.I) for t in _RAW}

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_content", "mark")

#: The labelled table: pages as rows of blocks "place words linked_words label"; place a: in an article, b and h: inside marks of
#: 2 and 1, n: none of these.
LABELLED = (
    "b 6 6 0 | b 9 0 0 | a 10 0 1 | a 34 0 1 | a 60 2 1 | a 41 0 1 | b 12 1 0",
    "b 1 1 0 | b 1 1 0 | b 2 2 0 | b 14 0 0 | a 1 0 1 | a 2 0 1 | a 120 0 1 | b 20 0 0",
    "n 2 2 0 | n 3 3 0 | n 2 2 0 | n 7 0 1 | n 45 1 1 | n 52 0 1 | n 8 0 1 | n 38 4 1 | n 4 4 0 | n 5 5 0",
    "b 40 0 0 | a 6 0 1 | a 15 15 1 | a 3 0 1 | a 22 1 1 | b 33 0 0 | b 51 2 0 | b 17 0 0 | b 70 1 0",
    "n 1 1 0 | n 4 0 0 | n 5 5 0 | n 30 0 1 | n 26 0 1 | n 90 3 1 | n 11 0 1 | n 64 0 1 | n 3 3 0 | n 6 0 0 | n 2 2 0",
    "b 25 25 0 | a 5 0 1 | a 18 0 1 | b 10 0 0 | a 44 0 1 | a 9 9 1 | a 71 0 1 | b 8 0 0 | b 30 0 0",
    "n 12 12 0 | n 25 24 0 | n 10 10 0 | n 9 0 1 | n 80 2 1 | n 2 0 1 | n 47 0 1 | n 19 19 0 | n 16 15 0",
    "a 4 0 1 | a 1 0 1 | a 7 0 1 | b 5 0 0",
    "n 3 0 0 | n 2 2 0 | n 21 0 1 | n 17 0 1 | n 33 0 1 | n 2 2 0 | n 1 1 0 | n 3 0 0",
    "b 200 0 0 | b 3 0 0 | a 2 0 1 | a 300 9 1 | a 1 1 1 | b 90 0 0 | b 2 0 0",
    # a list of links inside an article is a menu of it
    "a 12 0 1 | a 40 0 1 | a 2 2 0 | a 3 3 0 | a 1 1 0 | a 4 4 0 | a 2 2 0 | a 55 1 1 | a 30 0 1",
    "a 9 0 1 | a 3 3 0 | a 5 5 0 | a 2 2 0 | a 6 6 0 | a 3 3 0 | a 8 0 1 | a 77 0 1 | a 1 0 1",
    "a 14 0 1 | a 1 1 0 | a 1 1 0 | a 1 1 0 | a 1 1 0",
    "b 3 3 0 | a 5 0 1 | a 66 0 1 | a 2 2 0 | a 3 3 0 | a 7 7 0 | b 12 0 0",
    "a 90 2 1 | a 4 4 0 | a 12 12 0 | a 2 2 0 | b 8 0 0",
    # short blocks and linked sentences of articles, between text; short ones of pages that name no place
    "b 3 3 0 | a 6 0 1 | a 6 0 1 | a 5 0 1 | a 120 0 1 | a 6 0 1 | a 3 0 1 | a 80 0 1 | a 7 0 1 | a 1 0 1 | b 6 0 0",
    "b 4 0 0 | a 8 0 1 | a 50 0 1 | a 14 14 1 | a 33 0 1 | a 2 0 1 | a 4 0 1 | a 6 0 1 | a 20 20 1 | a 9 0 1 | b 40 0 0",
    "b 2 2 0 | a 7 7 1 | a 64 1 1 | a 10 10 1 | a 28 0 1 | a 5 0 1 | a 1 0 1 | a 11 0 1 | b 1 1 0",
    "n 4 0 0 | n 2 0 0 | n 12 0 1 | n 70 0 1 | n 40 0 1 | n 6 0 0 | n 5 0 0 | n 4 0 0 | n 3 0 0",
    "n 2 2 0 | n 3 0 0 | n 1 0 0 | n 55 2 1 | n 31 0 1 | n 5 0 0 | n 20 20 0 | n 18 18 0 | n 6 0 0",
    # class names that only mention boilerplate: what stands in them reads like text, or like a menu
    "h 3 3 0 | h 2 2 0 | h 8 0 1 | h 44 1 1 | h 61 0 1 | h 29 0 1 | h 4 4 0 | h 2 2 0",
    "n 2 2 0 | h 35 0 1 | h 7 0 1 | h 58 3 1 | h 5 5 0 | h 6 6 0 | h 1 1 0",
    "b 2 2 0 | h 18 0 1 | h 90 0 1 | h 25 25 0 | h 3 3 0 | b 64 0 0",
)


class Tree:
    """A decision tree over numbers, grown by Gini impurity until leaves are pure or too small or deep."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1):
        self.share = float(y.mean()) if len(y) else 0.0
        self.feature = -1
        if depth == 0 or len(y) < 2 * least or self.share in (0.0, 1.0):
            return
        best, n = 2 * self.share * (1 - self.share) * len(y) - 1e-9, np.arange(1, len(y))
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, good = x[order, f], np.cumsum(y[order])
            left = good[:-1]
            impurity = 2 * left * (1 - left / n) + 2 * (good[-1] - left) * (1 - (good[-1] - left) / (len(y) - n))
            impurity[(v[1:] == v[:-1]) | (n < least) | (len(y) - n < least)] = np.inf
            if (k := int(impurity.argmin())) >= 0 and impurity[k] < best:
                best, self.feature, self.at = impurity[k], f, (v[k] + v[k + 1]) / 2
        if self.feature >= 0:
            low = x[:, self.feature] <= self.at
            self.low, self.high = Tree(x[low], y[low], depth - 1, least), Tree(x[~low], y[~low], depth - 1, least)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.share >= 0.5)
        out, low = np.zeros(len(x), dtype=bool), x[:, self.feature] <= self.at
        out[low], out[~low] = self.low.predict(x[low]), self.high.predict(x[~low])
        return out


def described(blocks: list[tuple[int, int, bool, int]]) -> np.ndarray:
    """FEATURES of every block of a page from (words, linked words, in content, mark)."""
    b = np.array(blocks, dtype=float).reshape(-1, 4)
    words, links = b[:, 0], b[:, 1] / np.maximum(b[:, 0], 1)
    before = lambda v: np.concatenate([[0.0], v[:-1]])
    after = lambda v: np.concatenate([v[1:], [0.0]])
    return np.column_stack([words, links, before(words), before(links), after(words), after(links), b[:, 2], b[:, 3]]) if len(b) else np.zeros((0, len(FEATURES)))


def train(labelled: tuple[str, ...] = LABELLED) -> Tree:
    x, y = [], []
    for page in labelled:
        rows = [r.split() for r in page.split("|")]
        x.append(described([(int(w), int(k), place == "a", "nhb".find(place) if place != "a" else 0) for place, w, k, _ in rows]))
        y += [int(r[3]) for r in rows]
    return Tree(np.concatenate(x), np.array(y, dtype=float))


def _mark(attributes: str) -> int:
    """2 if an element's own attributes name boilerplate or hide it, 1 if they only mention it."""
    found = 0
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
            return 2
        if name in ("class", "id", "role"):
            for w in value.split():
                parts = re.split(r"[-_]+", w)
                if w in _HINTS or not _HINTS.isdisjoint(parts):
                    if _MODIFIERS.isdisjoint(parts):
                        return 2
                    found = 1
    return found


def blocks(page: str | None) -> tuple[list[str], list[tuple[int, int, bool, int]]]:
    """The flat text blocks of a page and what describes them. An article or main element inside markup that only mentions
    boilerplate stands in none. Time grows with the length of the page, however deep its elements nest."""
    page = page or ""
    texts: list[str] = []
    about: list[tuple[int, int, bool, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # open elements that hold blocks: tag, mark and content of all around
    opened: Counter[str] = Counter()
    at, link = 0, -1  # elements around the open link, or -1

    def close() -> None:
        nonlocal parts, linked
        if words := "".join(parts).split():
            _, mark, content = stack[-1] if stack else ("", 0, False)
            texts.append(" ".join(words))
            about.append((len(words), min(len(words), sum(len(t.split()) for t in linked)), content and mark < 2, mark))
        parts, linked = [], []

    def text(piece: str) -> None:
        if piece:
            piece = html.unescape(piece)
            parts.append(piece)
            if link >= 0:
                linked.append(piece)

    def pop() -> None:
        opened[stack.pop()[0]] -= 1

    while m := _TOKEN.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in _RAW:
            if not m[1] and not m[3].endswith("/"):
                end = _END[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "a":
            link = -1 if m[1] else len(stack)
        elif tag in ("br", "hr"):
            parts.append(" ")
        elif tag not in _INLINE and tag not in _VOID:
            close()
            if m[1]:
                if opened[tag]:
                    while stack[-1][0] != tag:
                        pop()
                    pop()
            else:
                if stack and stack[-1][0] == "p":  # a paragraph ends where a block begins
                    pop()
                if tag in ("li", "dt", "dd", "td", "th", "tr", "option") and stack and stack[-1][0] == tag:
                    pop()
                if not m[3].endswith("/"):
                    _, mark, content = stack[-1] if stack else ("", 0, False)
                    own = 2 if tag in _BOILERPLATE else 0 if tag in ("html", "body") else _mark(m[3])
                    if tag in _CONTENT:
                        content = True
                        mark, own = mark if mark == 2 else 0, own if own == 2 else 0
                    stack.append((tag, max(mark, own), content))
                    opened[tag] += 1
            if len(stack) < link:  # the element that holds the link has ended
                link = -1
    text(page[at:])
    close()
    return texts, about


def main_text(page: str | None, tree: Tree) -> str:
    texts, about = blocks(page)
    keep = tree.predict(described(about))
    return " ".join(t for t, k in zip(texts, keep, strict=True) if k)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """All columns but the page, ``text`` (empty if there is none) and ``n_chars`` (its code points).

    Every row is worked on by itself, whole, however long; null pages are empty; repeated rows and rows of null keys stay; an
    empty table gives an empty table. Columns of the names added are replaced. A page that breaks off in a tag, comment or
    script ends there.
    """
    small_batches(pages.sparkSession)
    keep = [f for f in pages.schema.fields if f.name not in (page, "text", "n_chars")]
    names = [f.name for f in keep]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = train()
        for batch in batches(it):
            texts = [main_text(p, tree) for p in batch.column(page).to_pylist()]
            columns = {n: batch.column(n) for n in names}
            yield pa.RecordBatch.from_pydict(columns | {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return pages.select(*names, page).mapInArrow(run, T.StructType([*keep, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


def op3_extract(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
