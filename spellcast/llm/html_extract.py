"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one per block element. Lines of menus, headers, footers, sidebars, forms,
notices, adverts, reader comments, scripts and styles weigh nothing. Text lengths are summed over a
window of ``WINDOW`` lines; a region runs from a line where the sums surge over a share of the largest
sum to the line where they dive under it, and the region with most text is where the page's main text
stands. It is widened, as short titles and last paragraphs are text too: to the articles (``article`` or
``main``) that it reaches, with those beside them under the same parent, or, where most of its text is in
no article, to all lines that are in none. Nothing else is dropped.

An element is marked by its tag, by being a form, or by a word in its class, id or role. Comments, adverts,
notices and the like are never text. An element marked as a form, sidebar or widget that holds the
page's heading (``h1``, or an article where there is none outside) is a frame around the text and
counts as unmarked if no heading stands outside marked elements; menus, headers and the like only if they
hold the page's only articles and no heading stands outside. No rule looks at how much text an element holds.

Defined cases: NULL, empty and text-free pages give an empty text; an element left open ends with its
parent or with the page; a ``<`` that starts no tag is text, and so is all after the last ``>``; a quote
that is never closed is no quote; repeated rows each get their row; other columns are ignored. A page is
read in one pass, in time proportional to its length; pages are taken one by one from Arrow batches, so
one long page is the memory bound.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: Share of the largest sum that a region's sums exceed.
SURGE = 0.2

_BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)
_RAW = frozenset("script style noscript template svg iframe textarea object".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ARTICLE = frozenset(("article", "main"))
_PARAGRAPH_ENDS = frozenset(("p", "li", "dt", "dd", "option", "tr", "td", "th"))
#: Kinds of marked elements: never text; page furniture; frames, which may stand around the text.
NEVER, FURNITURE, FRAME = 1, 2, 3
_TAG_KINDS = dict.fromkeys("nav header footer aside head title button menu select dialog".split(), FURNITURE) | {"form": FRAME}
_WORD_KINDS = (
    dict.fromkeys(
        "ad ads adbox adsbox adslot adunit adbanner adspace advert adverts advertisement advertisements advertising comment comments "
        "commentlist commentbox commentform commentarea commentsection cookie cookies cookiebar cookienotice disqus newsletter notice notices "
        "popup promo promos related share sharing social sponsor sponsored sponsors subscribe subscription signup".split(),
        NEVER,
    )
    | dict.fromkeys(
        "banner breadcrumb breadcrumbs footer header menu mainmenu submenu nav navbar navigation topnav sidenav mainnav subnav "
        "pagefooter pageheader siteheader sitefooter".split(),
        FURNITURE,
    )
    | dict.fromkeys("sidebar leftsidebar rightsidebar sidebars login widget widgets".split(), FRAME)
)
_WITHOUT = frozenset(("no", "with", "without", "has"))
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_STOPS = re.compile("[\"'>]")


def _kind(tag: str, attributes: str, in_article: bool) -> int:
    """How an element is marked, 0 if it isn't."""
    if tag in _TAG_KINDS:
        # An article may have a header of its own with its title.
        return 0 if tag == "header" and in_article else _TAG_KINDS[tag]
    if not attributes or tag in ("html", "body") or tag in _ARTICLE:
        return 0
    found = 0
    for values in _ATTRIBUTE.findall(attributes):
        for name in "".join(values).split():
            words = [name.lower(), *(w.lower() for w in _WORDS.findall(name))]
            for before, word in zip(["", "", *words[1:]], words):
                kind = _WORD_KINDS.get(word, 0)
                if kind and before not in _WITHOUT and not (word == "header" and in_article):
                    found = kind if found == 0 else min(found, kind)
    return found


@dataclass(slots=True)
class Marked:
    """A marked element: the one around it (-1: none), its kind, and whether it holds an ``h1`` or an article."""

    around: int
    kind: int
    heading: bool = False
    article: bool = False


@dataclass(slots=True)
class Line:
    text: str
    marked: int  # the innermost marked element around it, or -1
    article: int  # the outermost article around it, or -1


class _Scanner:
    """Finds tags from left to right; no character is looked at more than a few times."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.quotes = True
        self.unclosed = {'"': len(page) + 1, "'": len(page) + 1}  # from here on this quote isn't closed

    def end(self, at: int) -> int:
        """Where the tag that starts before ``at`` ends: the next ``>`` outside quotes."""
        page, start = self.page, at
        while self.quotes:
            stop = _STOPS.search(page, at)
            if stop is None:
                self.quotes = False  # only quoted ends are left: from now on quotes don't count
                break
            at = stop.end()
            mark = stop[0]
            if mark == ">":
                return stop.start()
            if at < self.unclosed[mark]:
                closed = page.find(mark, at)
                if closed < 0:
                    self.unclosed[mark] = at
                else:
                    at = closed + 1
        return page.find(">", start)


class _Page:
    """Lines, marked elements and articles of a page, filled in one pass."""

    def __init__(self, page: str):
        self.lines: list[Line] = []
        self.marked: list[Marked] = []
        self.parents: list[int] = []  # of each outermost article, the number of the element around it
        self.headings: list[int] = []  # of each h1, the marked element around it
        self.articles: list[int] = []
        self._open: list[tuple[str, int, bool]] = []  # tag, marked element that it is, is it an article
        self._numbers: list[int] = []
        self._places: dict[str, list[int]] = {}
        self._special: list[int] = []  # places of open marked elements and articles
        self._count = 0
        self._inner = -1
        self._article = -1
        self._depth = 0
        self._parts: list[str] = []
        self._read(page)

    def _end_line(self) -> None:
        text = " ".join(html.unescape("".join(self._parts)).split())
        self._parts.clear()
        if text:
            self.lines.append(Line(text, self._inner, self._article))

    def _push(self, tag: str, kind: int) -> None:
        place = len(self._open)
        mark = -1
        if kind:
            self.marked.append(Marked(self._inner, kind))
            mark = self._inner = len(self.marked) - 1
        article = tag in _ARTICLE
        if article:
            if not self._depth:
                self.parents.append(self._numbers[-1] if self._numbers else -1)
                self._article = len(self.parents) - 1
                self.articles.append(self._inner)
            self._depth += 1
        if tag == "h1":
            self.headings.append(self._inner)
        if mark >= 0 or article:
            self._special.append(place)
        self._open.append((tag, mark, article))
        self._numbers.append(self._count)
        self._count += 1
        self._places.setdefault(tag, []).append(place)

    def _close(self, place: int) -> None:
        while len(self._open) > place:
            tag, mark, article = self._open.pop()
            self._numbers.pop()
            self._places[tag].pop()
            if mark >= 0 or article:
                self._special.pop()
            if mark >= 0:
                self._inner = self.marked[mark].around
            if article:
                self._depth -= 1
                if not self._depth:
                    self._article = -1

    def _read(self, page: str) -> None:
        scanner, at = _Scanner(page), 0
        while at <= scanner.last:
            start = page.find("<", at)
            if start < 0 or start > scanner.last:
                break
            self._parts.append(page[at:start])
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = len(page) if end < 0 else end + 3
                continue
            if page[start + 1] in "!?":
                at = page.find(">", start) + 1
                continue
            name = _NAME.match(page, start + 1)
            if name is None:
                self._parts.append("<")
                at = start + 1
                continue
            end = scanner.end(name.end())
            if end < 0:
                at = start
                break
            tag, closing, attributes = name[1].lower(), page[start + 1] == "/", page[name.end() : end]
            at = end + 1
            if tag in _RAW:
                if not closing and not attributes.endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                    at = close.end() if close else len(page)
                continue
            self._tag(tag, closing, attributes)
        self._parts.append(page[at:])
        self._end_line()

    def _tag(self, tag: str, closing: bool, attributes: str) -> None:
        kind = 0 if closing or tag in _VOID else _kind(tag, attributes, self._depth > 0)
        if tag in _BLOCKS or kind:
            self._end_line()
        if tag in _VOID or attributes.endswith("/"):
            return
        if not closing:
            if tag in _PARAGRAPH_ENDS and self._open and self._open[-1][0] == tag:
                self._close(len(self._open) - 1)
            if tag == "body" and self._places.get("head"):
                self._close(self._places["head"][-1])
            self._push(tag, kind)
        elif self._places.get(tag):
            place = self._places[tag][-1]
            holds = bool(self._special) and self._special[-1] >= place
            if holds and tag not in _BLOCKS:
                if self._open[place][1] < 0:
                    return  # an inline end tag does not end the blocks around it
                self._end_line()
            self._close(place)


def _dropped(page: _Page) -> list[bool]:
    """Whether each marked element, or one around it, is no text; the last entry stands for no element."""
    marked = page.marked
    for field, places in (("heading", page.headings), ("article", page.articles)):
        for i in places:
            while i >= 0 and not getattr(marked[i], field):
                setattr(marked[i], field, True)
                i = marked[i].around
    heading_outside, article_outside = -1 in page.headings, -1 in page.articles
    out = []
    for m in marked:
        held = m.article and not article_outside and not heading_outside
        frame = m.kind != NEVER and held or m.kind == FRAME and m.heading and not heading_outside
        out.append(not frame or (m.around >= 0 and out[m.around]))
    return [*out, False]


def densest(weights: list[int]) -> tuple[int, int]:
    """First line and end of the region with most text: lines in windows whose sums exceed ``SURGE`` of the largest."""
    sums = [sum(weights[i : i + WINDOW]) for i in range(max(len(weights) - WINDOW + 1, 1))]
    limit = SURGE * max(sums)
    regions, start = [], None
    for i, s in enumerate([*sums, 0]):
        if s > limit and start is None:
            start = i  # surge
        elif s <= limit and start is not None:
            regions.append((start, min(i - 1 + WINDOW, len(weights))))  # dive
            start = None
    return max(regions, key=lambda r: (sum(weights[r[0] : r[1]]), -r[0]), default=(0, 0))


def main_text(page: str) -> str:
    """Kept lines, joined by line feeds."""
    read = _Page(page)
    dropped = _dropped(read)
    weights = [0 if dropped[line.marked] else len(line.text) for line in read.lines]
    first, end = densest(weights) if weights else (0, 0)
    region = [(line, w) for line, w in zip(read.lines[first:end], weights[first:end]) if w]
    inside = sum(w for line, w in region if line.article >= 0)
    if 2 * inside >= sum(w for _, w in region) and region:
        parents = {read.parents[line.article] for line, _ in region if line.article >= 0}
        chosen = {i for i, parent in enumerate(read.parents) if parent in parents}
    else:
        chosen = {-1}
    return "\n".join(line.text for line, w in zip(read.lines, weights) if w and line.article in chosen)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(x.as_py() or "") for x in b.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), texts], names=["page_id", "url", "text"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
