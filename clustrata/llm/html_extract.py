"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, clustering.

The standard library's parser is fed piece by piece; its events build lines (the text of one
block each) with the number of tags met since the line before, and a skeleton of elements.
Lines inside elements that are never article text (scripts, menus, forms, asides, hidden ones)
are marked, and so are, as likely, those in blocks named as such by class, id or role (reader
comments, adverts, notices). The text-to-tag ratios of the others are smoothed with a
Gaussian over neighbouring lines and split in two clusters by a threshold found by two-means;
lines above it are evidence of content. The evidence chooses the regions: every article
element that holds some of it (main elements if no article does), else the smallest element
that holds all of it. All unmarked lines there are the text, short ones too. A likely mark
counts only if lines outside such blocks hold evidence of their own or the page has an
article; else the class names the page, not a part to leave out.

Memory: one page; time is linear in it. Defined cases: null and empty html give an empty text; so does a page
with surely marked lines only; a comment or declaration that never ends is markup to the end;
other markup that breaks off gives what was read; repeated rows repeat;
other columns are handed on and a column named ``main_text`` is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 16
#: Width of the Gaussian in lines.
SIGMA = 1.0
#: How many times the upper cluster's centre is the lower one's, at least, for two clusters.
APART = 1.5
#: Share of the evidence outside elements of a marked class or id below which these are the page itself.
BELIEVED = 0.05

# Element names by role, and words of class, id and role that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q ruby rb rt rp s samp
    small span strike strong sub sup time tt u var wbr""".split()
)
SKIPPED = frozenset(
    """script style noscript template svg math canvas iframe object embed audio video map head title nav footer aside form
    button select textarea input fieldset dialog menu noframes applet""".split()
)
ARTICLE = frozenset(("article", "main"))
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion nav navbar
    navigation menu menubar breadcrumb breadcrumbs sidebar side aside footer header masthead topbar cookie cookies consent
    gdpr notice notices notification alert banner disclaimer popup modal overlay newsletter subscribe subscription signup
    login share sharing social related recommended recommendations comment comments respond replies reply discussion disqus
    pagination pager toolbar widget widgets copyright skip paywall contentinfo complementary search""".split()
)
#: Marks that an article or its own heading may carry.
MILD = frozenset("header side banner notice alert share social related search widget promoted".split())
_WORDS = re.compile(r"[A-Za-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: Elements that the start of another of their kind ends.
_IMPLIED = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(name == "hidden" or (name == "aria-hidden" and (value or "").lower() == "true") or (name == "style" and _UNSEEN.search((value or "").lower()) is not None) for name, value in attrs)


#: How much an element's own name or attributes say: nothing, probably boilerplate (a class or id), certainly (its role or being hidden).
PLAIN, LIKELY, SURE = 0, 1, 2


class _Lines(HTMLParser):
    """Events to lines: (text, tags, element, mark). Every step is linear in the page, however deep it nests."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = ["#page"]
        self.parents: list[int] = [-1]
        self.marked: list[int] = [PLAIN]
        self.stack = [0]
        #: Depths of the open elements of each name, and of open articles.
        self.depths: dict[str, list[int]] = {}
        self.articles: list[int] = []
        self.lines: list[tuple[str, int, int, int]] = []
        self.text: list[str] = []
        #: Open inline elements from the first hidden one on; a block ends them.
        self.hidden: list[str] = []
        self.met = 0

    def _end_line(self) -> None:
        self.hidden.clear()
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                at = self.stack[-1]
                self.lines.append((text, self.met, at, self.marked[at]))
                self.met = 0
            self.text = []

    def _pop(self) -> None:
        tag = self.tags[self.stack.pop()]
        self.depths[tag].pop()
        if tag in ARTICLE:
            self.articles.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.met += 1
        if tag == "br":
            self.text.append(" ")
        if tag in INLINE:
            if tag not in VOID and (self.hidden or (attrs and _hidden(attrs))):  # a class says nothing about words in a sentence
                self.hidden.append(tag)
            return
        self._end_line()
        if tag in ARTICLE and self.marked[self.stack[-1]] and not self.articles:
            while len(self.stack) > 1 and self.marked[self.stack[-1]]:  # a menu or advert that was never closed
                self._pop()
        if tag in _IMPLIED and self.tags[self.stack[-1]] in _IMPLIED[tag]:
            self._pop()
        if tag not in VOID:
            self._open(tag, attrs)

    def _open(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        parent = self.stack[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.marked.append(max(self.marked[parent], self._mark(tag, attrs)))
        self.depths.setdefault(tag, []).append(len(self.stack))
        if tag in ARTICLE:
            self.articles.append(len(self.stack))
        self.stack.append(len(self.tags) - 1)

    def _mark(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in SKIPPED or _hidden(attrs):
            return SURE
        inside = tag in ARTICLE or tag in ("html", "body") or bool(self.articles)
        if tag == "header":
            return PLAIN if inside else SURE
        if tag in ARTICLE or tag in ("html", "body"):
            return PLAIN
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop"):
                words = {w for part in _WORDS.findall((value or "").lower()) for w in (part, part.rstrip("s"))} & MARKS
                if words and not (inside and words <= MILD):
                    return LIKELY
        return PLAIN

    def handle_endtag(self, tag: str) -> None:
        self.met += 1
        open_ = self.depths.get(tag)
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
            elif self.hidden and self.hidden[-1] == tag:
                self.hidden.pop()
            return
        self._end_line()
        if not open_ or (self.articles and self.articles[-1] > open_[-1] and tag not in ("body", "html", "main")):
            return  # a stray end tag, which doesn't close the article either
        depth = open_[-1]
        while len(self.stack) > depth:
            self._pop()

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)

    def done(self) -> list[tuple[str, int, int, int]]:
        if "<!" in self.rawdata[:2] or self.rawdata.startswith("<?"):
            self.rawdata = ""  # markup that never ends
        self.close()
        self._end_line()
        return self.lines


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing over neighbours within three sigma."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for k, g in enumerate(kernel, i - reach):
            if 0 <= k < len(values):
                total += g * values[k]
                weight += g
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """Half-way between the centres of two clusters of the values; their minimum if the centres differ by less than ``APART``."""
    low, high = min(values), max(values)
    for _ in range(50):
        cut = (low + high) / 2
        below, above = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not below or not above:
            return min(values)
        new = sum(below) / len(below), sum(above) / len(above)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high >= APART * low else min(values)


def evidence(lines: list[tuple[str, int, int, int]], least: int) -> list[bool]:
    """Which lines, of those marked less than ``least``, are in the upper cluster of smoothed text-to-tag ratios."""
    ratios = smoothed([0.0 if mark >= least else len(text) / max(1, tags) for text, tags, _, mark in lines])
    cut = threshold([r for r, x in zip(ratios, lines, strict=True) if x[3] < least])
    return [mark < least and r >= cut for r, (_, _, _, mark) in zip(ratios, lines, strict=True)]


def extract(html: str | None) -> list[str]:
    """The lines of the main text in page order."""
    parser = _Lines()
    html = html or ""
    for at in range(0, len(html), PIECE):
        parser.feed(html[at : at + PIECE])
    lines = parser.done()
    least = SURE
    if not any(x[3] < least for x in lines):
        return []
    chosen = evidence(lines, least)
    # a class or id is believed unless the elements it names hold nearly all of the evidence: then it names the page
    sizes = [sum(len(x[0]) for x, c in zip(lines, chosen, strict=True) if c and x[3] == mark) for mark in (PLAIN, LIKELY)]
    if sizes[0] > BELIEVED * sum(sizes) or any(tag in ARTICLE for tag in parser.tags):
        least = LIKELY
        if not any(x[3] < least for x in lines):
            return []
        chosen = evidence(lines, least)
    held = [0] * len(parser.tags)
    for found, (text, _, element, _) in zip(chosen, lines, strict=True):
        held[element] += len(text) * found
    total = sum(held)
    for element in range(len(held) - 1, 0, -1):  # children follow their parents
        held[parser.parents[element]] += held[element]
    regions = _regions(parser, held, total, least)
    inside = [False] * len(parser.tags)
    for e in range(len(parser.tags)):
        inside[e] = e in regions or (parser.parents[e] >= 0 and inside[parser.parents[e]])
    return [text for text, _, element, mark in lines if inside[element] and mark < least]


def _regions(parser: _Lines, held: list[int], total: int, least: int) -> set[int]:
    for kind in ("article", "main"):  # one inside another comes with it
        if found := {e for e, tag in enumerate(parser.tags) if tag == kind and parser.marked[e] < least and held[e] > 0}:
            return found
    best = 0
    for e in range(len(parser.tags)):  # children follow their parents, so the last that fits is the smallest
        if held[e] >= total and parser.tags[e] not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "span", "a", "td", "tr"):
            best = e
    return {best}


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The rows of ``pages``, without the html, with ``main_text``: lines joined by a line feed."""
    kept = [c for c in pages.columns if c.lower() != "main_text" and c != html_col]
    plain = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").cast("string").alias("main_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.num_columns - 1
            for lo in range(0, max(1, batch.num_rows), 64):
                part = batch.slice(lo, 64)
                texts = ["\n".join(extract(h.as_py())) for h in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(texts, pa.string())], names=batch.schema.names)

    return plain.mapInArrow(scan, plain.schema)
