"""Main text of web pages: parser events, text-to-tag ratios per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page's events. A block-level tag ends a line; each line keeps its text, the
tags seen in it and the container it lies in. Elements that are no text of an article (menus, page headers, footers,
sidebars, forms, scripts, styles, by element or role) carry none. The text-to-tag ratios of all lines are smoothed with
a Gaussian, and lines at or above a threshold of one standard deviation are clustered by container. The least container
that holds all clusters is the content region; if that is the whole page, the clusters' own containers are. A region
inside an article or main element grows to that element, and where most of the clustered text lies in such elements,
clusters outside them go. The page's text is every line of the region, so that short paragraphs between long ones stay.

A container whose class or id says that it is an advert, a sidebar, reader comments and the like has no weight: its lines
count only on pages that have no text elsewhere. A name says so only if one of its parts is such a word and the others
are neutral, like "comment-list"; "has-sidebar" or "related-work" say nothing.

Defined results: null and empty pages, and pages without text outside the parts above, give the empty text; broken
markup is read as browsers do (a paragraph ends where the next block begins); pages of any length and depth take linear
time; lines of equal ratio are treated alike; repeated rows are given back each time; other columns are left alone.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements and words by which markup names its parts.
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HOLDER = frozenset("article main section div td body aside blockquote".split())
_DROP = frozenset("head title script style noscript template nav footer aside form button select textarea iframe object canvas audio video dialog menu".split())
_DROP_ROLE = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form status".split())
_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription signup share sharing social related recommended comment comments commentlist reply replies disqus discussion login search widget pagination pager toolbar hidden".split())
_NEUTRAL = frozenset("a area bar block bottom box container content footer global group header holder inner item items js left links list main outer page panel post reader right section site slot text top unit user wrap wrapper".split())
_ENDS_P = _BLOCK - {"body", "html", "head", "title", "option", "optgroup", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"}
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_PARTS = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_OPENS = re.compile("<[A-Za-z/!?]")
_LIST = ("ul", "ol", "dl", "table", "tr", "select")


def named(value: str) -> bool:
    """Whether a class or an id says that its element is no part of an article."""
    for token in value.split():
        parts = [x.lower() for x in _PARTS.findall(token)]
        if any(x in _NAMES for x in parts) and all(x in _NAMES or x in _NEUTRAL for x in parts):
            return True
    return False


class _Lines(HTMLParser):
    """Lines of a page: text, tags, container, whether that has weight."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.open: list[tuple[str, bool, int, bool, bool]] = [("", False, 0, True, False)]  # tag, unwanted, container, weight, whether in an article
        self.where: dict[str, list[int]] = {}  # tag -> places in ``open``
        self.above = [0]  # container -> the one around it
        self.grown = {0: 0}  # container -> the article or main element that a region inside it grows to
        self.text: list[str] = []
        self.tags = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text or self.tags:
            self.lines.append((text, self.tags, *self.open[-1][2:4]))
        self.text, self.tags = [], 0

    def _last(self, tags) -> int:
        return max((self.where[t][-1] for t in tags if self.where.get(t)), default=0)

    def _pop(self, tags, until=()) -> None:
        """Closes the innermost element of the tags, with all in it, if none of ``until`` lies between."""
        at = self._last(tags)
        if not at or self._last(until) > at:
            return
        if any(x[0] in _BLOCK for x in self.open[at:]):
            self.end_line()
        for x in self.open[at:]:
            self.where[x[0]].pop()
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            self._pop(("p",), _HOLDER)
        if tag in _SAME:
            self._pop(_SAME[tag], [t for t in _LIST if t not in _SAME[tag]])
        if tag in _BLOCK:
            self.end_line()
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in _VOID:
            return
        _, off, holder, weight, article = self.open[-1]
        off = off or tag in _DROP or tag == "header" and not article
        apart = False
        for k, v in attrs:
            off = off or k == "hidden" or k == "aria-hidden" and v == "true" or k == "role" and v is not None and v.lower() in _DROP_ROLE and tag not in ("body", "html")
            apart = apart or k in ("class", "id") and v is not None and tag not in ("body", "html") and named(v)
        if tag in _HOLDER or apart:
            new = len(self.above)
            self.above.append(holder)
            self.grown[new] = new if tag in ("article", "main") and not article else self.grown[holder]
            holder, article = new, article or tag in ("article", "main")
        self.where.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, off, holder, weight and not apart, article))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.where.get(tag):
            self.tags += 1
            self._pop((tag,))
        elif tag in _BLOCK:
            self.end_line()

    def parse_html_declaration(self, i):
        # marked sections are comments in web pages; the parser would refuse ill-formed ones
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def handle_data(self, data):
        if not self.open[-1][1]:
            self.text.append(data)


def smooth(x: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """A Gaussian over neighbouring lines; the ends weigh what there is."""
    r = int(3 * sigma)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return (np.convolve(x, k) / np.convolve(np.ones(len(x)), k))[r : r + len(x)]


def content(lines: list[tuple[str, int, int, bool]]) -> set[int]:
    """The containers of the lines whose smoothed text-to-tag ratio reaches the threshold."""
    ratio = np.array([len(t) * w / max(1, n) for t, n, _, w in lines])
    level = smooth(ratio)
    above = level >= level.std()
    clusters = {c for (t, _, c, w), a in zip(lines, above) if a and t and w}
    return clusters or {-max((r, -c) for r, (t, _, c, w) in zip(level, lines) if t and w)[1]}


def _region(clusters: set[int], above: list[int], grown: dict[int, int]) -> set[int]:
    """The clusters' least common container, or they themselves if that is the page; each grown to its article."""
    held = [0] * len(above)
    for c in clusters:
        held[c] = 1
    for c in range(len(above) - 1, 0, -1):  # a container's number is above that of the one around it
        held[above[c]] += held[c]
    common = max(c for c in range(len(above)) if held[c] == len(clusters))
    roots = {common} if common and above[common] else clusters
    return {grown[c] or c for c in roots}


def whole_tags(html: str) -> str:
    """The page without a tag that its end cuts off; the parser would look for that tag's end again and again."""
    last = html.rfind(">") + 1
    m = _OPENS.search(html, last)
    return html[: m.start()] if m else html


def main_text(html: str | None, choose=content) -> str:
    """choose: the containers of the lines that are content."""
    if not html:
        return ""
    p = _Lines()
    p.feed(whole_tags(html))
    p.close()
    p.end_line()
    lines = p.lines
    if not any(t for t, *_ in lines):
        return ""
    if not any(t and w for t, _, _, w in lines):
        lines = [(t, n, c, True) for t, n, c, _ in lines]
    clusters = choose(lines)
    size = {True: 0, False: 0}
    for t, _, c, w in lines:
        if w and c in clusters:
            size[p.grown[c] > 0] += len(t)
    if size[True] >= size[False]:
        clusters = {c for c in clusters if p.grown[c]} or clusters
    roots = _region(clusters, p.above, p.grown)
    inside: list[bool] = []
    for c, up in enumerate(p.above):
        inside.append(c in roots or c > 0 and inside[up])
    return "\n".join(t for t, _, c, w in lines if t and w and inside[c])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text."""

    def run(batches):
        for b in batches:
            text = [main_text(x) for x in b["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(text, pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string")
