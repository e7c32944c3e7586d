"""Main text of web pages: parser events, text-to-tag ratios per line, smoothing and clustering."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elements of HTML and the words that sites name their surroundings by.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video nav footer aside form button select "
    "option textarea dialog menu".split()
)
HIDDEN_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice alert newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead "
    "footer comment comments disqus respond replies share sharing social related recommended popup modal overlay login search "
    "pagination pager toolbar widget".split()
)
HIDDEN_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
ROOTS = frozenset("html body article main".split())
CLOSED_BY_BLOCK = frozenset(["p"])
NAME_PARTS = re.compile(r"[a-z]+")
RADIUS = 2


class _Lines(HTMLParser):
    """Collects lines: [text, tags, depth of article or main]; a line ends where a block element begins or ends."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int]] = []
        self.open: list[tuple[str, bool]] = []  # element, and whether it hides what it holds
        self.hidden = self.inside = self.tags = 0
        self.parts: list[str] = []

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, self.tags, self.inside))
                self.tags = 0
            self.parts = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append("\n")
        if tag not in INLINE and tag != "br":
            self.end_line()
        if tag in VOID:
            return
        if tag in ("article", "main"):  # what hides the page around it and was never closed ends here
            while self.hidden:
                self.pop()
            self.inside += 1
        elif tag not in INLINE:
            # A block ends an open paragraph, and the inline elements left open in it with it.
            while self.open and self.open[-1][0] in INLINE and not self.open[-1][1]:
                self.open.pop()
            if self.open and self.open[-1][0] in CLOSED_BY_BLOCK:
                self.open.pop()
        hides = tag not in ROOTS and self.hides(tag, attrs)
        self.open.append((tag, hides))
        self.hidden += hides

    def hides(self, tag: str, attrs: list) -> bool:
        if tag in HIDDEN or tag == "header" and not self.inside:
            return True
        for name, value in attrs:
            if name in ("class", "id") and value:
                if not HIDDEN_NAMES.isdisjoint(NAME_PARTS.findall(value.lower())):
                    return True
            elif name == "role" and value and value.lower() in HIDDEN_ROLES or name == "hidden":
                return True
            elif name == "aria-hidden" and value == "true" or name == "style" and value and "display:none" in value.replace(" ", ""):
                return True
        return False

    def pop(self) -> str:
        tag, hides = self.open.pop()
        self.hidden -= hides
        self.inside -= tag in ("article", "main")
        return tag

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.end_line()
        # An end tag closes its element unless an article or the page lies between.
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i][0] in ROOTS and tag not in ROOTS:
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)

    def unknown_decl(self, data: str) -> None:
        self.tags += 1


def parse_lines(html: str) -> list[tuple[str, int, int]]:
    """Lines of a page. Markup that the parser gives up on is read as text."""
    try:
        parser = _Lines()
        parser.feed(html)
        parser.close()
    except AssertionError:
        parser = _Lines()
        parser.feed(html.replace("<!", "&lt;!"))
        parser.close()
    parser.end_line()
    return parser.lines


def _smooth(ratios: np.ndarray) -> np.ndarray:
    steps = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(steps**2) / (2.0 * (RADIUS / 2) ** 2))
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[RADIUS : RADIUS + len(ratios)]
    return np.convolve(ratios, kernel, "full")[RADIUS : RADIUS + len(ratios)] / weight


def content_lines(ratios: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Which lines are content: all clusters of smoothed ratios above the threshold, and what lies between them.

    Ratios are smoothed by a Gaussian over `RADIUS` lines to either side. The threshold is their
    standard deviation, but no more than their mean, so a page of even lines is content as a whole.
    On a page with an `article` or `main` element a line inside counts at least the mean ratio;
    neither smoothing nor what lies between crosses the element's edge.
    """
    threshold = min(_smooth(ratios).std(), ratios.mean())
    weighted = np.where(inside, np.maximum(ratios, ratios.mean()), ratios)
    kept = np.zeros(len(ratios), bool)
    cuts = np.flatnonzero(np.r_[True, inside[1:] != inside[:-1], True])
    for begin, end in zip(cuts, cuts[1:]):
        above = begin + np.flatnonzero(_smooth(weighted[begin:end]) >= threshold * (1 - 1e-9))
        if len(above):
            kept[above[0] : above[-1] + 1] = True
    return kept


def main_text(html: str) -> str:
    """The article of a page as one line of text; empty if there is none.

    Lines in elements that hold no article (menus, footers, adverts, forms, …) never count. Of the
    rest those with high text-to-tag ratios are the content, with the lines between them. All lines
    of an `article` or `main` element reach the threshold; lines outside must do so by their own ratios.
    """
    lines = parse_lines(html)
    if not lines:
        return ""
    inside = np.array([inside > 0 for _, _, inside in lines])
    kept = content_lines(np.array([len(text) / max(1, tags) for text, tags, _ in lines]), inside)
    return " ".join(text for (text, _, _), keep in zip(lines, kept) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page: (page_id, url, text, n_chars). A null page has an empty text.

    A page is read by itself, so repeated rows and ids stay as they are; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                texts = [main_text(html) if html else "" for html in batch.column("html").to_pylist()]
                columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
