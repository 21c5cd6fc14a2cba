"""Main text of web pages by text-to-tag ratios.

The events of the standard library's streaming parser give lines: the text between two
block-level tags, with the number of tags it took and the element it is in. A line's ratio is
its text for each tag. Ratios are smoothed with a Gaussian over neighbouring lines, so
that short lines between long ones count as content, and split by a threshold, their
standard deviation. The element that holds the lines above the threshold is the content region;
what a page marks as something else (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, reader comments) is never part of it.

A page is parsed in one task, page after page; nothing is kept between pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEXTS = "page_id long, url string, text string, n_chars long"

# Names of HTML elements, roles and the words pages use as class names.
VOID = frozenset(
    "area base br col embed frame hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section select summary table tbody tfoot thead tr "
    "ul".split()
)
CELLS = frozenset("td th br".split())
SECTIONS = frozenset("article aside body footer form header html main nav section table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOT_CONTENT = frozenset(
    "applet aside audio button canvas datalist dialog footer frameset head iframe input map "
    "menu nav noframes noscript object optgroup option script search select style svg template "
    "textarea title video".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search toolbar".split()
)
# Class and id names with one of these words.
WORDS = frozenset(
    "ad ads adsense adslot adunit advert adverts advertisement advertisements advertising aside "
    "banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright disclaimer disqus footer gdpr header login masthead menu menus modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo promos "
    "promotion recommendations recommended related replies reply respond share sharebar "
    "sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription toolbar "
    "topbar widget widgets".split()
)
# These before such a word say that the element has or lacks one and is another thing.
ABOUT = frozenset("has have no not with without hide show is".split())
# Headings after which the rest of an element is what readers wrote.
COMMENT_HEADINGS = frozenset(
    "comments|reader comments|readers' comments|user comments|leave a comment|leave a reply|"
    "post a comment|kommentare|leserkommentare|commentaires|comentarios".split("|")
)
# An end of these is implied by a start of those.
CLOSED_BY = {
    "p": BLOCKS - {"option", "optgroup", "legend", "caption", "summary"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "option": frozenset(["option", "optgroup"]),
}
# Elements an implied end does not reach out of.
SCOPES = {
    "li": frozenset(["ol", "ul", "menu", "dir"]),
    "dt": frozenset(["dl"]),
    "dd": frozenset(["dl"]),
    "tr": frozenset(["table"]),
    "td": frozenset(["table"]),
    "th": frozenset(["table"]),
    "option": frozenset(["select", "datalist"]),
    "p": frozenset(["button", "table", "td", "th", "object"]),
}

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# A tag that the end of the page cuts off.
_CUT_TAG = re.compile(r"</?[A-Za-z][^>]*\Z")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

IMPLIES = {
    tag: [closed for closed, starts in CLOSED_BY.items() if tag in starts]
    for tag in frozenset().union(*CLOSED_BY.values())
}
# Article elements with one of these words are not the article.
OTHER_ARTICLES = frozenset("comment comments reply replies related recommended promo".split())

# Whether text in an element is read: yes; headings only; no, but an article in it is; no.
READ, HEADS, NAMED, OUT = range(4)


def words_of(names: str) -> list[list[str]]:
    return [[w.lower() for w in _WORD.findall(name)] for name in names.split()]


def boilerplate_word(names: str) -> str | None:
    """The word by which a class or id list names a part of a page that is not its text."""
    for words in words_of(names):
        for i, word in enumerate(words):
            if word in WORDS and not (i and words[i - 1] in ABOUT):
                return word
    return None


class Lines(HTMLParser):
    """The lines of a page, from parser events: texts, tags, characters in links, elements.

    Block elements are numbered; ``parents`` and ``kinds`` are by number, and 0 is the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.links: list[int] = []
        self.homes: list[int] = []
        self.parents, self.kinds = [0], [""]
        # Open elements: name, number of the block, whether it is read. Depths by name.
        self.open: list[tuple[str, int, int]] = [("", 0, READ)]
        self.depths: dict[str, list[int]] = {}
        self.section_depths, self.block_depths = [0], [0]
        # Elements whose rest is what readers wrote.
        self.ended: set[int] = set()
        self.parts: list[str] = []
        self.n_links = self.n_tags = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """HTML has no marked sections: they are comments, whatever they begin with."""
        return self.parse_bogus_comment(i, report)

    def line(self) -> None:
        """Ends the line that is being read."""
        text = " ".join("".join(self.parts).split())
        if text:
            tag, number, _ = self.open[-1]
            at = self.kinds[number]
            if at in HEADINGS and text.strip(" :.!0123456789()").lower() in COMMENT_HEADINGS:
                self.ended.add(self.parents[number])
            else:
                self.texts.append(text)
                self.tags.append(self.n_tags)
                self.links.append(self.n_links)
                self.homes.append(number)
        self.parts = []
        self.n_tags = self.n_links = 0

    def _depth(self, tag: str) -> int:
        held = self.depths.get(tag)
        return held[-1] if held else 0

    def _close(self, depth: int) -> None:
        """Ends all elements from this depth on."""
        while len(self.open) > depth:
            tag, number, _ = self.open[-1]
            if tag in BLOCKS:
                self.line()
                self.block_depths.pop()
                self.ended.discard(number)
            if tag in SECTIONS:
                self.section_depths.pop()
            self.depths[tag].pop()
            self.open.pop()

    def _read(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        _, number, outer = self.open[-1]
        if outer == OUT or number in self.ended or tag in NOT_CONTENT:
            return OUT
        held = {k: v or "" for k, v in attrs}
        hidden = "hidden" in held or held.get("aria-hidden") == "true"
        if hidden or _HIDDEN.search(held.get("style", "")):
            return OUT
        if held.get("role", "").lower() in ROLES:
            return OUT
        if tag in ("html", "body", "main"):
            return READ
        names = f"{held.get('class', '')} {held.get('id', '')}"
        if tag == "article":
            other = any(OTHER_ARTICLES.intersection(words) for words in words_of(names))
            return OUT if other else READ
        if outer == NAMED or tag == "form":
            return NAMED
        inside = self._depth("article") or self._depth("main")
        word = "header" if tag == "header" else None
        if tag not in HEADINGS and names != " ":
            word = word or boilerplate_word(names)
        if word in ("header", "banner", "masthead") and inside:
            return HEADS
        return NAMED if word else outer

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        for closed in IMPLIES.get(tag, ()):
            depth = self._depth(closed)
            if depth and depth > max(self._depth(s) for s in SCOPES[closed]):
                self._close(depth)
        block = tag in BLOCKS
        if block:
            self.line()
        elif tag in CELLS:
            self.parts.append(" ")
        self.n_tags += 1
        if tag in VOID:
            return
        read = self._read(tag, attrs)
        number = self.open[-1][1]
        if block:
            self.parents.append(number)
            self.kinds.append(tag)
            number = len(self.parents) - 1
            self.block_depths.append(len(self.open))
        if tag in SECTIONS:
            self.section_depths.append(len(self.open))
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, number, read))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """A slash at the end of a start tag means nothing in HTML."""
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.n_tags += 1
        depth = self._depth(tag)
        # An end tag ends its element only if that is in the same block or section.
        within = self.section_depths if tag in BLOCKS else self.block_depths
        if tag in CELLS:
            self.parts.append(" ")
        if depth and (tag in SECTIONS or depth >= within[-1]):
            self._close(depth)

    def handle_data(self, data: str) -> None:
        tag, number, read = self.open[-1]
        if read == READ or (read == HEADS and self.kinds[number] in HEADINGS):
            if number not in self.ended:
                self.parts.append(data)
                if self.depths.get("a"):
                    self.n_links += len(data)


def smoothed(ratios: np.ndarray, radius: int = 2, deviation: float = 1.0) -> np.ndarray:
    """Gaussian means of neighbouring values; at the ends of what there is."""
    x = np.arange(-radius, radius + 1)
    kernel = np.exp(-(x**2) / (2 * deviation**2))
    padded = np.convolve(ratios, kernel)[radius : radius + len(ratios)]
    weight = np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]
    return padded / weight


def _outermost(page: Lines, kind: str) -> np.ndarray:
    """For each element the outermost element of a kind that it is or is in, or 0."""
    out = np.zeros(len(page.parents), dtype=np.int64)
    for number, parent in enumerate(page.parents):
        out[number] = out[parent] or (number if page.kinds[number] == kind else 0)
    return out


def _heaviest(homes: np.ndarray, weights: np.ndarray) -> tuple[int, float, int]:
    """The element with the most text, that text, and how many elements there are."""
    held = np.flatnonzero(homes)
    if not len(held):
        return 0, 0.0, 0
    sums = np.bincount(homes[held], weights[held])
    best = int(np.argmax(sums))
    return best, float(sums[best]), len(np.unique(homes[held]))


def _common_element(page: Lines, homes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Which lines are in the innermost element, of several lines, that has most of the text."""
    sums = np.zeros(len(page.parents))
    np.add.at(sums, homes, weights)
    for number in range(len(page.parents) - 1, 0, -1):
        sums[page.parents[number]] += sums[number]
    single = HEADINGS | {"p", "li", "dt", "dd", "pre", "figcaption", "caption", "legend", "summary"}
    chosen = 0
    for number in range(1, len(page.parents)):
        if sums[number] >= 0.8 * sums[0] and page.kinds[number] not in single:
            chosen = number
    inside = np.zeros(len(page.parents), dtype=bool)
    inside[chosen] = True
    for number in range(1, len(page.parents)):
        inside[number] |= inside[page.parents[number]]
    return inside[homes]


def content_lines(page: Lines) -> np.ndarray:
    """Which lines are content.

    Lines above the threshold say which element holds the text. That is the only article of a
    page, the article with more than half of that text, a main element, or else the innermost element with
    most of it; in that last case lines of links are not content. The element's lines are
    content whole, short ones too.
    """
    n = np.array([len(t) for t in page.texts], dtype=np.float64)
    homes = np.array(page.homes, dtype=np.int64)
    ratios = smoothed(n / np.maximum(page.tags, 1))
    chosen = n * (ratios >= ratios.std())
    articles, mains = _outermost(page, "article")[homes], _outermost(page, "main")[homes]
    article, weight, count = _heaviest(articles, chosen)
    main, main_weight, _ = _heaviest(mains, chosen)
    if article and (count == 1 or 2 * weight > (main_weight if main else chosen.sum())):
        return articles == article
    if main:
        return mains == main
    links = np.array(page.links) >= 0.8 * n
    return _common_element(page, homes, chosen) & ~(links & (n < 200))


def main_text(html: str | None) -> str:
    """The content lines of a page, with an empty line between them."""
    page = Lines()
    page.feed(html or "")
    if _CUT_TAG.match(page.rawdata):
        page.rawdata = ""
    page.close()
    page.line()
    if not page.texts:
        return ""
    return "\n\n".join(t for t, kept in zip(page.texts, content_lines(page), strict=True) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of each page.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are not read. A block of a
    page is one line of the text, with single blanks for its white space, and blocks are joined
    by an empty line. The text is empty for a null or empty page and for one without any. Null
    numbers and urls stay null, and rows that repeat are rows each. Cut tags and references at the
    end, unknown elements and missing ends are read as browsers do, and no page is an error. No
    rows give no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Few pages at once: one may be very long.
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = [main_text(html) for html in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).mapInArrow(read, TEXTS)
