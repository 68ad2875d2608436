"""Main-text extraction from raw HTML.

The standard-library parser streams tag and text events. Text between block-level tags is one line; each
line has a text-to-tag ratio (its characters over the tags met in it), the sequence of ratios is smoothed with
a Gaussian and split into content and boilerplate by threshold clustering (two means in one dimension). The content lines
select the region: the innermost ``article`` or ``main`` that holds most of their text, else the deepest container
with nearly all of it. Of that region every line is returned except those inside menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments, which are known by element, role, or a class or id
that consists of the words for them (``share-buttons``, but not ``social-policy``). An id names noise on containers only: on a
paragraph or heading it is an anchor. Outside an ``article`` or ``main``, link lists are not part of the article either, nor, before the first and
after the last content line, is text that stands in no paragraph, heading, list or table cell.

Noise inside a line (a hidden ``span``, an ``svg``, a ``button``, a ``script``) is left out and does not end the line.

Edge cases: null or empty html gives an empty text; a page without any content line too. Unclosed and misnested elements are closed
where the next fitting end tag closes them; an unknown reference stays as written. ``br`` is white space inside a line.
Every page row gives one row, repeated ones too; other columns pass through or are ignored. The time is linear in the length of
the page, however deep it is nested and however many end tags fit nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight.llm.common import prepare, ship_by_value

#: Fixed values of HTML: elements without an end tag; elements that break a line; elements whose same-named sibling closes them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_ITSELF = frozenset("dd dt li option p td th tr".split())
#: Elements, roles and words of a class or id that mark what is not the article.
NOISE_TAGS = frozenset(
    "aside button canvas dialog fieldset footer form head header iframe input menu nav noscript object optgroup option "
    "script search select style svg template textarea title".split())
NOISE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adbox adsense adslot adv advert adverts advertisement advertising banner breadcrumb breadcrumbs colophon "
    "comment commentlist comments consent cookie cookies copyright crumbs dialog disclaimer disqus footer gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification notifications overlay pager "
    "pagination paywall popup promo promotion recommendations recommended related replies reply respond search share "
    "sharing sidebar sidenav signin signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar "
    "warning widget widgets".split())
#: Words that say nothing about what an element holds: a class may add them to a word above.
NEUTRAL_WORDS = frozenset(
    "area article articles bar block blog body bottom box btn button buttons card col column container content entry "
    "form global group icons inner item items large layer left link links list main mobile module outer panel page "
    "placeholder post posts primary right row secondary section site slot small sticky story thread to top unit user "
    "view wrap wrapper".split())
TEXT_TAGS = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
ANCHORED = TEXT_TAGS | {"tr", "caption"}
CONTAINERS = frozenset("article body center div main section table tbody td tr html".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SIGMA = 1.0
MOST, NEARLY_ALL = 0.5, 0.9


class Element:
    __slots__ = ("tag", "up", "noise", "mass")

    def __init__(self, tag: str, up: Element | None, noise: str):
        self.tag, self.up, self.noise, self.mass = tag, up, noise, 0


class Line:
    __slots__ = ("text", "tags", "linked", "links", "at")

    def __init__(self, text: str, tags: int, linked: int, links: int, at: Element):
        self.text, self.tags, self.linked, self.links, self.at = text, tags, linked, links, at

    @property
    def is_link(self) -> bool:
        return 2 * self.linked > len(self.text)


def names_noise(token: str) -> bool:
    """Whether a class or id consists of words for noise, besides words that say nothing and numbers."""
    words = [x.lower() for x in WORDS.findall(token)]
    named = [x in NOISE_WORDS for x in words]
    return any(named) and all(n or x in NEUTRAL_WORDS or x.isdigit() for n, x in zip(named, words, strict=True))


def noise_of(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """Why an element is no part of an article ('' if nothing says so)."""
    if tag in NOISE_TAGS:
        return tag
    if tag in ("html", "body", "article", "main"):
        own = dict(attrs)
        words = own.get("class") or ""
        names = f"{words} {own.get('id') or ''}".split()
        return "comment" if tag == "article" and any("comment" in x.lower() and names_noise(x) for x in names) else ""
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "hidden"
        if name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return "hidden"
        if name == "role" and value and value.lower() in NOISE_ROLES:
            return "role"
        if (name == "class" or name == "id" and tag not in ANCHORED) and value and any(map(names_noise, value.split())):
            return "words"
    return ""


class Lines(HTMLParser):
    """Parser events to lines. ``elements`` lists the block elements, every one after the one around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.at = self.root = Element("", None, "")
        self.elements = [self.root]
        self.open = Counter()  # elements around the current text, by tag
        self.scopes = [Counter()]  # the same for each article or main around it
        self.pieces: list[str] = []
        self.tags = self.linked = self.links = 0
        self.in_link = False
        self.skipped, self.depth, self.blocks = "", 0, Counter()  # noise inside a line

    def end_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.lines.append(Line(text, self.tags, self.linked, self.links, self.at))
            self.tags = 0
        self.pieces, self.linked, self.links = [], 0, 0

    def enter(self, tag: str, noise: str) -> None:
        self.at = Element(tag, self.at, noise)
        self.elements.append(self.at)
        self.open[tag] += 1
        if tag in ("article", "main"):
            self.scopes.append(Counter())
        else:
            self.scopes[-1][tag] += 1

    def leave(self) -> None:
        tag = self.at.tag
        self.open[tag] -= 1
        if tag in ("article", "main"):
            self.scopes.pop()
        else:
            self.scopes[-1][tag] -= 1
        self.at = self.at.up

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skipped:
            if tag not in ("article", "main"):
                self.depth += tag == self.skipped
                self.blocks[tag] += tag in BREAKS and tag not in VOID
                return
            self.skipped = ""  # never closed
        self.tags += 1
        if tag not in BREAKS:
            if tag == "br":
                self.pieces.append(" ")
            elif tag not in VOID and noise_of(tag, attrs):
                self.pieces.append(" " if tag in ("script", "style", "template", "noscript") else "")
                self.skipped, self.depth, self.blocks = tag, 1, Counter()
            elif tag == "a":
                self.in_link = True
                self.links += 1
            return
        self.end_line()
        if tag in VOID:
            return
        if self.at.tag == "p" or tag in CLOSES_ITSELF and self.at.tag == tag:
            self.leave()
        why = self.at.noise or noise_of(tag, attrs)
        if tag in ("article", "main") and why == "form":  # a form around the whole page
            why = ""
        self.enter(tag, why)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in ("svg", "math"):  # on an HTML element the slash means nothing
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.skipped:
            if tag == self.skipped:
                self.depth -= 1
                if not self.depth:
                    self.skipped = ""
                return
            if tag not in BREAKS:
                return
            if self.blocks[tag]:
                self.blocks[tag] -= 1
                return
            if not self.closes(tag):
                return
            self.skipped = ""  # the block around it ends
        self.tags += 1
        if tag == "a":
            self.in_link = False
        if tag in BREAKS:
            self.end_line()
            if self.closes(tag):
                while self.at.tag != tag:
                    self.leave()
                self.leave()

    def closes(self, tag: str) -> bool:
        """Whether the end tag fits an open element; a stray one does not end the article."""
        return (self.open if tag in ("article", "main", "body", "html") else self.scopes[-1])[tag] > 0

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.pieces.append(data)
            if self.in_link:
                self.linked += len(data.strip())

    def read(self, html: str) -> list[Line]:
        self.feed(html)
        self.close()
        self.end_line()
        return self.lines


def content_lines(lines: list[Line], sigma: float = SIGMA) -> np.ndarray:
    """Which lines belong to the upper of two clusters of smoothed text-to-tag ratios."""
    ratios = np.array([0.0 if x.at.noise else len(x.text) / max(x.tags, 1) for x in lines])
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(ratios, reach)
    weight = np.convolve(np.pad(np.ones(len(ratios)), reach), kernel, "valid")
    smooth = np.log1p(np.convolve(padded, kernel, "valid") / weight)
    low, high = float(smooth.min()), float(smooth.max())
    if high - low < 1e-9:
        return np.ones(len(lines), bool)
    for _ in range(50):
        cut = (low + high) / 2
        upper = smooth >= cut
        new = float(smooth[~upper].mean()), float(smooth[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return smooth >= (low + high) / 2


def region(lines: list[Line], content: np.ndarray, elements: list[Element]) -> Element:
    """The element that holds the content lines."""
    total = 0
    for line, good in zip(lines, content, strict=True):
        if good and not line.at.noise:
            total += len(line.text)
            line.at.mass += len(line.text)
    for x in reversed(elements):
        if x.up is not None:
            x.up.mass += x.mass
    best, found = None, elements[0]
    for x in elements:
        if x.tag in ("article", "main"):
            if x.mass >= MOST * total and (best is None or x.tag == "article" or best.tag == "main"):
                best = x
        elif x.up is found and x.mass >= NEARLY_ALL * total and x.tag in CONTAINERS:
            found = x
    return best or found


def without_lists_of_links(own: list[tuple[Line, bool]]) -> list[tuple[Line, bool]]:
    """The lines but those that are mostly links, unless it is a single link in an element for text."""
    kept = []
    for k, (x, content) in enumerate(own):
        if x.is_link:
            beside = [own[j][0] for j in (k - 1, k + 1) if 0 <= j < len(own)]
            if x.links > 1 or x.at.tag not in TEXT_TAGS or any(y.is_link and y.at.up is x.at.up for y in beside):
                continue
        kept.append((x, content))
    return kept


def extract(html: str | None) -> str:
    """The article's text, one line per block."""
    if not html:
        return ""
    parser = Lines()
    lines = parser.read(html)
    good = [x for x in lines if not x.at.noise]
    if not good:
        return ""
    content = content_lines(lines)
    if not any(c and not x.at.noise for c, x in zip(content, lines, strict=True)):
        content = np.array([not x.at.noise for x in lines])
    held = region(lines, content, parser.elements)
    inside = {held: True}

    def within(at: Element) -> bool:
        path = []
        while at is not None and at not in inside:
            path.append(at)
            at = at.up
        verdict = at is not None and inside[at]
        inside.update(dict.fromkeys(path, verdict))
        return verdict

    own = [(x, c) for x, c in zip(lines, content, strict=True) if not x.at.noise and within(x.at)]
    if held.tag not in ("article", "main"):
        own = without_lists_of_links(own)
        if not any(c for _, c in own):
            return ""
        inner = [k for k, (_, c) in enumerate(own) if c]
        own = [(x, c) for k, (x, c) in enumerate(own) if x.at.tag in TEXT_TAGS or inner[0] <= k <= inner[-1]]
    return "\n".join(x.text for x, _ in own)


def main_text(html: Column) -> Column:
    """struct<text, n_chars> of a column of html."""

    @F.arrow_udf("struct<text:string,n_chars:bigint>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            texts = [extract(x) for x in pages.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["text", "n_chars"])

    return read(html)


def extract_pages(pages: DataFrame, html_col: str = "html", out: str = "main") -> DataFrame:
    """``pages`` with a struct column ``out`` of the main text and its length."""
    prepare(pages.sparkSession)
    return pages.withColumn(out, main_text(F.col(html_col)))


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    found = extract_pages(pages.select("page_id", "url", "html"), out="__main")
    return found.select("page_id", "url", F.col("__main")["text"].alias("text"),
                        F.col("__main")["n_chars"].alias("n_chars"))


ship_by_value(__name__)
