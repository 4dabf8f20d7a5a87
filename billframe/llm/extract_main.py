"""Main-text extraction from HTML by smoothed text-to-tag ratios.

The standard library's streaming parser turns a page into lines: one for each
block of text, with the number of tags that occur in it, the characters that
are link text, and the chain of containers it lies in. Lines within menus,
headers, footers, sidebars, notices, adverts, forms or reader comments -
known by element, role or the words of class and id - carry no content.

Every line's ratio is its characters outside links over its tags. The ratios
are smoothed by a Gaussian along the page and clustered in two by a threshold
(iterated class means); lines that reach it, smoothed or by themselves, and are
not mostly links, are the core. The
content region is the container that holds most of the core - if there are
article or main elements, all outermost ones that hold some of it. Lines of the region stay if they lie between
core lines, or in a part of it that holds some, so short paragraphs are kept;
what is mostly links at its ends is not.

Formulas are read like inline text, without their annotations; a math element
counts as one tag, whatever is in it.

White space inside a block becomes one space, blocks are joined by one newline
in page order, character references are decoded.

Edge cases: NULL, empty and text-free pages give the empty text; pages without
tags are one line; unclosed and stray tags are tolerated (an end tag closes
everything opened inside it); if all blocks are equally short, all are core; a
page of nothing but links has no main text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import map_texts

# Fixed sets: HTML element names by role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article aside body center details div fieldset main section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset(
    "script style noscript template svg annotation annotation-xml head title iframe object audio video canvas select "
    "textarea button datalist map".split()
)
BOILERPLATE = frozenset("nav header footer aside form menu dialog search fieldset".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar alert alertdialog dialog status tablist".split()
)
#: Words of class and id attributes (split at non-letters and capitals) that name boilerplate.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit sponsor sponsored "
    "sponsors promo promos promotion promoted banner banners cookie cookies consent gdpr notice notices notification "
    "notifications alert popup popups modal overlay interstitial newsletter subscribe subscription signup signin login "
    "register paywall sidebar sidebars sidenav rail widget widgets related recommended recommendations share shares "
    "sharing social follow comment comments commentlist respond reply replies disqus discussion breadcrumb breadcrumbs "
    "crumbs pagination pager menu menus menubar nav navbar navigation navi topnav subnav toc topbar toolbar masthead "
    "header footer foot copyright legal disclaimer form search searchbox searchform tags tagcloud skip hidden".split()
)
#: Elements whose class never makes them boilerplate: the page itself.
ROOTS = frozenset("html body article main".split())
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")


def boilerplate(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """How an element's own kind, role or name marks its contents as no content.

    "sure": always; "name": unless it turns out to hold most of the page's text; "": not.
    """
    if tag in BOILERPLATE:
        return "name" if tag in ("form", "fieldset") else "sure"
    for key, value in attrs:
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return "sure"
        if not value:
            continue
        if key == "role" and value.strip().lower() in ROLES:
            return "sure"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return "sure"
        if key in ("class", "id") and tag not in ("html", "body", "main"):
            found = {w.lower() for w in _NAME.findall(value)}
            if found & COMMENT_NAMES:
                return "sure"
            if tag != "article" and found & NAMES:
                return "name"
    return ""


#: These mark any element for sure; on an article element the other words describe the article.
COMMENT_NAMES = frozenset("ad ads advert sponsored promo comment comments reply replies respond related teaser".split())


class Lines(HTMLParser):
    """Collects (text, tags, link characters, container chain, marks) of every block outside sure boilerplate."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, tuple, tuple]] = []
        self.stack: list[tuple[str, bool, str]] = []  # tag, unread, boilerplate
        self.marks: list[int] = []  # open elements marked by name
        self.chain: list[tuple[int, str]] = []  # open containers: number, tag
        self.unread = self.plain = self.links = self.seen = self.math = 0
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text and not self.plain:
                self.lines.append((text, self.tags, self.linked, tuple(self.chain), tuple(self.marks)))
            self.parts = []
            self.tags = self.linked = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            if tag == "p" or tag == "li":
                self._close_open(tag)
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += not self.math
        if tag in VOID:
            return
        unread, plain = tag in UNREAD, boilerplate(tag, attrs)
        self.stack.append((tag, unread, plain))
        self.unread += unread
        self.plain += plain == "sure"
        self.links += tag == "a"
        self.math += tag == "math"
        self.seen += 1
        if plain == "name":
            self.marks.append(self.seen)
        if tag in CONTAINERS:
            self.chain.append((self.seen, tag))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close_open(self, tag: str) -> None:
        """A paragraph or list item ends an open one of its kind, unless a container lies between."""
        for name, _, _ in reversed(self.stack):
            if name == tag:
                self.handle_endtag(tag)
                return
            if name in CONTAINERS or name in ("ul", "ol", "table", "blockquote", "nav", "header", "footer", "form"):
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += not self.math
        if not any(name == tag for name, _, _ in reversed(self.stack)):
            return
        while True:
            name, unread, plain = self.stack.pop()
            if name in BLOCKS:
                self.flush()
            self.unread -= unread
            self.plain -= plain == "sure"
            if plain == "name":
                self.marks.pop()
            self.links -= name == "a"
            self.math -= name == "math"
            if name in CONTAINERS:
                self.chain.pop()
            if name == tag:
                return

    def unmarked(self, share: float = 0.5) -> list[tuple[str, int, int, tuple]]:
        """The lines outside elements marked by name; a mark on most of the page's text is void."""
        held: dict[int, int] = {}
        for text, _, linked, _, marks in self.lines:
            for m in marks:
                held[m] = held.get(m, 0) + len(text) - linked
        whole = sum(len(x[0]) - x[2] for x in self.lines)
        void = {m for m, n in held.items() if n >= share * whole}
        return [x[:4] for x in self.lines if void.issuperset(x[4])]

    def handle_data(self, data: str) -> None:
        if self.unread:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """The ratios under a Gaussian of ``sigma`` lines, weights renewed at the ends."""
    reach = int(np.ceil(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    middle = slice(reach, reach + len(ratios))
    return np.convolve(ratios, weights)[middle] / np.convolve(np.ones(len(ratios)), weights)[middle]


def split_level(values: np.ndarray) -> float:
    """The threshold between two clusters: the mean of the class means, iterated."""
    level = float(values.mean())
    for _ in range(50):
        high, low = values[values > level], values[values <= level]
        if not len(high) or not len(low):
            break
        after = (float(high.mean()) + float(low.mean())) / 2
        if abs(after - level) < 1e-9:
            break
        level = after
    return level


def main_text(html: str, sigma: float = 1.0, most_links: float = 0.5, share: float = 0.8) -> str:
    """The main text of one page."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.unmarked()
    if not lines:
        return ""
    free = np.array([max(0, len(t) - linked) for t, _, linked, _ in lines], dtype=np.float64)
    size = np.array([len(t) for t, _, _, _ in lines], dtype=np.float64)
    prose = free >= (1 - most_links) * size
    ratios = free / np.maximum(1, [tags for _, tags, _, _ in lines])
    even = smoothed(ratios, sigma)
    core = prose & (np.maximum(even, ratios) >= split_level(even))
    if not core.any():
        core = prose
    if not core.any():
        return ""
    chains = [chain for _, _, _, chain in lines]
    regions, named = _regions(chains, core, free, share)
    inside = np.array([None in regions or any(n in regions for n, _ in c) for c in chains])
    at = np.flatnonzero((prose if named else core) & inside)
    if not len(at):
        return ""
    with_core = {n for i in at for n, _ in chains[i]}
    kept = []
    for i, (text, _, _, chain) in enumerate(lines):
        if not inside[i]:
            continue
        own = chain[-1][0] if chain else None
        between = at[0] <= i <= at[-1]
        if between or prose[i] and (named or own in regions or own in with_core):
            kept.append(text)
    return "\n".join(kept)


def _regions(chains: list[tuple], core: np.ndarray, free: np.ndarray, share: float) -> tuple[set[int | None], bool]:
    """The containers that hold the core, and whether they are article or main elements.

    All outermost article and main elements with core lines are regions: an
    article may be split over several. Without any, it is the last container
    from the page inwards that holds ``share`` of the core's characters; None
    is the page.
    """
    named = {
        next(n for n, tag in chains[i] if tag in ("article", "main"))
        for i in np.flatnonzero(core)
        if any(tag in ("article", "main") for _, tag in chains[i])
    }
    if named:
        return named, True
    whole = float(free[core].sum()) or 1.0
    region, depth = None, 0
    while True:
        held: dict[int, float] = {}
        for i in np.flatnonzero(core):
            if len(chains[i]) > depth and (region is None or depth and chains[i][depth - 1][0] == region):
                n = chains[i][depth][0]
                held[n] = held.get(n, 0.0) + float(free[i])
        best = max(held, key=held.get, default=None)
        if best is None or held[best] < share * whole:
            return {region}, False
        region, depth = best, depth + 1


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """page_id, url, text of every page."""
    keyed = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )

    def make():
        return lambda raw: [[main_text(x.decode("utf-8")) for x in raw]]

    fields = [T.StructField("main", T.StringType(), False)]
    return map_texts(keyed, make, fields, carry=["page_id", "url"]).withColumnRenamed("main", "text")
