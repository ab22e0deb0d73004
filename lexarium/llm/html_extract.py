"""Main text of web pages: streaming parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering.

The standard library's parser feeds a page once, in events. Text between two block boundaries is a line; its ratio is its length
over its tags. Elements that hold something other than content are taken out first (a veto, never a choice): menus, page headers,
footers, sidebars, notices, adverts, forms, scripts, styles and comments. The ratios of the other lines, smoothed by a Gaussian, are
split at their deviation: lines above are content, and so is a heading with the line under it. The content region of every page,
whatever its tags, is the deepest container with most of the content; it grows by the containers around it as long as what they add
is content rather than not or, inside one article or main, no list of links. All lines of the region are its text, short ones too.
Where the region is the whole page, containers in which no line is content stay out.

What an element is taken out for has a rank (``veto``), whatever its size: no text stays because it is long. An element of low rank
stays only as the wrapper of what a page is about: its articles or mains, else its first headings and elements named for content,
where none of them is outside such elements. Reader comments are never a wrapper. No heading, body or main falls by its class or id (a
paragraph only by the whole name of an advert). A headline before the region is part of the text if the region has none.

Every step is linear in the page: nothing recurses, and the open elements are found by their tags, not by a search.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import attach

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Their text never counts, wherever they are.
SILENT = frozenset("script style noscript template head title svg math canvas object iframe audio video select textarea button datalist option map".split())
OTHER = frozenset("nav footer aside form menu dialog search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id that mark an element as something other than content.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner nav navbar navigation menu topbar breadcrumb breadcrumbs sidebar aside rail footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist respond disqus replies reply share sharing social related recommended recommendations teaser teasers trending popular pagination pager widget toolbar search skip hidden copyright disclaimer".split()
)
#: These mark an element only where it is outside an article.
OUTER = frozenset("header siteheader".split())
REGION = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Whole names by which an article is not a page's text, if others hold more.
ASIDES = frozenset("ad ads advert advertisement sponsored promo promoted teaser teasers comment comments reply related recommended".split())
#: Words that text sections of an article are named for, too.
TOPICS = frozenset("ads advertising promotion banner navigation menu cookie cookies consent gdpr notice notices notification alert newsletter subscription login share sharing social related recommended recommendations trending popular search hidden copyright disclaimer sponsor".split())
PLAIN_P = frozenset("address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Words for reader comments; beside them in a name, the other words that a part of such a list has.
COMMENTS = frozenset("comment comments commentlist respond disqus reply replies".split())
COMMENT_PARTS = frozenset("area author body box container content form item list section template text thread wrap wrapper".split())
#: Words for the layout of a page; a name of several words with one of them may be a wrapper's.
LAYOUT = frozenset("banner footer header masthead menu nav navbar rail sidebar siteheader toolbar topbar widget".split())
#: A name with one of these words says what is around or about an element, not what it is.
ABOUT = frozenset("has with without no category tag type format".split())
STATES = frozenset("open closed enabled disabled on off".split())
#: Words of which the names of content are made.
NAMED = frozenset("article body content entry main post prose story text".split())
WRAPPERS = frozenset(("form", "fieldset"))
#: Class names of paragraphs that are adverts.
ADVERTS = frozenset("ad ads advert advertisement sponsored promo".split())
ROOTS = frozenset(("#page", "html", "body"))
#: What may be a content region, and what may stay out of one that is the whole page.
CONTAINERS = frozenset("body article main section div td center dd blockquote".split())
PARTS = CONTAINERS | frozenset("ul ol dl table".split())
#: What ends the search for the element that an end tag ends, and for an open list item.
FENCES = REGION | {"table", "body"}
LISTS = frozenset(("ul", "ol", "menu"))
_SPLIT = re.compile(r"[^a-z0-9]+")
_CUT = re.compile(r"<[a-zA-Z/!?]")
#: The Gaussian over lines.
SIGMA, REACH = 1.0, 2
KERNEL = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-REACH, REACH + 1)]
#: Share of the content text that a region holds at least.
MOST = 0.7
#: Ranks of what an element is taken out for: a wrapping form or hidden element, a layout's name, a word in a name, a whole name, a
#: tag or role that is no content, and reader comments.
WRAP, PLACE, PART, WHOLE, HARD, READERS = 1, 2, 3, 4, 5, 6


Line = tuple[str, int, int, float]


class Page(HTMLParser):
    """Lines of a page: (text, tags, element, share that is links); elements, parents before children: tag, parent, ranks of tag and of names."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.tags: list[str] = ["#page"]
        self.parent: list[int] = [-1]
        self.other: list[int] = [0]
        self.marks: list[int] = [0]
        self.topic: set[int] = set()
        self.named: set[int] = set()
        self.open: list[int] = [0]
        #: Places in the stack of open elements, last one last: by tag, and of what ends the search for a tag.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.lists: list[int] = []
        self.fences: list[int] = []
        self.regions = 0
        self.silent = 0
        self.text: list[str] = []
        self.n_tags = 0
        self.linked = 0

    def flush(self) -> None:
        if self.text:
            whole = "".join(self.text)
            if words := whole.split():
                self.lines.append((" ".join(words), self.n_tags, self.open[-1], self.linked / len(whole)))
            self.text.clear()
        self.n_tags = self.linked = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.silent and tag in SILENT and tag not in VOID:
            self._push(tag)
            self.silent += 1
            return
        if tag in BLOCK:
            self.flush()
            if tag in PLAIN_P:
                self._close("p", self.blocks)
            elif tag == "li":
                self._close("li", self.lists)
        self.n_tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        if tag in SILENT:
            self.silent += 1
            self._push(tag)
        elif tag in BLOCK or attrs:
            self._push(tag, self._is_other(tag, attrs), self._mark(tag, attrs))
        else:
            self._push(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "path"):
            self.handle_endtag(tag)

    def _kept(self, tag: str) -> list[list[int]]:
        """The lists of places that an open element of this tag is in."""
        out = [self.places.setdefault(tag, [])]
        if tag in BLOCK and tag != "p":
            out.append(self.blocks)
        if tag in LISTS:
            out.append(self.lists)
        if tag in FENCES:
            out.append(self.fences)
        return out

    def _push(self, tag: str, other: int = 0, mark: tuple[int, bool, bool] = (0, False, False)) -> None:
        self.tags.append(tag)
        self.parent.append(self.open[-1])
        self.other.append(other)
        self.marks.append(mark[0])
        if mark[1]:
            self.topic.add(len(self.tags) - 1)
        if mark[2]:
            self.named.add(len(self.tags) - 1)
        for places in self._kept(tag):
            places.append(len(self.open))
        self.regions += tag in REGION
        self.open.append(len(self.tags) - 1)

    def _pop(self, k: int) -> None:
        while len(self.open) > k:
            tag = self.tags[self.open.pop()]
            for places in self._kept(tag):
                places.pop()
            self.regions -= tag in REGION
            self.silent -= tag in SILENT

    def _close(self, tag: str, fences: list[int]) -> None:
        """Ends the open element of this tag, and those in it, if no fence is inside it."""
        places = self.places.get(tag)
        if places and (not fences or fences[-1] <= places[-1]):
            self._pop(places[-1])

    def _is_other(self, tag: str, attrs: list) -> int:
        """The rank for tag, role and being hidden."""
        rank = WRAP if tag in WRAPPERS else HARD if tag in OTHER or tag == "header" and not self.regions else 0
        for name, value in attrs:
            value = (value or "").lower()
            if name == "role" and value.strip() in ROLES:
                rank = max(rank, WRAP if value.strip() == "form" else HARD)
            elif name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                rank = max(rank, WRAP)
        return rank

    def _mark(self, tag: str, attrs: list) -> tuple[int, bool, bool]:
        """The rank for class and id, whether it may be the topic of a text section of an article, and whether it is named for content."""
        if tag in HEADINGS or tag in ("html", "body", "main"):
            return 0, False, False
        if tag == "p":
            return (WHOLE if any(name == "class" and value and not ADVERTS.isdisjoint(value.lower().split()) for name, value in attrs) else 0), False, False
        inside = self.regions > 0
        rank, topic, named = 0, False, False
        for key, name in ((key, x) for key, value in attrs if key in ("class", "id") and value for x in value.lower().split()):
            words = [w for w in _SPLIT.split(name) if w]
            if not words or not ABOUT.isdisjoint(words[:-1]) or words[-1] in STATES:
                continue
            named = named or NAMED.issuperset(words)
            rest = [w for w in words if w not in COMMENTS]
            if len(rest) < len(words) and (not rest or words[-1] in COMMENTS or all(w in COMMENT_PARTS or w.isdigit() for w in rest)):
                rank = READERS
            elif tag == "article":
                rank = max(rank, PART if len(words) == 1 and words[0] in ASIDES else 0)
            elif len(words) == 1:
                if words[0] in MARKS or not inside and words[0] in OUTER:
                    rank = max(rank, WHOLE)
                    topic = topic or key == "id" and words[0] in TOPICS
            # in an article the last word says what a thing is: related-work is no box of related pages
            elif hits := [w for w in (words[-1:] if inside else words) if w in MARKS or not inside and w in OUTER]:
                rank = max(rank, PLACE if LAYOUT.issuperset(hits) else PART)
        if rank == PLACE and named:
            rank = 0
        return rank, topic and rank == WHOLE and inside and tag == "section", named and not rank

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        self.n_tags += 1
        if tag not in VOID:
            self._close(tag, [] if tag in FENCES or tag == "html" else self.fences)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data)
            self.linked += len(data) if self.places.get("a") else 0

    def close(self) -> None:
        at = self.rawdata.rfind("<")
        if at >= 0 and ">" not in self.rawdata[at:] and not self.silent and _CUT.match(self.rawdata, at):
            self.rawdata = self.rawdata[:at]  # the page ends inside a tag
        super().close()
        self.flush()


def content_lines(lines: list[tuple[str, int]]) -> list[bool]:
    """Which lines are content: (text, tags), by smoothed ratio against the ratios' deviation."""
    ratios = [len(text) / max(1, tags) for text, tags in lines]
    n = len(ratios)
    if not n:
        return []
    mean = sum(ratios) / n
    cut = math.sqrt(sum((r - mean) ** 2 for r in ratios) / n)
    smooth = []
    for i in range(n):
        a, b = max(0, i - REACH), min(n, i + REACH + 1)
        w = KERNEL[a - i + REACH : b - i + REACH]
        smooth.append(sum(x * y for x, y in zip(ratios[a:b], w, strict=True)) / sum(w))
    return [s >= cut for s in smooth]


def _content(page: Page, lines: list[Line]) -> list[bool]:
    """Which lines are content: by their ratios, a heading with the line under it; all, if none is."""
    good = content_lines([x[:2] for x in lines])
    if not any(good):
        return [True] * len(lines)
    for i in range(len(lines) - 2, -1, -1):
        if page.tags[lines[i][2]] in HEADINGS and good[i + 1]:
            good[i] = True
    return good


def _held(page: Page, lines: list[Line], flags: list[float]) -> list[float]:
    """For each element the characters of its lines, each times its flag."""
    out = [0] * len(page.tags)
    for (text, _, at, _), flag in zip(lines, flags, strict=True):
        out[at] += flag * len(text)
    for k in range(len(out) - 1, 0, -1):
        out[page.parent[k]] += out[k]
    return out


def _within(page: Page, out: list[bool]) -> list[bool]:
    """Whether each element is one of those, or inside one."""
    within = list(out)
    for k in range(1, len(within)):
        within[k] = within[k] or within[page.parent[k]]
    return within


def _free(page: Page, rank: list[int], cores: list[int]) -> list[bool]:
    """The elements that have a rank, but those around a core."""
    around = set()
    for k in cores:
        while k >= 0 and k not in around:
            around.add(k)
            k = page.parent[k]
    return [x > 0 and k not in around for k, x in enumerate(rank)]


def veto(page: Page) -> tuple[list[bool], list[Line]]:
    """Which elements are something other than content, and the lines outside them.

    Elements with a rank go. Cores are articles and mains up to WHOLE, else first headings and elements named for content up to PLACE:
    of those with text the ones whose elements around them have the least rank. Where that isn't none, what is around them stays. If
    nothing else is left, articles and mains inside a tag that is no content stay (as of a menu without its end), then layout names.
    """
    rank = [max(x) for x in zip(page.other, page.marks, strict=True)]
    if page.topic:
        held, own = _held(page, page.lines, _content(page, page.lines)), _held(page, page.lines, [True] * len(page.lines))
        for k in page.topic:
            if page.other[k] == 0 and 2 * held[k] > own[k]:
                rank[k] = 0
    size = _held(page, page.lines, [True] * len(page.lines))
    path = list(rank)
    for k in range(1, len(path)):
        path[k] = max(path[k], path[page.parent[k]])
    regions = [k for k, tag in enumerate(page.tags) if size[k] and tag in REGION and not rank[k]]
    heads = [k for k, tag in enumerate(page.tags) if size[k] and (tag == "h1" or k in page.named)]

    def least(cores: list[int], most: int) -> list[int]:
        known = [path[k] for k in cores if path[k] <= most]
        return [k for k in cores if path[k] == min(known)] if known else []

    def outside(gone: list[bool]) -> tuple[list[bool], list[Line]]:
        within = _within(page, gone)
        return gone, [x for x in page.lines if not within[x[2]]]

    gone, lines = outside(_free(page, rank, least(regions, WHOLE) or least(heads, PLACE)))
    if not lines:
        gone, lines = outside(_free(page, rank, least(regions, HARD)))
    if not lines:
        gone, lines = outside([x > PLACE or x == WRAP for x in rank])
    return gone, lines


def region(page: Page, gone: list[bool], lines: list[Line], good: list[bool]) -> int:
    """The deepest container with MOST of the content, grown by those around it that add more content than other text or, up to the article or main that it is in, text that isn't mostly links."""
    held, rest, links = _held(page, lines, good), _held(page, lines, [not x for x in good]), _held(page, lines, [x[3] for x in lines])
    at = 0
    for k in range(1, len(page.tags)):  # parents come first: of the containers with most of the content the last is the deepest
        if page.tags[k] in CONTAINERS and held[k] >= MOST * held[0] and held[k]:
            at = k
    own = at
    while own > 0 and page.tags[own] not in REGION:
        own = page.parent[own]
    k = page.parent[at]
    while k > 0 and page.tags[k] not in ROOTS and not gone[k] and page.marks[k] < WHOLE and page.other[k] < HARD:
        more, other = held[k] - held[at], rest[k] - rest[at]
        if more > 0 and more >= other or k >= own > 0 and more + other > 0 and 2 * (links[k] - links[at]) < more + other:
            at = k
        k = page.parent[k]
    return at


def headline(page: Page, lines: list[Line], inside: list[bool]) -> set[int]:
    """The lines of the last h1 before a region that has none, and of what is between them in the h1's own element, but links."""
    at = [i for i, x in enumerate(lines) if inside[x[2]]]
    if not at or any(page.tags[lines[i][2]] == "h1" for i in at):
        return set()
    first = next((i for i in range(at[0] - 1, -1, -1) if page.tags[lines[i][2]] == "h1"), None)
    if first is None:
        return set()
    up = page.parent[lines[first][2]]
    return {i for i in range(first, at[0]) if page.parent[lines[i][2]] == up and 2 * lines[i][3] < 1}


def extract(html: str | None) -> str:
    """The main text: one line a block; empty for a null, an empty page or a page without content."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    page.close()
    gone, lines = veto(page)
    good = _content(page, lines)
    at = region(page, gone, lines, good)
    held = _held(page, lines, good)
    whole = page.tags[at] in ROOTS
    inside = [False] * len(page.tags)
    for k in range(at, len(page.tags)):
        inside[k] = k == at or k > 0 and inside[page.parent[k]] and not (whole and not held[k] and page.tags[k] in PARTS)
    before = headline(page, lines, inside)
    return "\n".join(x[0] for i, x in enumerate(lines) if inside[x[2]] or i in before)


def with_main_text(pages: DataFrame, html: str = "html", name: str = "text", keep: list[str] | None = None) -> DataFrame:
    """pages with the main text of each page's whole html; a column of that name, in any case, is replaced.

    A null or empty page, and one without text outside vetoed elements, has the empty text. Equal pages have equal texts; rows are
    judged each for itself, so repeated rows and ids stay. A page of any length or depth takes time in proportion to its length. An
    empty table gives an empty result. Other columns stay as they are.
    """

    def texts(column: pa.Array) -> dict[str, pa.Array]:
        return {name: pa.array([extract(x.as_py()) for x in column], pa.string())}

    return attach(pages, html, texts, T.StructType([T.StructField(name, T.StringType())]), keep)
