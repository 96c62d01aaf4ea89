"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by their root-to-leaf path of block tags
(inline markup does not count). Per path, text length and punctuation per
node are aggregated, discounted by the share of link text, smoothed over
neighbouring nodes in page order, fused into one score and thresholded: paths
above select content nodes. That a path lies in an article or main element,
or below an element whose class or id says menu, sidebar, notice, advert or
reader comment, is one factor of the score each. The smallest element with
nearly all selected text is the home of the text (the article or main element
around it, if there is one); within it, headings and short paragraphs that a
ratio alone would lose are joined by the selected nodes next to them, outside
of an article blocks of links excepted. Selected nodes elsewhere stay, those of
other articles excepted.

Scripts, styles and controls are never content. Menus, headers, footers, asides
and forms, by their tag, go unless they hold an article or main element or
nearly all of the page's text in sentences: a form may be wrapped around the
page, a menu may lack its end. Elements whose class or id says such a thing go
only if they hold neither an article nor a main element and a minor share of
the page's text, which counts less where the name says nothing else: wrappers
may carry any name. Reader comments are told by their name together with their
structure, however long they are: the name holds nothing but such words, or the
element holds several like blocks.

Pages are parsed one by one inside Arrow tasks; nothing is shuffled.

Defined results: null or empty html, or a page without content, gives empty
text; broken, unclosed or cut-off markup is closed as browsers do; repeated
rows give repeated results; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from sigflow.llm.common import column

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that start and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
# Elements whose text is never content.
NEVER = frozenset(
    "script style noscript template head title button select option textarea input svg math canvas iframe object audio "
    "video map".split()
)
# Elements whose tag says that they are not content, if they don't hold it all.
ASIDES = frozenset("nav footer aside form menu dialog".split())
# Elements that a document's head may hold; any other start tag ends it.
IN_HEAD = frozenset("head html title meta link base script style noscript template".split())
# A main element is in none of these, an article in no menu: an open one lacks its end tag.
NOT_AROUND = {"main": frozenset("nav aside header footer menu".split()), "article": frozenset(["nav", "menu"])}
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
# Words of class and id names that mark an element as not content.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidenav footer masthead topbar comment comments commentlist reply replies disqus "
    "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations widget toolbar pagination pager copyright".split()
)
HEADER_MARKS = frozenset(["header", "head"])
COMMENT_MARKS = frozenset("comment comments commentlist reply replies disqus responses".split())
# Words that go with them in the names of comment sections.
COMMENT_PARTS = frozenset(
    "post article entry page reader readers user users area list section box wrap wrapper container content block body "
    "thread threads item holder count form title text meta author depth even odd parent child children inner outer main "
    "respond the and".split()
)
CONTAINERS = frozenset(["article", "main"])
# A start tag in a row's list closes an open element of that row's name.
CLOSES = {
    "p": BLOCK - {"html", "body"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "option": {"option"},
}
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
SPACE = re.compile(r"\s+")
TAG_START = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ/!?")
SPREAD = 1.0  # of the smoothing over neighbouring nodes
NEARLY_ALL = 0.9
IN_CONTAINER = 2.0  # factor of paths in an article or main element
MARKED = 0.1  # factor of paths below a marked element, and of text below one whose name holds marks alone


class Element:
    """``container``: the outermost article or main element around it, itself included.
    ``mark``: what its class or id says, 0 nothing, 1 among others not content, 2 that alone,
    3 reader comments; ``aside`` what its tag says.
    """

    __slots__ = ("commented", "tag", "parent", "path", "dropped", "mark", "marked", "holds", "container", "text", "inside", "aside")

    def __init__(self, tag: str, parent, path: int, dropped: bool, mark: int = 0):
        self.tag, self.parent, self.path, self.dropped, self.mark = tag, parent, path, dropped, mark
        self.marked = mark > 0 or (parent is not None and parent.marked)
        above = parent.container if parent is not None else None
        self.container = above or (self if tag in CONTAINERS else None)
        self.holds = False  # an article or main element below
        self.text = 0  # selected characters in it and below
        self.inside = False  # of the chosen element
        self.commented = False  # its name speaks of comments among other things
        self.aside = tag in ASIDES or tag == "header" and above is None


class Page(HTMLParser):
    """Blocks of text with their element and link share."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.paths: dict[tuple[int, str], int] = {}
        self.stack = [Element("", None, 0, False)]
        self.elements = list(self.stack)  # parents before children
        self.open: Counter[str] = Counter()
        self.blocks: list[tuple[Element, str, int]] = []  # element, text, characters in links
        self.parts: list[str] = []
        self.linked = self.links = 0

    def _flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.blocks.append((self.stack[-1], text, self.linked))
        self.parts, self.linked = [], 0

    def _unwanted(self, tag: str, attrs: dict, top: Element) -> bool:
        if tag in NEVER:
            return True
        if tag in ("html", "body", *CONTAINERS):
            return False
        return "hidden" in attrs or (attrs.get("role") or "").lower() in ROLES

    def _mark(self, tag: str, attrs: dict, top: Element) -> int:
        if tag in ("html", "body", "header", "main"):
            return 0
        words = set(re.split(r"[^a-z0-9]+", f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower())) - {""}
        if words & COMMENT_MARKS and all(w in COMMENT_MARKS or w in COMMENT_PARTS or w.isdigit() for w in words):
            return 3
        if tag == "article":
            return 0
        marks = words & (MARKS if top.container is not None else MARKS | HEADER_MARKS)
        return 2 if marks and marks == words else int(bool(marks))

    def _pop_to(self, at: int) -> None:
        self._flush()
        self.open.subtract(e.tag for e in self.stack[at:])
        del self.stack[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag == "a":
            self.links += 1
        if tag in VOID and tag != "hr":
            return
        if self.stack[-1].tag == "head" and tag not in IN_HEAD:
            self._pop_to(len(self.stack) - 1)
        around = NOT_AROUND.get(tag)
        if around:
            open_at = next((k for k, e in enumerate(self.stack) if e.tag in around), None)
            if open_at is not None:
                self._pop_to(open_at)
        block = tag in BLOCK or tag in NEVER
        named = dict(attrs) if attrs else {}
        top = self.stack[-1]
        if not block and not (named and (self._unwanted(tag, named, top) or self._mark(tag, named, top))):
            return
        if tag == "hr":
            self._flush()
            return
        while len(self.stack) > 1 and tag in CLOSES.get(self.stack[-1].tag, ()):
            self._pop_to(len(self.stack) - 1)
        self._flush()
        top = self.stack[-1]
        label = f"{tag}.{named['class']}" if named.get("class") else tag
        path = self.paths.setdefault((top.path, label), len(self.paths) + 1)
        dropped = top.dropped or self._unwanted(tag, named, top)
        element = Element(tag, top, path, dropped, self._mark(tag, named, top) if named else 0)
        name = f"{named.get('class') or ''} {named.get('id') or ''}".lower() if named and tag not in ("html", "body", "main") else ""
        element.commented = any(w in COMMENT_MARKS for w in re.split(r"[^a-z0-9]+", name)) if name else False
        self.stack.append(element)
        self.elements.append(element)
        self.open[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if not self.open[tag]:
            return
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                self._pop_to(at)
                return
            if self.stack[at].tag in CONTAINERS and tag not in ("html", "body"):
                return  # a stray end tag does not leave the article

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag == "head" and data.strip():
            self._pop_to(len(self.stack) - 1)
        if not self.stack[-1].dropped:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)

    def finish(self) -> None:
        self.close()
        self._flush()


def add_up(elements: list[Element], blocks: list[tuple[Element, str, int]]) -> int:
    """Sets every element's ``text`` to the characters of ``blocks`` in it and below; returns all of them."""
    for e in elements:
        e.text = 0
    for e, text, _ in blocks:
        e.text += len(text)
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.text += e.text
    return elements[0].text


def _comments(page: Page) -> set[int]:
    """Numbers of the elements that hold reader comments: named so and nothing else, or
    named so among others and holding several like blocks."""
    alike: dict[int, Counter[int]] = {}
    number = {id(e): k for k, e in enumerate(page.elements)}
    for e in page.elements:
        if e.parent is not None and e.tag in ("li", "div", "article", "section"):
            alike.setdefault(number[id(e.parent)], Counter())[e.path] += 1
    out: set[int] = set()
    for k, e in enumerate(page.elements):
        if e.parent is not None and number[id(e.parent)] in out:
            out.add(k)
        elif e.mark == 3 or e.commented and max(alike.get(k, {0: 0}).values()) > 1:
            out.add(k)
    return out


def without_marked(page: Page) -> list[tuple[Element, str, int]]:
    """The page's blocks but those in reader comments, and those below elements that are
    not content by their tag or name: see the module text for when such an element stays."""
    if not any(e.mark or e.aside for e in page.elements):
        return page.blocks
    comments = _comments(page)
    for e in reversed(page.elements):
        e.holds = e.holds or e.tag in CONTAINERS
    for k in range(len(page.elements) - 1, 0, -1):
        e = page.elements[k]
        if k in comments:
            e.dropped, e.holds = True, False
        elif e.holds:
            e.parent.holds = True
    blocks = [b for b in page.blocks if not b[0].dropped]
    sentences: Counter[int] = Counter()
    for e, text, linked in blocks:
        if 2 * linked < len(text) and PUNCTUATION.search(text):
            while e is not None:
                sentences[id(e)] += 1
                e = e.parent
    total = add_up(page.elements, blocks)
    for e in page.elements:  # by the tag
        whole = e.holds or (sentences[id(e)] > 1 and MARKED * e.text >= total - e.text)
        e.dropped = e.dropped or (e.aside and not whole) or (e.parent is not None and e.parent.dropped)
    blocks = [b for b in blocks if not b[0].dropped]
    for mark, weight in ((2, MARKED), (1, 1.0)):  # the clear names first
        total = add_up(page.elements, blocks)
        for e in page.elements:
            minor = e.mark == mark and not e.holds and weight * e.text < total - e.text
            e.dropped = e.dropped or minor or (e.parent is not None and e.parent.dropped)
        left = [b for b in blocks if not b[0].dropped]
        blocks = left or blocks
    return blocks


def path_scores(blocks: list[tuple[Element, str, int]]) -> dict[int, float]:
    """Fused score per path: smoothed text and punctuation per node, less link text."""
    sums: dict[int, list[float]] = {}
    for e, text, linked in blocks:
        s = sums.setdefault(e.path, [0, 0, 0, 0])
        s[0] += len(text)
        s[1] += len(PUNCTUATION.findall(text))
        s[2] += 1
        s[3] += min(linked, len(text))
    per_node = [sums[e.path] for e, _, _ in blocks]
    raw = [(c / n) * (1 - a / c) for c, _, n, a in per_node]
    marks = [1 + p / n for _, p, n, _ in per_node]
    reach = max(1, math.ceil(2 * SPREAD))
    kernel = [math.exp(-0.5 * (k / SPREAD) ** 2) for k in range(-reach, reach + 1)]

    def smooth(x: list[float]) -> list[float]:
        out = []
        for i in range(len(x)):
            total = weight = 0.0
            for k, w in enumerate(kernel, i - reach):
                if 0 <= k < len(x):
                    total, weight = total + w * x[k], weight + w
            out.append(total / weight)
        return out

    fused: dict[int, list[float]] = {}
    for (e, _, _), a, b in zip(blocks, smooth(raw), smooth(marks)):
        feature = (IN_CONTAINER if e.container is not None else 1.0) * (MARKED if e.marked else 1.0)
        fused.setdefault(e.path, []).append(a * b * feature)
    return {p: sum(v) / len(v) for p, v in fused.items()}


def whole_markup(html: str) -> str:
    """The page without a comment or tag that its end cuts off."""
    comment = html.rfind("<!--")
    if comment >= 0 and html.find("-->", comment) < 0:
        html = html[:comment]
    tag = html.rfind("<")
    if tag >= 0 and html.find(">", tag) < 0 and (html[tag + 1 : tag + 2] or "/") in TAG_START:
        html = html[:tag]
    return html


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Page()
    page.feed(whole_markup(html))
    page.finish()
    blocks = without_marked(page)
    if not blocks:
        return ""
    scores = path_scores(blocks)
    mean = sum(scores.values()) / len(scores)
    spread = math.sqrt(sum((v - mean) ** 2 for v in scores.values()) / len(scores))
    line = min(spread, max(scores.values()))
    chosen = [b for b in blocks if scores[b[0].path] >= line]
    total = add_up(page.elements, chosen)
    home = max(chosen, key=lambda c: len(c[1]))[0]
    while home.parent is not None and home.text < NEARLY_ALL * total:
        home = home.parent
    if home.tag in ("p", "li", "td", "th", "dd", "dt", "pre") or home.tag[:1] == "h" and home.tag[1:].isdigit():
        home = home.parent or home
    home = home.container or home
    home.inside = True
    for e in page.elements:
        e.inside = e.inside or (e.parent is not None and e.parent.inside)
    # the home's blocks, and what is selected elsewhere but in other articles
    found = [b for b in blocks if b[0].inside or scores[b[0].path] >= line and b[0].container is None]
    taken = [scores[e.path] >= line for e, _, _ in found]
    plain = [e.container is not None or 2 * linked < len(text) for e, text, linked in found]
    for order in (range(1, len(found)), range(len(found) - 2, -1, -1)):
        step = -1 if order.step > 0 else 1
        for i in order:
            taken[i] = taken[i] or (plain[i] and taken[i + step])
    return "\n".join(text for (_, text, _), t in zip(found, taken) if t)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            text = [main_text(h) for h in part.column(-1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    slim = pages.select(
        column(pages, id_col).cast("long").alias("page_id"), column(pages, url_col).cast("string").alias("url"),
        column(pages, html_col).cast("string").alias("html"),
    )
    return slim.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
