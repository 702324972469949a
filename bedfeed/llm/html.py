"""Main text of web pages by the ratios of tag paths.

A page is a list of text nodes, each below a path of tags from the root. Templates write all paragraphs of an article
under one path, so figures are summed up by path: characters and punctuation marks per node. Both are smoothed over
the paths in page order, fused by their product, and compared with a threshold that the spread of the page's own paths
sets. Paths above it are content; so are headings, lists and other blocks between them and behind them under the same
parent, and the short blocks of an article that has such a path. Markup that names its purpose weighs in: scripts,
footers, controls and the like count nothing, paths outside of article and main elements count less the more of the text
these hold, and so do forms, asides and elements whose class, id or role has a word for what is beside the text, unless
they hold most of it. Readers' comments and teasers never do.

Work and memory grow with the length of a page, however its tags are nested or broken: elements and paths are numbers
with links to their parents, and the end of a tag is looked for once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bedfeed.llm.common import blocks

# Elements of HTML by what they mean for the main text.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
DROPPED = {
    "head", "script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio", "video", "nav", "footer",
    "button", "select", "option", "input", "textarea", "label", "title", "xmp", "noembed", "noframes",
}
# Elements that are beside the text by what they are; a form may also be the frame of the whole page.
FRAMES = {"form", "fieldset"}
ASIDES = {"aside", "menu", "dialog"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "menu", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "caption", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words in a class, an id or a role that say what an element is for.
SIDE_WORDS = (
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations sidebar "
    "side menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments reply replies responses discussion "
    "disqus widget toolbar pagination pager search login complementary contentinfo dialog form"
).split()
_SIDE = set(SIDE_WORDS)
# Of these, words that may also name a frame around the article, which an article or main element inside then shows.
_FRAME = set("sidebar side header menu nav widget banner modal overlay form".split())
# And words that hold for an article element as well: it may be a reader's comment or a teaser.
_OTHER_ARTICLE = set("ad ads advert advertisement sponsored promo related recommended comment comments reply replies responses discussion disqus".split())
# A class that begins like this tells what a page has, not what the element is.
_HAVING = {"has", "with", "no", "without", "is", "hide", "show", "category", "tag", "layout"}
# And one that ends like this tells what state it is in.
_STATE = {"open", "opened", "closed", "enabled", "disabled", "allowed", "on", "off"}
# Closing these needs no tag: a new one, or one of the others, ends the one that is open.
CLOSED_BY = {
    "p": {"p"} | (BLOCKS - {"html", "body"}), "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"},
}

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|aria-hidden|hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I | re.S)
_WORD = re.compile(r"[A-Za-z]+")
_MARKS = re.compile(r"[.,;:!?…、。，！？]")


# A path is content from this share of the page's highest ratio on, or from the spread of all ratios.
SHARE = 0.2
# Where a page has article or main elements, the ratios of paths outside count by this factor, and by more if these
# elements hold less than half of the text.
OUTSIDE = 0.15
# From this share of the text on, paths in article and main elements are only compared with each other.
HELD = 0.2
# The factor for an element that is beside the text by its words.
SIDE = 0.02
# An element is not beside the text if it holds most of it, and an article, a main or an h1 element or all but this share.
REST = 0.1
# What goes on with the text behind the last hit right in the body.
TEXT_BLOCKS = {"p", "ul", "ol", "dl", "table", "pre", "blockquote", "figure"} | HEADINGS


# What an element is beside the text for: nothing, a word or tag that a frame of the article may have as well, one that it
# may not, one of readers' comments and teasers; and what never is main text.
PLAIN, FRAME, BESIDE, OTHER, NEVER = range(5)


@dataclass
class Node:
    """A block of text: the numbers of its path, its innermost element and its innermost side, and what it is in."""

    path: int
    element: int
    side: int
    text: str
    main: bool
    article: int


class Page:
    """The blocks of a page, and the paths, elements and sides they lie in; number 0 stands for none.

    A path is the tags from the root, an element one place of the page, and a side an element beside the text. Each has
    its tag or kind and a link to what it lies in, whose number is smaller.
    """

    def __init__(self) -> None:
        self.nodes: list[Node] = []
        self.path_tag, self.path_up, self.path_h1 = [""], [0], [False]
        self.tag, self.up = [""], [0]
        self.side_kind, self.side_up, self.side_strict = [PLAIN], [0], [0]
        self._known: dict[tuple[int, str], int] = {}

    def path(self, up: int, tag: str) -> int:
        found = self._known.get((up, tag))
        if found is None:
            found = self._known[up, tag] = len(self.path_tag)
            self.path_tag.append(tag)
            self.path_up.append(up)
            self.path_h1.append(tag == "h1" or self.path_h1[up])
        return found

    def element(self, up: int, tag: str) -> int:
        self.tag.append(tag)
        self.up.append(up)
        return len(self.tag) - 1

    def side(self, up: int, kind: int) -> int:
        """A new side; ``side_strict`` is the same chain without its frames."""
        number = len(self.side_kind)
        self.side_kind.append(kind)
        self.side_up.append(up)
        strict = self.side_strict[up]
        if kind == FRAME:
            self.side_strict.append(strict)
        elif strict == up:
            self.side_strict.append(number)
        else:
            self.side_strict.append(number + 1)
            self.side_kind.append(kind)
            self.side_up.append(strict)
            self.side_strict.append(number + 1)
        return number


def _side(name: str, attributes: str, main: bool) -> int:
    """What an element is beside the text for, by its tag and its words."""
    if name in DROPPED or (name == "header" and not main):
        return NEVER
    kind = FRAME if name in FRAMES else BESIDE if name in ASIDES else PLAIN
    if name in ("html", "body", "main") or not attributes:
        return kind
    found: set[str] = set()
    for key, *values in _NAMES.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return NEVER
        if key in ("class", "id", "role"):
            for token in value.split():
                words = _WORD.findall(token)
                if words and words[0] not in _HAVING and (len(words) == 1 or words[-1] not in _STATE):
                    found.update(words)
    found &= _OTHER_ARTICLE if name == "article" or name in HEADINGS else _SIDE
    if main:
        found.discard("header")  # of the article
    words = PLAIN if not found else OTHER if found & _OTHER_ARTICLE else FRAME if found <= _FRAME else BESIDE
    return max(kind, words)


@dataclass
class _Open:
    tag: str
    never: bool
    main: bool
    block: bool
    path: int
    element: int
    side: int
    article: int


# What the end of an element without a tag is looked for under.
_WALLS = {"ul", "ol", "table", "dl", "div", "td", "th", "article", "section", "body", "blockquote"}
_CLOSES: dict[str, list[str]] = {}
for _tag, _by in CLOSED_BY.items():
    for _name in _by:
        _CLOSES.setdefault(_name, []).append(_tag)


def page_of(html: str) -> Page:
    """The blocks of text of a page in order; what never is main text is left out."""
    page = Page()
    root = _Open("", False, False, False, 0, 0, 0, 0)
    stack = [root]
    opened: dict[str, int] = {}
    parts: list[tuple[str, int]] = []  # text, and its innermost side

    def add(text: str) -> None:
        if not stack[-1].never:
            parts.append((text, stack[-1].side))

    def flush() -> None:
        if parts:
            # What is beside the text within a line is a block of its own.
            by_side: dict[int, list[str]] = {}
            for text, side in parts:
                by_side.setdefault(side, []).append(text)
            top = stack[-1]
            for side, texts in by_side.items():
                text = " ".join(unescape("".join(texts)).split())
                if text:
                    page.nodes.append(Node(top.path, top.element, side, text, top.main, top.article))
            parts.clear()

    def close(n: int) -> None:
        if any(x.block for x in stack[n:]):
            flush()
        for x in stack[n:]:
            opened[x.tag] -= 1
        del stack[n:]

    last, quotes = html.rfind(">"), True

    def tag_end(at: int) -> int:
        """The place of the ``>`` that ends a tag, -1 if none does. Where a quote leaves no end, quotes mean nothing from
        there on, so no stretch of the page is searched in vain twice."""
        nonlocal quotes
        while quotes and at <= last:
            found = _STOP.search(html, at)
            if found[0] == ">":
                return found.start()
            behind = html.find(found[0], found.end())
            if behind < 0:
                quotes = False
            at = behind + 1 if behind >= 0 else at
        if quotes:
            quotes = last < start
        return html.find(">", start) if last >= start else -1

    at, raw = 0, None
    while at < len(html):
        if raw:
            end = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(html, at)
            at, raw = (end.start() if end else len(html)), None
            continue
        if html[at] != "<":
            end = html.find("<", at)
            end = len(html) if end < 0 else end
            add(html[at:end])
            at = end
            continue
        if html.startswith("<!--", at) or html.startswith("<![CDATA[", at):
            mark = "-->" if html[at + 2] == "-" else "]]>"
            end = html.find(mark, at + 4)
            at = len(html) if end < 0 else end + len(mark)
            continue
        found = _TAG.match(html, at)
        start = found.end() if found else at + 1
        end = -1
        if found:
            end = tag_end(start)
        elif html[at + 1 : at + 2] in ("!", "?") and last > at:
            end = html.find(">", at)
            if end >= 0:
                at = end + 1
                continue
        if end < 0:  # a tag that is never closed is text
            add("<")
            at += 1
            continue
        name, attributes = found[2].lower(), html[start:end]
        at = end + 1
        if found[1]:
            if opened.get(name):
                for n in range(len(stack) - 1, 0, -1):
                    if stack[n].tag == name:
                        close(n)
                        break
                    if stack[n].tag in ("td", "th", "table") and name not in ("table", "tr", "tbody", "thead", "tfoot", "div", "body", "html", "article", "main", "section"):
                        break
            elif name in BLOCKS:
                flush()
            continue
        if name in VOID:
            if name in ("br", "hr") and not stack[-1].never:
                if name == "hr":
                    flush()
                else:
                    add(" ")
            continue
        if any(opened.get(x) for x in _CLOSES.get(name, ())):
            for n in range(len(stack) - 1, 0, -1):
                if name in CLOSED_BY.get(stack[n].tag, ()):
                    close(n)
                    break
                if stack[n].tag in _WALLS:
                    break
        block = name in BLOCKS or name in DROPPED - {"button", "label", "select", "option", "input", "math"}
        if block:
            flush()
        top = stack[-1]
        main, chain = top.main, top.side
        opens = name in ("article", "main") or ("role" in attributes and re.search(r"role\s*=\s*[\"']?main", attributes) is not None) or "articleBody" in attributes
        if opens and not main:
            chain = page.side_strict[chain]
        main = main or opens
        kind = _side(name, attributes, main)
        element = page.element(top.element, name)
        if kind in (FRAME, BESIDE, OTHER):
            chain = page.side(chain, kind)
        if not attributes.rstrip().endswith("/") or name not in ("svg", "math", "path", "g", "use", "circle", "rect", "line", "polygon"):
            stack.append(_Open(name, top.never or kind == NEVER, main, block, page.path(top.path, name), element, chain, element if name == "article" else top.article))
            opened[name] = opened.get(name, 0) + 1
            if name in RAW:
                raw = name
    flush()
    return page


def smoothed(values: np.ndarray) -> np.ndarray:
    """Weighted means of neighbours, by a short bell curve."""
    if len(values) < 3:
        return values
    bell = np.array([0.25, 0.5, 0.25])
    padded = np.concatenate([values[:1], values, values[-1:]])
    return np.convolve(padded, bell, "valid")


def _beside(page: Page) -> list[bool]:
    """Which nodes are beside the text: those in a side that does not hold most of the text itself.

    A side does if it has more than half of the text, and an article, a main or an h1 element or nearly all of the text.
    Readers' comments and teasers are sides unless they have more than half of the text and an h1 element.
    """
    sides = len(page.side_kind)
    held, titled, headed = [0] * sides, [False] * sides, [False] * sides
    total = 0
    for n in page.nodes:
        total += len(n.text)
        held[n.side] += len(n.text)
        h1 = page.path_h1[n.path]
        headed[n.side] |= h1
        titled[n.side] |= n.main or h1
    for i in range(sides - 1, 0, -1):
        up = page.side_up[i]
        held[up] += held[i]
        titled[up] |= titled[i]
        headed[up] |= headed[i]
    out = [False] * sides
    for i in range(1, sides):
        most = 2 * held[i] > total and (headed[i] if page.side_kind[i] == OTHER else titled[i] or total - held[i] < REST * total)
        out[i] = not most or out[page.side_up[i]]
    return [out[n.side] for n in page.nodes]


def content(page: Page) -> list[Node]:
    """The nodes whose paths are content, and what belongs to them."""
    nodes = page.nodes
    if not nodes:
        return []
    beside = _beside(page)
    keys = [(n.path, n.main, b) for n, b in zip(nodes, beside, strict=True)]
    paths = list(dict.fromkeys(keys))
    place = {p: i for i, p in enumerate(paths)}
    chars, marks, count = (np.zeros(len(paths)) for _ in range(3))
    for n, key in zip(nodes, keys, strict=True):
        i = place[key]
        chars[i] += len(n.text)
        marks[i] += len(_MARKS.findall(n.text))
        count[i] += 1
    main, side = np.array([p[1] for p in paths]), np.array([p[2] for p in paths])
    fused, least = path_ratios(chars, marks, count, main, side)
    hits = [i for i, key in enumerate(keys) if fused[place[key]] >= least[place[key]]]
    good, kept = set(hits), set(hits)
    parents = {page.path_up[nodes[i].path] for i in hits if not beside[i]}
    # Elements are known by their number, as others may have the same path.
    holders = {page.up[nodes[i].element] for i in hits if not beside[i]}
    whole = {nodes[i].article for i in hits if not beside[i]} - {0}  # articles with a hit
    # From the root down: paths below a parent of hits, and elements that go on with what holds a hit; right in the body
    # only what is no frame does.
    below, goes_on = [p in parents for p in range(len(page.path_tag))], [False] * len(page.tag)
    for i in range(1, len(below)):
        below[i] = below[i] or below[page.path_up[i]]
    for i in range(1, len(goes_on)):
        up = page.up[i]
        in_body = up in holders and page.tag[up] in ("", "html", "body") and page.tag[i] in TEXT_BLOCKS
        goes_on[i] = goes_on[up] or in_body or (i in holders and page.tag[i] not in ("html", "body"))

    def heading(n: Node) -> bool:
        return page.path_tag[n.path] in HEADINGS

    first, last = hits[0], hits[-1]
    while first and not beside[first - 1] and heading(nodes[first - 1]) and page.path_up[nodes[first - 1].path] in parents:
        first -= 1
    # In a main element the text begins with its first heading.
    titles = [i for i in range(first) if nodes[i].main and nodes[hits[0]].main and not beside[i] and heading(nodes[i])]
    first = titles[0] if titles else first
    for i, n in enumerate(nodes):
        if beside[i] or i in good:
            continue
        if first <= i <= last:
            if (n.main and nodes[hits[0]].main) or below[n.path]:
                kept.add(i)
        elif (i > last or n.main) and goes_on[n.element]:
            kept.add(i)
        if n.article in whole:
            kept.add(i)
    # An article inside that has no hit of its own is no part of the text around it.
    return [n for i, n in enumerate(nodes) if i in good or (i in kept and (not n.article or n.article in whole))]


def path_ratios(chars: np.ndarray, marks: np.ndarray, count: np.ndarray, main: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The fused ratio of every path in page order, and the threshold that holds for it."""
    ratio, marked = chars / count, 1 + marks / count
    # A path in the midst of long ones gains by its neighbours, so its own ratios have to be of some weight as well.
    fused = np.sqrt(smoothed(ratio) * smoothed(marked) * ratio * marked)
    held = 0.0
    if main.any():
        held = chars[main & ~side].sum() / max(1, chars[~side].sum())
        fused = np.where(main, fused, fused * max(OUTSIDE, 1 - 2 * held))
    fused = np.where(side, fused * SIDE, fused)
    # What is beside the text has no say in the threshold.
    known = fused if side.all() else fused[~side]
    threshold = min(known.max(), max(known.std(), SHARE * known.max()))
    least = np.full(len(chars), threshold)
    if held >= HELD:
        inside = fused[main & ~side]
        least[main & ~side] = min(threshold, inside.max(), max(inside.std(), SHARE * inside.max()))
    return fused, least


def main_text(html: str) -> str:
    return "\n".join(n.text for n in content(page_of(html)))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html, anything else).

    ``text`` has one line per block; white space inside a block is one space and character references are decoded.
    Null and empty pages, and pages without text, give an empty text. Rows that repeat a page_id each give a row.
    """
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "html"):
            whole = data.tobytes()
            texts = [main_text(whole[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")) for i in range(rows.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
