"""Main text of web pages by composite text density (Sun, Song and Liao, SIGIR 2011).

A page is read into a DOM tree by a tolerant tokenizer (raw-text elements, implied end tags, cut-off markup). Menus,
headers, footers, sidebars, notices, adverts, forms, scripts and reader comments are known by element, role or the
words of their class and id, and take no part; the words alone drop nothing that holds an article, main or h1 element or
(on a page without article and main elsewhere) most of the characters outside links, which is left to the densities. Every node's density is its characters per tag, adjusted by the
characters and tags of its links (and the page's link share); a node's density sum is that of its children. The
container with the largest sum is taken. The threshold is the least density on the path from it to the body: an
ancestor takes its place if it holds another block as dense as that. All blocks of the subtree are kept, in page order.

Null or empty pages, and pages without text, give ''. Rows that repeat or lack a page_id are extracted each; of nodes with
equal sums and characters the first in reverse page order is taken. A page of any length and depth takes time in
proportion to its length. Columns other than page_id, url and html are not read; an empty table gives an empty result.
Rows are mapped one by one: no shuffle, memory of one page.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import arrow_rows

# Fixed values of HTML: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split())
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"}
#: What a start tag ends when it is open, up to the nearest of the scopes.
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table div article section body html menu select".split())
#: Elements and class, id or role words of what is not main text.
DROP = frozenset("nav header footer aside form script style noscript template iframe button select option input textarea object embed svg canvas dialog menu head title audio video map".split())
DROP_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar side aside rail widget header masthead footer foot copyright comment comments discussion disqus reply replies respond share sharing social newsletter subscribe subscription signup login related recommended recommendations trending pagination pager toolbar tooltip skip search complementary contentinfo".split())
#: Words of a class, id or role that say what is around or beside something; such a name tells nothing.
HARMLESS = frozenset("has with no non without free wrap wrapper layout by".split())
#: An element that holds one of these is not dropped by its words.
LANDMARKS = frozenset("main article h1".split())
#: Never dropped by their words: what holds the page.
KEPT = frozenset("html body main article".split())
CONTAINERS = frozenset("body div article section main td center blockquote details".split())

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_NAME = re.compile(r"[\s/]*+([^\s/>=]*+)")
_EQUALS = re.compile(r"\s*+=\s*+")
_BARE = re.compile(r"[^\s>]*+")
#: Attributes that tell clutter.
TELLING = frozenset("class id role aria-hidden hidden style".split())
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Node:
    __slots__ = ("name", "parent", "parts", "dropped", "doubtful", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None, dropped: bool = False, doubtful: bool = False):
        self.name, self.parent, self.parts, self.dropped, self.doubtful = name, parent, [], dropped, doubtful
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def tag_end(html: str, at: int, last: dict[str, int]) -> tuple[int, list[tuple[str, str]]]:
    """Where a tag's > is, from behind its name, and its telling attributes; -1 if the page ends within the tag.

    One step an attribute, by what may stand there: a name, an equals sign, a quoted or a bare value. `last` has the last place of
    each quotation mark of the page; a value whose mark never comes again ends with the tag, at the next >.
    """
    told = []
    while True:
        m = _NAME.match(html, at)
        at, name, value = m.end(), m[1], ""
        if equals := _EQUALS.match(html, at):
            at = equals.end()
            mark = html[at : at + 1]
            if mark in last:
                if last[mark] == at:
                    return html.find(">", at), told
                end = html.index(mark, at + 1)
                value, at = html[at + 1 : end], end + 1
            else:
                bare = _BARE.match(html, at)
                value, at = bare[0], bare.end()
        if name and (name := name.lower()) in TELLING:
            told.append((name, value))
        if at == len(html):
            return -1, told
        if html[at] == ">":
            return at, told


def is_clutter(name: str, attributes: list[tuple[str, str]]) -> tuple[bool, bool]:
    """Whether an element is clutter by its kind or hidden, and whether it may be clutter by its words."""
    if name in DROP:
        return True, False
    if not attributes or name in KEPT:
        return False, False
    doubtful = False
    for kind, value in attributes:
        if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true" or kind == "style" and "display:none" in value.lower().replace(" ", ""):
            return True, False
        if kind in ("class", "id", "role"):
            for name_ in value.split():
                words = _WORDS.findall(_CAMEL.sub(r"\1 \2", name_).lower())
                doubtful |= not DROP_WORDS.isdisjoint(words) and HARMLESS.isdisjoint(words)
    return False, doubtful


def settle(root: Node) -> None:
    """Drops what may be clutter by its words, but for what holds an article, main or h1, or most of the page's characters outside links while no article or main stands elsewhere."""
    # with each node: whether it is in a link, whether it is in a doubtful element, articles and mains around it that are in none
    order, stack, free, any_doubt = [], [(root, False, False, 0)], 0, False
    while stack:
        node, linked, doubt, around = stack.pop()
        order.append((node, linked or node.name == "a", around))
        here = node.name in ("article", "main") and not doubt
        free += here
        any_doubt |= node.doubtful
        below = linked or node.name == "a", doubt or node.doubtful, around + here
        stack.extend((p, *below) for p in node.parts if isinstance(p, Node) and not p.dropped)
    if not any_doubt:
        return
    plain: dict[Node, tuple[int, bool]] = {}
    for node, linked, _ in reversed(order):
        n, holds = 0, node.name in LANDMARKS
        for p in node.parts:
            if isinstance(p, str):
                n += 0 if linked else len(p.strip())
            elif not p.dropped:
                n += plain[p][0]
                holds |= plain[p][1]
        plain[node] = n, holds
    for node, _, around in order:
        n, holds = plain[node]
        node.dropped = node.dropped or node.doubtful and not holds and not (free == around and 2 * n > plain[root][0])


class Path:
    """The open nodes from the body on, with the places of those that tags look for."""

    def __init__(self, body: Node):
        self.nodes, self.named, self.blocks, self.scopes = [body], {}, [0], [0]

    def open(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.named.setdefault(node.name, []).append(at)
        if node.name in BLOCK:
            self.blocks.append(at)
        if node.name in SCOPES:
            self.scopes.append(at)

    def cut(self, at: int) -> None:
        """Closes the nodes from place `at` on."""
        while len(self.nodes) > at:
            self.named[self.nodes.pop().name].pop()
        for places in (self.blocks, self.scopes):
            while places[-1] >= at:
                places.pop()

    def last(self, name: str) -> int:
        """The place of the last open node of a name; 0 if there is none."""
        return (self.named.get(name) or (0,))[-1]

    def first_above(self, names: tuple[str, ...], at: int) -> int:
        """The first place after `at` of an open node with one of the names; 0 if there is none."""
        found = [places[i] for n in names if (places := self.named.get(n)) and (i := bisect_right(places, at)) < len(places)]
        return min(found, default=0)


def parse(html: str) -> Node:
    """The tree below `html`; text parts are strings in `parts`."""
    root = Node("html", None)
    body = Node("body", root)
    root.parts.append(body)
    path = Path(body)
    pos, end = 0, len(html)
    last = {mark: html.rfind(mark) for mark in "\"'"}
    while pos < end:
        lt = html.find("<", pos)
        if lt < 0:
            lt = end
        if lt > pos:
            path.nodes[-1].parts.append(html[pos:lt])
            pos = lt
            if lt == end:
                break
        if html.startswith(("<!", "<?"), lt):
            cdata = html.startswith("<![CDATA[", lt)
            mark = "-->" if html.startswith("<!--", lt) else "]]>" if cdata else ">"
            close = html.find(mark, lt + (4 if mark == "-->" else 2))
            if cdata:
                path.nodes[-1].parts.append(html[lt + 9 : close if close >= 0 else end])
            pos = close + len(mark) if close >= 0 else end
            continue
        m = _OPEN.match(html, lt)
        if not m:
            path.nodes[-1].parts.append("<")
            pos = lt + 1
            continue
        close, told = tag_end(html, m.end(), last)
        if close < 0:
            break  # a tag that the page's end cuts off
        pos = close + 1
        name = m[2].lower()
        if m[1]:
            at = path.last(name)
            # an inline end tag doesn't close blocks
            if at and (name in BLOCK or at > path.blocks[-1]):
                path.cut(at)
            elif name == "p":
                path.nodes[-1].parts.append(Node("p", path.nodes[-1]))
            continue
        if name in ("html", "body"):
            continue
        if name in CLOSES_P and path.last("p") > path.scopes[-1]:
            path.cut(path.last("p"))
        if name in IMPLIED and (at := path.first_above(IMPLIED[name], path.scopes[-1])):
            path.cut(at)
        child = Node(name, path.nodes[-1], *is_clutter(name, told))
        path.nodes[-1].parts.append(child)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(html, pos)
            stop = close.start() if close else end
            if not child.dropped:
                child.parts.append(html[pos:stop])
            shut = html.find(">", stop)
            pos = shut + 1 if close and shut >= 0 else end
        elif name not in VOID and html[close - 1] != "/":
            path.open(child)
    settle(root)
    return root


def measure(root: Node) -> list[Node]:
    """Fills in characters, tags, densities and density sums; the nodes in reverse page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if isinstance(p, Node) and not p.dropped)
    for node in reversed(order):
        linked = node.name == "a"
        for p in node.parts:
            if isinstance(p, str):
                n = len(p.strip())
                node.chars += n
                node.link_chars += n if linked else 0
            elif not p.dropped:
                node.chars += p.chars
                node.tags += p.tags + 1
                node.link_chars += p.chars if linked else p.link_chars
                node.link_tags += p.link_tags + (p.name == "a")
    page = root.link_chars / max(root.chars, 1)
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
        if c:
            base = log(c / max(c - lc, 1) * lc + page * c + e)
            node.density = c / t * log(max(c / max(lc, 1) * t / max(lt, 1), 1) + e - 1) / base
    for node in order:
        node.total = sum(p.density for p in node.parts if isinstance(p, Node) and not p.dropped)
        if any(isinstance(p, str) and p.strip() for p in node.parts):
            node.total += sum(len(p.strip()) for p in node.parts if isinstance(p, str)) / max(node.tags, 1)
    return order


def main_node(root: Node) -> Node | None:
    """The container with the largest density sum, or its last ancestor that holds other blocks above the body-path threshold."""
    order = measure(root)
    found = [n for n in order if n.name in CONTAINERS and n.chars]
    if not found:
        return None
    best = max(found, key=lambda n: (n.total, n.chars))
    path, node = [], best
    while node.parent is not None:
        path.append(node)
        node = node.parent
    threshold = min(n.density for n in path)
    for n in path[1:]:
        # siblings of the path that are as dense as the threshold belong to the text
        inside = [p for p in n.parts if isinstance(p, Node) and not p.dropped and p.name in CONTAINERS | {"p", "pre", "blockquote", "ul", "ol", "table"} and p.chars and p.density >= threshold and p.link_chars < 0.5 * p.chars]
        if n.name == "body" and n.total < 1.5 * best.total:
            break
        if len(inside) > 1 or n.chars == best.chars:
            best = n
    return best


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, decoded, with single spaces."""
    out: list[str] = []
    line: list[str] = []

    def flush():
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        n, i = stack.pop()
        if i == 0 and n.name in BLOCK:
            flush()
        while i < len(n.parts):
            p = n.parts[i]
            i += 1
            if isinstance(p, str):
                # a character reference ends with its text: no tag or comment lies within one
                line.append(unescape(p))
            elif not p.dropped:
                if p.name in VOID:
                    if p.name in ("br", "hr"):
                        flush() if p.name == "hr" else line.append(" ")
                    continue
                stack.append((n, i))
                stack.append((p, 0))
                break
            elif p.name in BLOCK:
                flush()
        else:
            if n.name in BLOCK:
                flush()
    flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    node = main_node(parse(html))
    return "\n".join(blocks(node)) if node else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages."""
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, u, t, len(t)) for b in batches for k, u, h in zip(*(b.column(i).to_pylist() for i in range(3))) for t in [main_text(h)])
        yield from arrow_rows(rows, kinds, 500)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
