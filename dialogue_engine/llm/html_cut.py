"""Main text of web pages by minimum cuts.

A page is cut into blocks of text. For each block a linear classifier gives a cost of calling it
boilerplate and a cost of calling it content; these are the capacities of its edges to the two
terminals. Blocks next to each other in the page, and next to each other under the same parent,
are joined by an edge that costs more to cut the closer they stand in the document tree. The
minimum cut is the labelling with the lowest total cost; it is found by maximum flow, exactly.

Spark hands out the pages; a page is small, and its graph has a few edges per block.
"""

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is not markup and goes on to their end tag, or the end of the page.
RAW = frozenset("script style title textarea iframe".split())
# Their content is no text of the page. Without an end tag they end with their parent.
UNSEEN = frozenset("noscript template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
# Elements that are never part of the main text.
ASIDE = frozenset("nav aside footer form button select fieldset menu dialog search head".split())
# Elements that end where the next one of their name starts.
REPEATED = frozenset("li td th tr dd dt option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that say what an element is for.
AWAY = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs "
    "byline comment comments commentlist complementary consent contentinfo cookie cookies copyright "
    "disclaimer discussion disqus footer footnav gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination popup promo promos "
    "promotion recommended recommendations related replies reply respond response responses search "
    "share sharing sidebar sidenav signup skip social sponsor sponsored sponsors subscribe "
    "subscription tagcloud teaser toolbar topbar tracking trending widget widgets".split()
)
# Words that say how an element is laid out, not what it is for. A name made of these and of words
# above is a name of something away from the text; one with other words may be about anything.
LAYOUT = frozenset(
    "area bar block body bottom box btn button buttons card center column container content count "
    "element feed fixed form full grid group holder icon icons inner item items label left line link "
    "links list main menu message mobile module new outer page panel post posts primary region right "
    "row secondary section site small standard sticky sub text thread title top unit wrap wrapper".split()
)
TOWARDS = frozenset("article articlebody blog content entry main maincontent post story text".split())

# Costs, in thousandths of a natural logarithm of odds.
IN_ASIDE, NAMED_AWAY, HIDDEN = 12_000, 9_000, 12_000
# A name with other words as well: outside an article it still weighs, inside hardly.
PARTLY_AWAY, PARTLY_AWAY_INSIDE = 3_000, 500
IN_ARTICLE, NAMED_TOWARDS = 3_000, 1_500
LINKS, SHORT, RIGHTS = 3_000, 700, 4_000
PER_WORD, MOST_WORDS, SENTENCE, PARAGRAPH = 60, 3_000, 500, 800
CLOSE, FAR = 1_200, 60

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RIGHTS = re.compile(r"©|\(c\)\s*\d{4}|copyright|all rights reserved", re.I)
_UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WHITE = re.compile(r"\s+")
_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW | UNSEEN}


@dataclass
class Element:
    """An open element and what it says about the text in it. ``block`` is the nearest block-level
    element, itself included."""

    name: str
    parent: "Element | None"
    block: "Element | None" = None
    depth: int = 0
    away: int = 0
    towards: int = 0
    article: bool = False


@dataclass
class Block:
    """A run of text in one block-level element."""

    parent: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _named(value: str) -> tuple[bool, bool, bool]:
    """What a class, id or role says: away from the text, partly so, towards it."""
    away = partly = towards = False
    for name in value.strip("\"'").split():
        words = {word.lower() for word in _NAME.findall(name)}
        if words & TOWARDS:
            towards = True
            # the header or text of an article belongs to it
            said = (words & AWAY) - {"header", "footer", "text"}
        else:
            said = words & AWAY
        if said:
            whole = words <= AWAY | LAYOUT | TOWARDS
            away, partly = away or whole, partly or not whole
    return away, partly, towards


def _open(name: str, attributes: str, parent: Element) -> Element:
    element = Element(name, parent)
    element.block = element if name in BLOCK else parent.block
    element.depth, element.away = parent.depth + 1, parent.away
    element.towards, element.article = parent.towards, parent.article
    away = partly = hidden = False
    if attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key in ("class", "id", "role"):
                said = _named(value)
                away, partly = away or said[0], partly or said[1]
                if said[2]:
                    element.towards = NAMED_TOWARDS
            elif key == "style":
                hidden |= bool(_UNSEEN_STYLE.search(value))
            else:
                hidden |= key == "hidden" or "true" in value.lower()
    if name in ("article", "main"):
        element.article = True
    if name in ASIDE or (name == "header" and not element.article):
        element.away = max(element.away, IN_ASIDE)
    if name not in ("html", "body"):
        if away:
            element.away = max(element.away, NAMED_AWAY)
        elif partly:
            element.away = max(element.away, PARTLY_AWAY_INSIDE if parent.article else PARTLY_AWAY)
    if hidden or name in UNSEEN:
        element.away = max(element.away, HIDDEN)
    return element


class _Tags:
    """The tags of a page, from front to back. What has been searched for in vain is not searched
    for again, so a page without ends costs no more than one with them."""

    def __init__(self, html: str) -> None:
        self.html = html
        self._missing: set[str] = set()
        self._quotes_hold = True

    def find(self, what: str, at: int) -> int:
        """Where ``what`` is from ``at`` on, or -1."""
        if what in self._missing:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self._missing.add(what)
        return found

    def end_of(self, name: str, at: int) -> int:
        """Where the end tag of an element ends, or -1."""
        if name in self._missing:
            return -1
        found = _END[name].search(self.html, at)
        if not found:
            self._missing.add(name)
            return -1
        return found.end()

    def close(self, at: int) -> int:
        """Where the ``>`` of a tag is whose attributes start at ``at``; one inside quotes is none,
        unless the quotes do not end or no other ``>`` follows. -1 without any."""
        start, html = at, self.html
        while self._quotes_hold:
            at = _UNQUOTED.match(html, at).end()
            if at == len(html):
                self._quotes_hold = False
            elif html[at] == ">":
                return at
            else:
                end = self.find(html[at], at + 1)
                if end < 0:
                    break
                at = end + 1
        return self.find(">", start)


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order, without scripts, styles, comments and markup. Elements that
    are not closed end with their parent, and a paragraph ends where the next block starts. A
    ``<`` that begins no tag is text. The work grows with the length of the page."""
    root = Element("", None)
    root.block = root
    # open elements, how many there are of each name, and which of them are blocks
    stack, opened, block_at = [root], {}, [0]
    found, now = [], None
    tags, at = _Tags(html), 0

    def add(text: str) -> None:
        nonlocal now
        if not text:
            return
        if now is None:
            if text.isspace():
                return
            now = Block(stack[-1].block)
            found.append(now)
        text = unescape(text) if "&" in text else text
        now.parts.append(text)
        if opened.get("a"):
            now.linked += len(text.strip())

    def drop(position: int) -> None:
        """Close the element at a position of the stack and all in it."""
        for element in stack[position:]:
            opened[element.name] -= 1
        del stack[position:]
        while block_at[-1] >= position:
            block_at.pop()

    while True:
        start = tags.find("<", at)
        if start < 0:
            add(html[at:])
            break
        mark = html[start + 1 : start + 2]
        if mark in ("!", "?"):
            comment = html.startswith("<!--", start)
            close = tags.find("-->" if comment else ">", start + 4 if comment else start)
            if close < 0 and not comment:
                add(html[at:])
                break
            add(html[at:start])
            if close < 0:
                break
            at = close + (3 if comment else 1)
            continue
        tag = _TAG.match(html, start + 1)
        if not tag:
            add(html[at : start + 1])
            at = start + 1
            continue
        close = tags.close(tag.end())
        if close < 0:
            add(html[at:])
            break
        add(html[at:start])
        at = close + 1
        name, attributes = tag[2].lower(), html[tag.end() : close]
        if name == "br":
            add(" ")
            continue
        if name in BLOCK:
            now = None
        if tag[1]:
            if opened.get(name):
                position = len(stack) - 1
                while stack[position].name != name:
                    position -= 1
                drop(position)
            continue
        if name in RAW:
            end = tags.end_of(name, at)
            if end < 0:
                break
            at = end
            continue
        if name in UNSEEN:
            if name == "svg" and attributes.endswith("/"):
                continue
            end = tags.end_of(name, at)
            if end >= 0:
                at = end
                continue
            # its text, if any, is a block of its own
            now = None
        if name in VOID:
            continue
        if name in BLOCK:
            # a paragraph, item or cell ends where the next one starts
            inner = block_at[-1]
            if inner and (stack[inner].name == "p" or (stack[inner].name == name and name in REPEATED)):
                drop(inner)
            block_at.append(len(stack))
        stack.append(_open(name, attributes, stack[-1]))
        opened[name] = opened.get(name, 0) + 1
        if name in UNSEEN:
            stack[-1].block = stack[-1]
    for block in found:
        block.text = _WHITE.sub(" ", "".join(block.parts)).strip()
    return [block for block in found if block.text]


def costs(block: Block) -> tuple[int, int]:
    """What it costs to call a block boilerplate, and to call it content."""
    place, text = block.parent, block.text
    words = text.count(" ") + 1
    lost = min(MOST_WORDS, PER_WORD * words) + place.towards
    kept = place.away + int(LINKS * min(1.0, block.linked / len(text)))
    if place.article:
        lost += IN_ARTICLE
    if place.name == "p" or place.name in HEADINGS:
        lost += PARAGRAPH
    if text[-1] in ".!?…":
        lost += SENTENCE
    if words < 5:
        kept += SHORT
    if len(text) < 400 and _RIGHTS.search(text):
        kept += RIGHTS
    return lost, kept


def closeness(a: Block, b: Block) -> int:
    """What it costs to label two neighbours differently: less for each step between their
    places in the tree, and little across the edge of an article, menu or the like."""
    x, y, steps = a.parent, b.parent, 0
    edge = x.article != y.article or (x.away > 0) != (y.away > 0)
    # further apart than this the edge costs least, however deep the tree is
    while x is not y and steps < 2 * CLOSE // FAR:
        if x.depth >= y.depth:
            x = x.parent
        else:
            y = y.parent
        steps += 1
    return FAR if edge else max(FAR, CLOSE * 2 // (2 + max(0, steps - 2)))


def minimum_cut(lost: list[int], kept: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the source's side of the smallest minimum cut.

    Node i has an edge of ``lost[i]`` from the source and of ``kept[i]`` to the sink; ``edges``
    go both ways. Shortest augmenting paths in layers (Dinic's algorithm).
    """
    n = len(lost)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        # what can flow straight through node i does
        through = min(lost[i], kept[i])
        if lost[i] > through:
            join(source, i, lost[i] - through, 0)
        if kept[i] > through:
            join(i, sink, kept[i] - through, 0)
    for a, b, size in edges:
        join(a, b, size, size)

    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                size = min(room[e] for e in path)
                for e in path:
                    room[e] -= size
                    room[e ^ 1] += size
                full = next(i for i, e in enumerate(path) if not room[e])
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while tried[a] < len(out[a]):
                e = out[a][tried[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                tried[a] += 1
            if tried[a] < len(out[a]):
                path.append(out[a][tried[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                e = path.pop()
                a = to[e ^ 1]
                tried[a] += 1


def main_text(html: str | None) -> str:
    """The content blocks of a page, joined by single spaces. Empty for a null or empty page."""
    found = blocks_of(html or "")
    if not found:
        return ""
    lost, kept = zip(*map(costs, found))
    edges = [(i, i + 1, closeness(found[i], found[i + 1])) for i in range(len(found) - 1)]
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        # the block before under the same parent element, with others between
        key = id(block.parent.parent)
        before = last.get(key, -1)
        if 0 <= before < i - 1:
            edges.append((before, i, closeness(found[before], block)))
        last[key] = i
    content = minimum_cut(list(lost), list(kept), edges)
    return " ".join(block.text for block, is_content in zip(found, content) if is_content)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``. Repeated rows come out alike, ties go to
    boilerplate, and a null page has an empty text. Nothing of a page is cut off."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(html) for html in batch.to_pylist()], pa.string())

    return (
        pages.select("page_id", "url", "html")
        .withColumn("text", text("html"))
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    )
