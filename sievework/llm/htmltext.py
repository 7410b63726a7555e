"""Main text of web pages: flat text blocks, judged by a decision tree.

A page is cut into blocks at block elements. A block's features are its number of words and its link density, the same of
the blocks before and after it, whether it is a heading or a list item, and where it stands: its zone by elements alone, its
zone by elements and names, how strongly names set it apart, and the size and link density of what is set apart with it. The
zone comes from the nearest telling ancestor: content (an article), the rest of a page (menus, footers, forms, adverts), or a
header within content, which holds titles as well as bylines. Names mislead: a container that holds most of the page's prose
while no content stands elsewhere is not set apart by its name, nor is one that names itself content as well. A decision
tree says which blocks are main text. It is grown from the blocks of the small labelled pages below, in which some names
mislead, too; where a page has no telling elements, the sizes and link densities of the neighbours decide. The words of a
text are never compared with lists.

Everything happens within a page, so pages are neither shuffled nor grouped; a task holds one Arrow batch of whole pages,
and works on one page at a time, in steps that are linear in its length.

Defined results: null or empty html gives the empty text. An empty table gives no rows. Only page_id, url and html are
read, so other columns may have any name. Repeated rows give one row each. Unclosed and stray tags are tolerated: an end
tag closes what lies inside its element, one without a start is ignored. Script, style, title, textarea and comments run
to the end of the page where nothing ends them. Other silent elements end at their own end tag; a start without one, and a
self-closed svg, hides nothing. The head hides nothing but its silent elements, since its end tag may be missing. Text
outside any element counts as a block."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that begin and end blocks, those whose content is no text, and those that tell a zone.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul button".split()
)
RAW = "script|style|title|textarea"
SILENT = frozenset("noscript template svg iframe object canvas select button audio video".split())
FLAT = frozenset("button select iframe".split())  # never inside one of the same name: a second start leaves the first unclosed
BOILERPLATE = frozenset("nav footer aside menu dialog".split())
CONTENT = frozenset("article main".split())
CONTAINERS = BLOCKS - frozenset("p hr h1 h2 h3 h4 h5 h6 dt dd li option td th tr tbody thead tfoot body html head".split())

# Parts of class names, ids and roles that tell the zone of a container; the parts that tell it of a single
# block as well; and first parts that only say what a container stands beside.
ASIDE_PARTS = re.compile(
    r"ads?|adv|advert\w*|adsense|banners?|promo\w*|sponsor\w*|cookies?|consent|gdpr|notices?|alert|menus?|nav\w*|breadcrumbs?|sidebars?|footer|masthead|topbar|comments?|reply|replies|respond|disqus|share|sharing|social|related|recommended|subscribe|newsletter|signup|popup|modal|overlay|login|search|widgets?|toolbar|pagination|pager|copyright|legal|skip|complementary|contentinfo"
)
ADVERT_PARTS = re.compile(r"ads?|adv|advert\w*|adsense|promo\w*|sponsor\w*|cookies?|comments?|share|sharing|newsletter|subscribe")
DISCUSSION_PARTS = re.compile(r"comments?|reply|replies|respond|disqus")
LAYOUT_PARTS = frozenset("area bar block box button buttons col column container form group head icons inner item items left links list main outer page panel posts right row section site slot title top unit wrap wrapper".split())
HEADER_PARTS = frozenset("header banner heading".split())
CONTENT_PARTS = frozenset("article content post entry story main".split())
BESIDE = frozenset("has with no without".split())

OTHER, FORM, OPEN, TITLES, MAIN = -1.0, -2.0, 0.0, 0.5, 1.0  # zones; a form is other, but may wrap a whole page

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>(?>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*))>|<[!?/][^<>]*>",
    re.I | re.S,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

FEATURES = ("zone", "marked", "heading", "item", "words", "links", "words_before", "links_before", "words_after", "links_after", "by_elements", "apart", "group_words", "group_links", "group_mean")
MOST = 0.6  # share of a page's prose from which on the name of its container tells nothing

# Labelled pages. +n stands for n words of main text, -n for n words of other text; both sit in the markup
# that they would have. Pages with telling elements first, then pages of plain div and p elements, where the size and the
# links of neighbours tell.
LABELLED = """
<header><p>-3</p></header><nav><ul><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul></nav><div class=ad>-8</div><article><h1>+9</h1><p>+40<p>+1<p>+120<a>+2</a><p>+3</article><footer>-14</footer>
<div class=cookie-notice>-20</div><main><h1>+4</h1><p>+6<ul><li>+7<li>+5<li><a>+2</a></ul><p>+88<a>+12</a></main><section id=comments><h3>-2</h3><article><p>-60<p>-45</article></section><footer><p><a>-2</a></footer>
<header><h1>-3</h1></header><nav><a>-2</a></nav><article><header><h1>+7</h1><p>-5</header><p>+200<p>+12<aside><p>-35<a>-30</a></aside><p>+50<p>+2<form><p>-9</form></article><aside><p>-100</aside>
<article><div class=entry-header><h2>+5</h2><p>-4</div><div class=entry-content><p>+30<h2>+3</h2><p>+25<p class=advert>-12<blockquote>+18</blockquote></div><div class=share><p>-3</div></article><div class=sidebar><h3>-2</h3><p>-40</div>
<div><p>-5</div><article><h1><a>+7</a></h1><p>+15<p>+33</article><div><p>-22<p>-70</div><ul><li><a>-2</a></ul>
<div class="content has-sidebar"><h1>+6</h1><p>+44<p>+20</div><div class=widget><p>-15</div><div><p>-4</div>
<nav><a>-2</a></nav><article><h1>+1</h1><p>+3</article><footer>-5</footer>
<nav><a>-9</a></nav><article><p><a>+4</a><p><a>+9</a><p><a>+2</a> +1<p>+2</article><footer>-30<a>-12</a></footer>
<div class=menu><p>-25<p>-50</div><article><h1>+3</h1><p>+2<p>+1<p>+350<p>+2</article>
<nav><ul><li>-1<li>-2<li>-3</ul></nav><main><h2>+2</h2><ul><li><a>+1</a><li><a>+3</a></ul><p>+150</main><div class=newsletter><p>-30</div>
<header><p>-60</header><article><h1>+12</h1></article><article><h1>+10</h1><p>+4</article><footer><p>-80<p>-40</footer>
<div class=breadcrumbs><a>-1</a> <a>-2</a></div><div class=post><p>+5<p><a>+5</a><p>+5</div><div class=related><p>-5<p>-45<p>-300</div>
<article><p>+1</article><footer>-1</footer><aside><p>-1<p>-150</aside>
<header><p>-2</header><div id=content><header><h2>+4</h2><p>-2</header><p>+6<p>+1</div><footer><p>-7</footer>
<main><p>+2<p>+45<p>+4</main>
<div>-40</div><article><header><h1>+11</h1><p>-8</header><p>+70</article><div>-25</div>
<article><div class=post-header><h1>+8</h1><h2>+14</h2><p>-12</div><p>+20<p>+3</article><footer>-6</footer>
<div class=article-heading><h1>+6</h1><p>-3</div><div class=article><p>+31<p>+18</div><p>-11
<div><a>-1</a></div><div><a>-2</a></div><div><a>-3</a></div><h1>+6</h1><p>+40<p>+60<a>+3</a><p>+9<p>+35<p>+2<p>+50<p>-4<p><a>-4</a> -1
<ul><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul><h1>+5</h1><p>+25<p>+80<a>+5</a><h2>+3</h2><p>+30<ul><li>+6<li>+4<li>+8</ul><p>+20<p>-2<a>-3</a><p><a>-18</a> -2
<h1>+4</h1><p>+12<p>+15
<h1>+8</h1><p>+60<h2>+2</h2><p>+45<h2>+4</h2><p>+3<p>+70<p>+25
<div>-3</div><div><a>-2</a> <a>-2</a> <a>-3</a></div><div>+15</div><div>+22</div><div>+5</div><div>+50</div><div>-3 <a>-4</a></div><div>-4</div>
<h1><a>-2</a></h1><ul><li><a>-1</a><li><a>-1</a></ul><h2>+7</h2><p>+33<p>+41<h3>-2</h3><ul><li><a>-6</a><li><a>-7</a><li><a>-5</a></ul><p>-5
<div>-2</div><div><a>-2</a></div><div>-3</div><div><a>-1</a></div><p>+28<p>+4<p>+31<div><a>-2</a></div><div>-3</div><div><a>-2</a></div>
<p>+7
<p>+50<p>+8
<nav><a>-2</a></nav><article class="post category-legal tag-search"><h1>+6</h1><p>+40<p>+35</article><footer>-9</footer>
<header><p>-3</header><div class="story social"><h1>+5</h1><p>+30<p>+60<a>+2</a></div><div class=sidebar><p>-20</div>
<nav><a>-2</a></nav><article><h1>+7</h1><p>+50<section class=related-work><h2>+2</h2><p>+45<p>+38</section><p>+30</article><footer>-8</footer>
<main><h1>+4</h1><p>+60<div class=legal-basis><p>+55<p>+40</div><div class=search-methods><h2>+3</h2><p>+33</div><p>+25</main>
<main><p>+80<section class=social-history><h3>+2</h3><p>+28<ul><li>+9<li>+14</ul><p>+41</section></main><footer>-30</footer>
<article><h1>+5</h1><p>+70<div class=related-posts><h3>-2</h3><ul><li><a>-6</a><li><a>-7</a></ul></div><div class=share-buttons><p>-2</div><p>+20</article>
<article><p>+44<div class=promo-teaser><a>-9</a><p>-3</div><p>+51<div class=newsletter><p>-28</div></article>
<article><p>+30<div class=social-proof><a>-4</a> <a>-3</a></div><p>+62<div class=login-hint><p>-6</div><p>+35</article>
<div class="page-wrapper sidebar-right"><nav><a>-2</a></nav><article><h1>+6</h1><p>+48<p>+31</article><div class=widget><p>-15</div></div>
<div id=search><h1>+4</h1><p>+52<p>+47</div><footer>-10</footer>
<article><h1>+3</h1><fieldset><p>+26<p>+33</fieldset><p>+12</article>
<nav><a>-3</a> <a>-2</a></nav><h1>+5</h1><p>+40<p>+35<footer><p>-9</footer>
<header><p>-4</header><h1>+6</h1><p>+60<p>+44<p>+8<footer>-12 <a>-2</a></footer>
<div id=search-page><nav><p>-8</nav><h1>+4</h1><p>+38<p>+52</div><footer>-31</footer>
<div class=menu-wrapper><p>-6<a>-3</a></div><h1>+5</h1><p>+70<p>+33<aside><p>-20</aside><footer>-10</footer>
<article><h1>+5</h1><p>+12</article><section id=comments><p>-80<p>-120<p>-60</section>
<article><p>+20</article><div class=comment-list><p>-90<p>-45<a>-3</a><p>-130</div><footer>-4</footer>
"""
LONG = 30  # words from which on a block's length tells nothing more
NUMBER = re.compile(r"([+-])(\d+)")


class Tree:
    """A decision tree of axis-parallel cuts by information gain. Flat arrays: feature, cut, left, right, value. No leaf has
    fewer labelled blocks than `least`."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2):
        self.least = least
        self.nodes: list[list[float]] = []
        self._grow(x, y, depth)
        self.table = np.array(self.nodes)
        self.depth = depth

    @staticmethod
    def _entropy(p: float) -> float:
        return 0.0 if p in (0, 1) else float(-p * np.log2(p) - (1 - p) * np.log2(1 - p))

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        at = len(self.nodes)
        self.nodes.append([-1, 0.0, at, at, float(y.mean())])
        best = None
        for f in range(x.shape[1] if depth and 0 < y.mean() < 1 else 0):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                low = x[:, f] <= cut
                if min(low.sum(), (~low).sum()) < self.least:
                    continue
                loss = low.sum() * self._entropy(y[low].mean()) + (~low).sum() * self._entropy(y[~low].mean())
                if best is None or loss < best[0] - 1e-12:
                    best = (loss, f, cut, low)
        if best is not None:
            _, f, cut, low = best
            self.nodes[at][0], self.nodes[at][1] = f, float(cut)
            self.nodes[at][2] = self._grow(x[low], y[low], depth - 1)
            self.nodes[at][3] = self._grow(x[~low], y[~low], depth - 1)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = self.table[at]
            low = x[np.arange(len(x)), node[:, 0].astype(np.int64)] <= node[:, 1]
            at = np.where(low, node[:, 2], node[:, 3]).astype(np.int64)
        return self.table[at, 4] >= 0.5


def features(blocks: list[tuple]) -> np.ndarray:
    """One row for each block of a page, in the order of FEATURES; blocks: what blocks_of gives."""
    b = np.array([x[:5] for x in blocks], float).reshape(-1, 5)
    words, density = np.minimum(b[:, 3], LONG), b[:, 4] / np.maximum(b[:, 3], 1)
    around = np.zeros((len(b), 4))
    around[1:, 0], around[1:, 1] = words[:-1], density[:-1]
    around[:-1, 2], around[:-1, 3] = words[1:], density[1:]
    marked = np.full(len(b), float((b[:, 0] > OPEN).any()))
    where = np.array([x[6:] for x in blocks], float).reshape(-1, 5)
    return np.column_stack((b[:, 0], marked, b[:, 1], b[:, 2], words, density, around, where))


def train(table: str = LABELLED) -> Tree:
    """The tree of the labelled pages. A page's blocks come from blocks_of, as those of any page do."""
    x, y = [], []
    for page in table.strip().splitlines():
        blocks = blocks_of(NUMBER.sub(lambda m: " ".join([m[1]] * int(m[2])), page))
        x.append(features(blocks))
        y += [b[5].startswith("+") for b in blocks]
    return Tree(np.vstack(x), np.array(y, float))


def names_in(attrs: str) -> list[list[str]]:
    """The class names, ids and roles of an element, each as its parts."""
    names = " ".join(x[0] or x[1] or x[2] for x in NAMED.findall(attrs)).lower().split() if attrs else []
    return [[p for p in re.split(r"[_-]+", n) if p] for n in names]


def apart_by_names(names: list[list[str]]) -> int:
    """How strongly names set a container apart: 0 not at all, 1 by a part of a name among others or next to a name of
    content, 2 by a whole name, 3 as a discussion."""
    level = 0
    for n in names:
        aside = [bool(ASIDE_PARTS.fullmatch(p)) for p in n]
        if DISCUSSION_PARTS.fullmatch(n[0]):
            return 3
        if any(aside):
            level = max(level, 2 if all(a or p in LAYOUT_PARTS or p.isdigit() for a, p in zip(aside, n)) else 1)
    return min(level, 1) if any(p in CONTENT_PARTS for n in names for p in n) else level


@dataclass(slots=True)
class Container:
    """An open element: its parent, and what its tag and its names say of it."""

    tag: str
    parent: int
    boilerplate: bool  # by its tag, or hidden
    header: bool
    content: bool
    level: int
    prose: int = 0  # words outside links of all blocks within that no tag makes boilerplate

    @staticmethod
    def of(tag: str, attrs: str, parent: int) -> Container:
        names = [n for n in names_in(attrs) if n and n[0] not in BESIDE]
        content = any(p in CONTENT_PARTS for n in names for p in n)
        header = tag == "header" or any(p in HEADER_PARTS for n in names for p in n)
        return Container(tag, parent, tag in BOILERPLATE or bool(attrs and HIDDEN.search(attrs)), header, content, apart_by_names(names))


def zone_in(c: Container, zone: float, level: int, named: bool = True) -> float:
    """The zone inside a container that stands in `zone`, where its names set it apart by `level`."""
    content = c.content and named
    header = c.header if named else c.tag == "header"
    if c.boilerplate:
        return OTHER
    if header and (zone > OPEN or content) and zone >= OPEN:
        return TITLES
    if header or level:
        return OTHER
    if c.tag == "form":
        return FORM if zone in (OPEN, FORM) else OTHER
    if c.tag == "main" or (zone in (OPEN, FORM) and (c.tag in CONTENT or content)):
        return MAIN  # an article inside the rest of a page, such as a comment, stays there
    return zone


def placed(containers: list[Container], blocks: list[tuple]) -> list[tuple]:
    """The blocks with what their places say: zone, heading, item, words, linked words, text, zone by elements, level of being
    apart, and words, link density and mean words of all blocks that the same container sets apart."""
    n = len(containers)
    by_elements, inside = [OPEN] * n, [False] * n
    for i, c in enumerate(containers):
        if c.parent >= 0:
            by_elements[i], inside[i] = by_elements[c.parent], inside[c.parent]
        by_elements[i] = zone_in(c, by_elements[i], 0, named=False)
        inside[i] |= c.tag in CONTENT or c.content
    total, held = 0, [0] * n  # prose of the page, and of each container what of it lies within content
    for at, _, _, words, linked, _, alone in blocks:
        if alone or (at >= 0 and by_elements[at] in (OTHER, FORM)):
            continue
        total += words - linked
        if at >= 0:
            containers[at].prose += words - linked
            held[at] += (words - linked) * inside[at]
    marked = sum(held)
    for i in range(n - 1, -1, -1):  # a parent stands before its children
        if (up := containers[i].parent) >= 0:
            containers[up].prose += containers[i].prose
            held[up] += held[i]
    level, zones, group = [0] * n, [OPEN] * n, [-1] * n
    for i, c in enumerate(containers):
        own = c.level
        most = c.prose >= (MOST if own < 3 else 0.95) * max(total, 1) and marked == held[i]
        if own and (most or (own == 1 and (c.content or c.tag in CONTENT))):
            own = 0
        up = c.parent
        zones[i] = zone_in(c, zones[up] if up >= 0 else OPEN, own)
        level[i] = max(own, level[up]) if up >= 0 else own
        group[i] = group[up] if up >= 0 and group[up] >= 0 else i if own else -1
    sums: dict[int, list[int]] = {}
    for at, _, _, words, linked, _, alone in blocks:
        g = group[at] if at >= 0 else -1
        if g >= 0 and not alone:
            got = sums.setdefault(g, [0, 0, 0])
            got[0], got[1], got[2] = got[0] + words, got[1] + linked, got[2] + 1
    out = []
    for at, heading, item, words, linked, text, alone in blocks:
        zone, plain, lev, g = (zones[at], by_elements[at], level[at], group[at]) if at >= 0 else (OPEN, OPEN, 0, -1)
        own = [words, linked, 1] if alone else sums.get(g, [0, 0, 1])
        zone = OTHER if alone or zone == FORM else zone
        out.append((zone, heading, item, words, linked, text, OTHER if plain == FORM else plain, 2 if alone else lev, min(own[0], 300), own[1] / max(own[0], 1), min(own[0] / own[2], LONG)))
    return out


def apart(attrs: str) -> bool:
    """Whether a single block's own attributes set it apart from its surroundings."""
    return bool(attrs) and bool(HIDDEN.search(attrs) or any(n and n[0] not in BESIDE and any(ADVERT_PARTS.fullmatch(p) for p in n) for n in names_in(attrs)))


def silent_ends(tokens: list[re.Match]) -> dict[int, int]:
    """Where each closed silent element ends, by its start."""
    ends: dict[int, int] = {}
    started: dict[str, list[int]] = {}
    for m in tokens:
        tag = (m["tag"] or "").lower()
        if tag not in SILENT:
            continue
        begun = started.setdefault(tag, [])
        if m["end"]:
            if begun:
                ends[begun.pop()] = m.end()
        elif not (tag == "svg" and m["attrs"].endswith("/")):
            if tag in FLAT:
                begun.clear()
            begun.append(m.start())
    return ends


def blocks_of(html: str) -> list[tuple]:
    """The text blocks in page order, as placed() gives them."""
    out: list[tuple] = []
    containers: list[Container] = []
    stack: list[int] = []  # open containers
    open_tags: Counter = Counter()
    parts: list[str] = []
    linked: list[str] = []
    link, heading, item, at, alone = 0, 0, 0, 0, False

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((stack[-1] if stack else -1, heading, item, text.count(" ") + 1, len(unescape("".join(linked)).split()), text, alone))
            parts.clear()
            linked.clear()

    def put(text: str) -> None:
        if text:
            parts.append(text)
            if link:
                linked.append(text)

    tokens = list(TOKEN.finditer(html))
    ends = silent_ends(tokens)
    for m in tokens:
        if m.start() < at:
            continue  # inside a silent element
        put(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in SILENT and not m["end"]:
            at = ends.get(m.start(), at)
            if at == m.end() and tag in BLOCKS:
                flush()
        elif tag in BLOCKS:
            flush()
            if m["end"]:
                if tag in CONTAINERS and open_tags[tag]:
                    while True:
                        inner = containers[stack.pop()].tag
                        open_tags[inner] -= 1
                        if inner == tag:
                            break
                    link = 0
            elif tag in CONTAINERS and not m["attrs"].endswith("/"):
                containers.append(Container.of(tag, m["attrs"], stack[-1] if stack else -1))
                stack.append(len(containers) - 1)
                open_tags[tag] += 1
            alone = not m["end"] and tag not in CONTAINERS and apart(m["attrs"])
            heading = int(not m["end"] and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())
            item = int(not m["end"] and tag in ("li", "dt", "dd"))
        elif tag == "a":
            link = 0 if m["end"] else 1
        elif tag in ("br", "wbr", "img"):
            put(" " if tag == "br" else "")
    put(html[at:])
    flush()
    return placed(containers, out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]):
        for pages in batches:
            all_blocks = [blocks_of(h) if h else [] for h in pages.column("html").to_pylist()]
            full = [b for b in all_blocks if b]
            keep = tree.predict(np.vstack([features(b) for b in full])) if full else np.zeros(0, bool)
            texts, at = [], 0
            for b in all_blocks:
                texts.append("\n".join(x[5] for x, k in zip(b, keep[at : at + len(b)]) if k))
                at += len(b)
            # ids pass as they are: through pandas, a null among them would make them floats
            yield pa.RecordBatch.from_arrays([pages.column("page_id"), pages.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
