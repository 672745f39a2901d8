"""HTML extraction (operator 8): minimum-cut labelling of text blocks.

A page is cut into blocks of text.  A classifier turns each block's features
(where it lies in the document tree, names of its ancestors, link density,
length, punctuation) into the costs of calling it content or boilerplate; the
costs are the capacities to the two terminals.  Neighbouring blocks, and
blocks with the same parent, are tied by edges whose capacity falls with their
distance in the tree.  The minimum cut is the cheapest labelling.  A page is
one record, so every page is labelled within one task.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: content of these is not text of the page
UNSHOWN = frozenset("head script style noscript template title select option datalist textarea "
                    "svg canvas iframe object audio video map annotation".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements that stay within a line; all others begin and end a block
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label "
                   "mark q rp rt ruby s samp small span strike strong sub sup td th time tt u "
                   "var wbr br img math mi mn mo mrow ms mtext msub msup msubsup mfrac msqrt "
                   "mroot mover munder semantics".split())
#: a start tag that ends an open element of these names
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
BOILER_TAGS = frozenset("nav footer aside form button dialog menu fieldset".split())
CONTENT_TAGS = frozenset(["article", "main"])
BOILER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menu\w*|foot(?:er)?\w*|masthead|side(?:bar)?|widget\w*|ads?|"
    r"advert\w*|promo\w*|sponsor\w*|banner\w*|cookie\w*|consent\w*|gdpr|notice\w*|alert\w*|popup|"
    r"modal|overlay|comment\w*|repl(?:y|ies)|respond|disqus|discussion|breadcrumb\w*|"
    r"subscri\w*|newsletter|signup|author-bio|skip\w*)(?:$|[\s_-])", re.I)
#: names that say little about what lies inside an article: prose there may well bear them
WEAK_NAMES = re.compile(
    r"(?:^|[\s_-])(?:header|share\w*|social\w*|related\w*|recommend\w*|pag(?:er|ination)|login|"
    r"search\w*|toolbar|copyright|legal|tags?|meta)(?:$|[\s_-])", re.I)
CONTENT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:article\w*|content|entry|post|story\w*|main|body|text)(?:$|[\s_-])", re.I)
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                         "menu menubar toolbar".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: classifier weights: log odds of content
WEIGHTS = {"bias": -0.6, "nearest": 4.5, "outer": 0.5, "link_share": -4.0, "log_words": 0.55,
           "sentence": 0.7, "heading": 0.3, "hidden": -9.0}
#: capacities of the edges, and their unit: flows are whole numbers
NEXT, SIBLING, UNIT = 0.9, 0.6, 1000
#: what a weak name counts for inside an article, against 1 of any other
WEAK = 0.1


class Element:
    """An open element, with what its ancestors say about content: nothing above is visited again."""

    __slots__ = ("name", "parent", "depth", "hidden", "inside", "nearest", "outer")

    def __init__(self, name, attrs, parent):
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        self.hidden = bool(parent and parent.hidden or "hidden" in attrs
                           or attrs.get("aria-hidden") == "true"
                           or HIDDEN.search(attrs.get("style") or ""))
        within = bool(parent and parent.inside)
        self.inside = within or name in CONTENT_TAGS
        sign = self.sign(attrs, within)
        # the sign of the nearest element that says something, and the sum of those above it
        self.nearest, self.outer = (parent.nearest, parent.outer) if parent else (0, 0)
        if sign:
            self.nearest, self.outer = sign, self.outer + self.nearest

    def sign(self, attrs, within: bool) -> float:
        """1: content, -1: boilerplate, 0: says nothing; weak names inside an article say little."""
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".strip()
        role = (attrs.get("role") or "").lower()
        if self.name in BOILER_TAGS or role in BOILER_ROLES or BOILER_NAMES.search(names):
            return -1
        if self.name == "header" and not within:  # that of the page, not of an article
            return -1
        if WEAK_NAMES.search(names):
            return -WEAK if within else -1
        return int(self.name in CONTENT_TAGS or role in CONTENT_TAGS
                   or CONTENT_NAMES.search(names) is not None)


class Blocks(HTMLParser):
    """Blocks of a page: [text, element that holds it, characters within links]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [Element("", {}, None)]
        self.named: Counter = Counter()  # open elements by name
        self.unshown: list[str] = []
        self.links, self.linked, self.parts, self.blocks = 0, 0, [], []

    def end_block(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append([text, self.open[-1], self.linked])
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            self.close_open(CLOSES[tag], stop={"ul", "ol", "dl", "table", "select"})
        if tag in UNSHOWN:
            self.unshown.append(tag)
            return
        if tag == "body":
            self.unshown.clear()
        if self.unshown:
            return
        if tag in INLINE:
            if tag in ("br", "td", "th", "img"):
                self.parts.append(" ")
            self.links += tag == "a"
            return
        self.end_block()
        if self.open[-1].name == "p":  # a block ends an open paragraph
            self.pop()
        if tag not in VOID:
            self.open.append(Element(tag, dict(attrs), self.open[-1]))
            self.named[tag] += 1

    def pop(self):
        self.named[self.open.pop().name] -= 1

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag in INLINE and tag != "a":
            self.handle_starttag(tag, attrs)
        elif tag not in UNSHOWN:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def close_open(self, names, stop):
        if self.open[-1].name in names:
            self.end_block()
            self.pop()
        if self.unshown and self.unshown[-1] in names:
            self.unshown.pop()

    def handle_endtag(self, tag):
        if tag in self.unshown:
            del self.unshown[self.unshown.index(tag):]
            return
        if self.unshown:
            return
        if tag in INLINE:
            if tag == "a":
                self.links = max(0, self.links - 1)
            return
        if self.named[tag]:
            self.end_block()
            while self.open[-1].name != tag:
                self.pop()
            self.pop()
            self.links = 0

    def handle_data(self, data):
        if not self.unshown:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)

    def finish(self, html: str) -> list:
        # a tag that the page's end cuts off is not text
        self.feed(re.sub(r"<(?:[/!?]|[a-zA-Z])[^<>]*\Z", "", html))
        self.close()
        self.end_block()
        return self.blocks


def log_odds(text: str, element: Element, linked: int) -> float:
    """The classifier: log odds that a block is content."""
    words = text.count(" ") + 1
    z = WEIGHTS["bias"] + WEIGHTS["log_words"] * math.log(words)
    z += WEIGHTS["link_share"] * min(1.0, linked / len(text))
    z += WEIGHTS["sentence"] * (text[-1] in ".!?…:;\"'»”)")
    z += WEIGHTS["heading"] * (re.fullmatch("h[1-6]", element.name) is not None)
    # the nearest element that says something counts most
    z += WEIGHTS["nearest"] * element.nearest + WEIGHTS["outer"] * element.outer
    return z + WEIGHTS["hidden"] * element.hidden


def tree_distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


class FlowGraph:
    """Maximum flow with whole capacities by shortest augmenting phases."""

    def __init__(self, n: int):
        self.to, self.room, self.next, self.n = [], [], [[] for _ in range(n)], n

    def edge(self, a: int, b: int, there: int, back: int):
        self.next[a].append(len(self.to))
        self.next[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [there, back]

    def reach(self, source: int) -> list[int]:
        level = [-1] * self.n
        level[source], queue = 0, deque([source])
        while queue:
            a = queue.popleft()
            for e in self.next[a]:
                if self.room[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Saturate the graph; the nodes that the source still reaches."""
        while (level := self.reach(source))[sink] >= 0:
            at, path, a = [0] * self.n, [], source
            while True:
                if a == sink:
                    flow = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= flow
                        self.room[e ^ 1] += flow
                    full = next(i for i, e in enumerate(path) if not self.room[e])
                    a, path = self.to[path[full] ^ 1], path[:full]
                    continue
                edges = self.next[a]
                while at[a] < len(edges):
                    e = edges[at[a]]
                    if self.room[e] and level[self.to[e]] == level[a] + 1:
                        break
                    at[a] += 1
                if at[a] < len(edges):
                    path.append(edges[at[a]])
                    a = self.to[edges[at[a]]]
                elif path:  # a dead end
                    level[a] = -1
                    a = self.to[path.pop() ^ 1]
                else:
                    break
        return [x >= 0 for x in level]


def labels(blocks: list) -> list[bool]:
    """Whether each block is content, by the minimum cut."""
    n = len(blocks)
    graph, source, sink = FlowGraph(n + 2), n, n + 1
    last_of: dict[int, int] = {}
    for i, (text, element, linked) in enumerate(blocks):
        z = log_odds(text, element, linked)
        # -log of the probabilities: what each label costs; only their difference matters
        graph.edge(source, i, max(0, round(z * UNIT)), 0)
        graph.edge(i, sink, max(0, round(-z * UNIT)), 0)
        if i:
            near = NEXT * math.exp(-tree_distance(blocks[i - 1][1], element) / 2)
            graph.edge(i - 1, i, *[round(near * UNIT)] * 2)
        parent = id(element.parent or element)
        if parent in last_of and last_of[parent] < i - 1:
            graph.edge(last_of[parent], i, *[round(SIBLING * UNIT)] * 2)
        last_of[parent] = i
    return graph.source_side(source, sink)[:n]


def main_text(html: str | None) -> str:
    """Text of the content blocks, one per line."""
    blocks = Blocks().finish(html or "")
    return "\n".join(b[0] for b, keep in zip(blocks, labels(blocks), strict=True) if keep)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text (main text, empty if none) and n_chars of every page.

    Null or empty html has no text.  Broken markup is read as far as it goes:
    unclosed elements end with the page, however deep they nest, a tag cut off
    by the page's end is dropped.  Repeated rows, ties and null ids or urls are carried over.  Empty
    table: no rows.  Other columns are ignored.
    """
    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    ship(df.sparkSession)
    pages = df.select(F.col(id_col).cast("long").alias("page_id"),
                      F.col(url_col).cast("string").alias("url"),
                      F.col(html_col).cast("string").alias("html"))
    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
