"""Main text of HTML pages by composite text density.

Every DOM node gets a density: its characters per tag, adjusted by the
characters and tags of links. The node whose children's densities have the
largest sum is the content's root; the least density on its path to ``body``
is the threshold, a share of which sections beside the path must reach.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are never article text.
DROPPED = frozenset("script style noscript template head title nav header footer aside button select textarea "
                    "input dialog iframe object embed svg canvas audio video map menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                  "menubar".split())
#: Share of the body's characters outside links from which a wrapper is no furniture: with the heading, without.
WITH_HEADING, WITHOUT_HEADING = 0.2, 0.5
#: Words of a class or id that name what is not the article, whatever its length.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments "
    "commentlist reply replies disqus discussion discussions responses guestbook related recommended".split())
#: Words that name page furniture, but also wrappers of the whole page ("with-sidebar").
FURNITURE = frozenset(
    "banner sidebar aside menu nav navbar navigation breadcrumb breadcrumbs header masthead footer share sharing "
    "social toolbar pagination pager widget form search".split())
_KEPT = frozenset(("html", "body", "main", "article"))
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Share of the threshold for sections beside the path: shorter paragraphs are article text too.
BESIDE = 0.5
# a start tag that closes open elements up to the nearest one of the set, unless a wall is nearer
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
_WALLS = frozenset(("table", "td", "th", "button", "object", "body"))


class Dom(HTMLParser):
    """Nodes in page order as parallel lists, and texts with their node and block."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.dropped = ["#page"], [0], [False]
        self.named, self.foreign = [False], [False]
        self.texts: list[tuple[int, int, str]] = []
        self.open = [0]
        self.block = 0
        tail = html.rfind("<")
        if tail > html.rfind(">") and re.match(r"<[A-Za-z/!?]", html[tail:tail + 2]):
            html = html[:tail]  # the page ends inside a tag
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.block += 1
            self._close({"p"}, _WALLS)
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        parent = self.open[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.dropped.append(self.dropped[parent] or self._never_text(tag, attrs))
        words = set() if tag in _KEPT else {w.lower() for name, value in attrs if name in ("class", "id") and value
                                            for w in _WORD.findall(value)}
        self.foreign.append(not FOREIGN.isdisjoint(words))
        self.named.append(tag == "form" or not FURNITURE.isdisjoint(words))
        if tag not in VOID:
            self.open.append(len(self.tags) - 1)
        elif tag == "br":
            self.texts.append((parent, self.block, " "))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash has no meaning in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.block += 1
        self._close({tag}, frozenset() if tag in ("html", "body", "table") else _WALLS - {tag})

    def handle_data(self, data: str) -> None:
        self.texts.append((self.open[-1], self.block, data))

    def _close(self, tags: set[str], walls: frozenset | set) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[i]]
            if tag in tags:
                del self.open[i:]
                return
            if tag in walls:
                return

    @staticmethod
    def _never_text(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        return tag in DROPPED or tag not in _KEPT and any(
            name == "hidden" or name == "role" and (value or "").lower() in ROLES for name, value in attrs)

    def drop_furniture(self) -> None:
        """Drop named elements. Those of foreign content stay only around the page's heading, its ``main`` or
        its one ``article``; wrappers also if they hold most of the text that is not foreign."""
        if not any(self.named) and not any(self.foreign):
            return
        n = len(self.tags)
        in_link, chars, heading, core = [False] * n, [0] * n, [False] * n, [False] * n
        for i in range(1, n):
            in_link[i] = self.tags[i] == "a" or in_link[self.parents[i]]
        for node, _, text in self.texts:
            if not self.dropped[node] and not in_link[node]:
                chars[node] += sum(map(len, text.split()))
        articles = self.tags.count("article")
        for i in range(n - 1, 0, -1):  # children come after their parents
            if not self.dropped[i]:
                p = self.parents[i]
                heading[i] |= self.tags[i] == "h1" and chars[i] > 0
                core[i] |= heading[i] or self.tags[i] == "main" or self.tags[i] == "article" and articles == 1
                if self.foreign[i] and not core[i]:
                    self.dropped[i] = True
                    continue
                chars[p] += chars[i]
                heading[p] |= heading[i]
                core[p] |= core[i]
        for i in range(1, n):
            furniture = self.named[i] and chars[i] <= (WITH_HEADING if heading[i] else WITHOUT_HEADING) * chars[0]
            self.dropped[i] |= self.dropped[self.parents[i]] or furniture


def density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """Composite text density; ``ratio`` is link characters per character of the body.

    One is added inside both outer logarithms, so nodes without links are defined too.
    """
    if not chars:
        return 0.0
    tags, plain = max(tags, 1), max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + ratio * chars + math.e)
    return chars / tags * math.log(chars / max(link_chars, 1) * tags / max(link_tags, 1) + 1) / math.log(base + 1)


def densities(dom: Dom, body: int) -> tuple[list[float], list[float]]:
    """Every node's density, and the sum of its children's (inline ones left out)."""
    n = len(dom.tags)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = dom.tags[i] == "a" or in_link[dom.parents[i]]
    for node, _, text in dom.texts:
        if not dom.dropped[node]:
            size = sum(map(len, text.split()))
            chars[node] += size
            links[node] += size if in_link[node] else 0
    for i in range(n - 1, 0, -1):  # children come after their parents
        if not dom.dropped[i]:
            p = dom.parents[i]
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (dom.tags[i] == "a")
    ratio = links[body] / chars[body] if chars[body] else 0.0
    dense = [0.0 if dom.dropped[i] else density(chars[i], tags[i], links[i], link_tags[i], ratio) for i in range(n)]
    total = [0.0] * n
    for i in range(1, n):
        if dom.tags[i] not in INLINE:
            total[dom.parents[i]] += dense[i]
    return dense, total


def main_text(html: str | None) -> str:
    """The page's article, one line per block ('' if there is none)."""
    if not html:
        return ""
    dom = Dom(html)
    dom.drop_furniture()
    n = len(dom.tags)
    body = next((i for i in range(n) if dom.tags[i] == "body"), 0)
    dense, total = densities(dom, body)
    inside = [i == body for i in range(n)]
    for i in range(1, n):
        inside[i] |= inside[dom.parents[i]]
    root = max((i for i in range(n) if inside[i] and not dom.dropped[i]), key=lambda i: (total[i], -i), default=body)

    path = [root]
    while path[-1] != body:
        path.append(dom.parents[path[-1]])
    threshold = min(dense[i] for i in path)
    on_path, below = set(path), path[-2] if len(path) > 1 else root
    taken = [False] * n
    for i in range(n):
        p = dom.parents[i]
        if i == root or (i and taken[p]):
            taken[i] = True
        elif i not in on_path and p in on_path and p != root and dense[i] >= BESIDE * threshold:
            # beside the path: inside the main container, or another container of its kind
            taken[i] = p != body or (dom.tags[i] == dom.tags[below] and dom.tags[i] in ("article", "section", "main"))
    # text that stands directly in a container on the path, and the root's own
    lines: dict[int, list[str]] = {}
    for node, block, text in dom.texts:
        if not dom.dropped[node] and (taken[node] or node in on_path and node != body):
            lines.setdefault(block, []).append(text)
    blocks = (" ".join("".join(parts).split()) for _, parts in sorted(lines.items()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row (key, url, text, n_chars) per row of ``pages``.

    Null and empty pages and pages without text give ''. Null keys and repeated
    rows are kept; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], [key, url, "text", "n_chars"])

    rows = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("u"),
                        F.col(html).cast("string").alias("h"))
    return rows.mapInArrow(run, f"`{key}` {dict(pages.dtypes)[key]}, `{url}` string, text string, n_chars long")
