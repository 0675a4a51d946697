"""Main text of web pages by minimum-cut labelling of their blocks.

A page is parsed into blocks: the text of a block-level element up to the next block-level tag.
Each block is either content or boilerplate. Calling it content costs its capacity to the sink,
calling it boilerplate its capacity to the source; neighbours that get different labels cost the
capacity of the edge between them. The cheapest labelling is a minimum cut, found by maximum flow.

* Terminal capacities are a classifier's log odds (``fit``: logistic regression on text
  statistics, learned from blocks whose own mark-up says what they are), plus the mark-up's word
  where it has one: the innermost block-level element that is semantic (``article``, ``nav``,
  a role) or has a telling word in its class or id.
* Edges join neighbours in page order, weaker the further they are apart in the element tree, and
  each block with the one before it below the same parent, across what lies between.

Capacities are integers, so equal pages get equal labels.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import lean, whole_text, written

#: Pages that the classifier is fitted on, about (chosen by hash of page_id and url; whole pages).
FIT_PAGES = 20_000
#: In nats: the classifier's say at most, what mark-up says, and an edge between neighbouring siblings.
TEXT_LIMIT, MARKED, SMOOTH = 3.0, 8.0, 1.0
_SCALE = 1000

# Fixed values of HTML and of common page mark-up.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split())
UNSEEN = frozenset("script style noscript template title svg math iframe object canvas audio video select textarea button datalist".split())
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
                  "option": {"select"}}
GOOD_TAGS = frozenset(["article", "main"])
BAD_TAGS = frozenset("nav aside footer header form dialog menu fieldset".split())
GOOD_ROLES = frozenset(["main", "article"])
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
GOOD_WORDS = frozenset("article articlebody body content entry main page post prose story text".split())
BAD_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertisements advertising alert aside banner breadcrumb breadcrumbs "
    "comment comments commentlist commentary consent "
    "cookie cookies copyright dialog discuss disqus discussion discussions feedback foot footer form gdpr guestbook legal login masthead "
    "menu menus modal nav navbar navigation "
    "newsletter notice notices notification notifications overlay pager pagination popup promo promotion promotions recommended related "
    "rail replies reply respond responses reviews rss search share sharing sidebar sidebars signup sitemap skip social sponsor sponsored sponsors subscribe "
    "subnav subscription tags toast toc toolbar topbar tracking trending widget widgets".split())
NEGATING = frozenset(["with", "has", "no", "without"])

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE_END = re.compile(r"[.!?…。！？](?=\s|$|[\"'”’)])")

#: Weights used where a corpus' mark-up does not show both kinds of block: intercept first, then ``features``.
PRIOR = (-2.0, 0.9, -3.0, 1.0)


class Block(NamedTuple):
    text: str
    parent: int  # number of the element around the block's own
    apart: int  # steps through the element tree from the block before
    links: float  # share of characters inside links
    said: int  # what the mark-up says: 1 content, -1 boilerplate, 0 nothing


class _Element:
    __slots__ = ("tag", "number", "said", "firm", "unseen", "link")

    def __init__(self, tag: str, number: int, around: _Element | None):
        self.tag, self.number = tag, number
        self.said, self.firm, self.unseen, self.link = (
            (around.said, around.firm, around.unseen, around.link) if around else (0, False, False, False))


class _Parser(HTMLParser):
    """Collects blocks; forgives unclosed, misnested and stray tags as browsers do, roughly."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open = [_Element("", 0, None)]
        self.count: dict[str, int] = {}
        self.elements, self.low, self.last = 0, 1, 1
        self.parts: list[str] = []
        self.linked = 0

    def parse_marked_section(self, i, report=1):  # "<![...": an odd comment, not an error
        return self.parse_bogus_comment(i)

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag in ("br", "wbr", "img", "input"):
                self.parts.append(" " if tag != "wbr" else "")
            return
        if tag not in INLINE:
            self._flush()
            self._close("p", INLINE)
            if tag in CLOSED_BY_SAME:
                self._close(tag, None, CLOSED_BY_SAME[tag])
        self.elements += 1
        element = _Element(tag, self.elements, self.open[-1])
        if tag not in INLINE:
            self._judge(element, dict(attrs))
        element.unseen |= tag in UNSEEN
        element.link |= tag == "a"
        self.open.append(element)
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        # "<div/>" opens in HTML; elements of other vocabularies end at once
        if tag in VOID or tag in INLINE or tag not in UNSEEN:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "p":
            self._flush()
            self._close("p", INLINE)
        elif tag in INLINE:
            self._close(tag, INLINE)
        elif tag not in VOID:
            self._flush()
            self._close(tag, None, CLOSED_BY_SAME.get(tag, ()))

    def handle_data(self, data):
        top = self.open[-1]
        if not top.unseen:
            self.parts.append(data)
            if top.link:
                self.linked += len(data)

    def end(self) -> list[Block]:
        self.close()
        self._flush()
        return self.blocks

    def _close(self, tag: str, only_through=None, not_through=()):
        """Close the innermost open ``tag`` and what is in it, if the elements in between allow it."""
        if not self.count.get(tag):
            return
        for k in range(len(self.open) - 1, 0, -1):
            now = self.open[k].tag
            if now == tag:
                for e in self.open[k:]:
                    self.count[e.tag] -= 1
                del self.open[k:]
                self.low = min(self.low, k)
                return
            if now in not_through or only_through is not None and now not in only_through:
                return

    def _flush(self):
        text = " ".join("".join(self.parts).split())
        chars, linked = sum(map(len, self.parts)), self.linked
        self.parts, self.linked = [], 0
        if not text:
            return
        k = len(self.open) - 1
        while k and self.open[k].tag in INLINE:
            k -= 1
        own, depth = self.open[k], k + 1
        apart = max(1, self.last + depth - 2 * min(self.low, depth))
        self.blocks.append(Block(text, self.open[max(0, k - 1)].number, apart, min(1.0, linked / chars), own.said))
        self.last = self.low = depth

    def _judge(self, e: _Element, attrs: dict) -> None:
        role = (attrs.get("role") or "").lower()
        words = _words(f"{attrs.get('class') or ''} {attrs.get('id') or ''}")
        good = e.tag in GOOD_TAGS or role in GOOD_ROLES or (attrs.get("itemprop") or "").lower() == "articlebody"
        if e.tag in ("html", "body"):
            return
        hidden = "hidden" in attrs or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()
        bad_word = bool(words & BAD_WORDS)
        bad_part = e.tag in BAD_TAGS or role in BAD_ROLES or "header" in words and not words & GOOD_WORDS
        if e.tag == "header" and e.said > 0 and not bad_word:
            bad_part = False  # an article's own heading
        if hidden or bad_word:
            e.said, e.firm = -1, True
        elif e.firm:
            return  # nothing inside comments, adverts and the like is content
        elif good:
            e.said = 1
        elif bad_part:
            e.said = -1
        elif words & GOOD_WORDS and e.said == 0:
            e.said = 1


def _words(names: str) -> set[str]:
    out, skip = set(), False
    for name in names.split():
        for w in _WORD.findall(name):
            w = w.lower()
            if not skip:
                out.add(w)
            skip = w in NEGATING
        skip = False
    return out


def parse(html: str) -> list[Block]:
    """The blocks of a page, in page order."""
    p = _Parser()
    p.feed(html)
    return p.end()


def features(block: Block) -> list[float]:
    """Text statistics of a block. No word, tag or class name enters, so that what is learned from marked pages
    serves others; what stands around a block is the graph's part."""
    words = len(block.text.split())
    ends = len(_SENTENCE_END.findall(block.text))
    return [math.log1p(words), block.links, min(1.0, 8 * ends / max(8, words))]


def min_cut(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of least cost: True costs ``-gain`` less than False, neighbours of an edge that differ cost its capacity.

    Dinic's algorithm; a node's two terminal edges are cancelled against each other beforehand. Of
    equal cuts the one with the fewest True labels is returned.
    """
    n = len(gain)
    out: list[list[int]] = [[] for _ in range(n)]
    to, cap = [], []
    for u, v, c in edges:
        out[u].append(len(to))
        out[v].append(len(to) + 1)
        to += [v, u]
        cap += [c, c]
    source, sink = [max(0, g) for g in gain], [max(0, -g) for g in gain]
    while True:
        starts = [i for i in range(n) if source[i]]
        level, queue, reached = [-1] * n, list(starts), False
        for i in starts:
            level[i] = 0
        for u in queue:
            reached = reached or sink[u] > 0
            for e in out[u]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        tried = [0] * n
        for s in starts:
            path, u = [], s
            while source[s]:
                if sink[u]:
                    flow = min([source[s], sink[u], *(cap[e] for e in path)])
                    source[s] -= flow
                    sink[u] -= flow
                    for e in path:
                        cap[e] -= flow
                        cap[e ^ 1] += flow
                    path, u = [], s
                    continue
                while tried[u] < len(out[u]):
                    e = out[u][tried[u]]
                    if cap[e] and level[to[e]] == level[u] + 1:
                        break
                    tried[u] += 1
                else:
                    level[u] = -2  # a dead end
                    if not path:
                        break
                    u = to[path.pop() ^ 1]
                    continue
                path.append(e)
                u = to[e]


def label(blocks: list[Block], weights: tuple[float, ...] = PRIOR) -> list[bool]:
    """Which blocks are content."""
    gain = []
    for b in blocks:
        odds = weights[0] + sum(w * v for w, v in zip(weights[1:], features(b)))
        gain.append(round(_SCALE * (max(-TEXT_LIMIT, min(TEXT_LIMIT, odds)) + MARKED * b.said)))
    edges, before = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, round(_SCALE * SMOOTH * 2 / max(2, b.apart))))
        j = before.get(b.parent, i)
        if j < i - 1:
            edges.append((j, i, round(_SCALE * SMOOTH)))
        before[b.parent] = i
    return min_cut(gain, edges)


def main_text(html: str, weights: tuple[float, ...] = PRIOR) -> str:
    blocks = parse(html)
    return "\n\n".join(b.text for b, keep in zip(blocks, label(blocks, weights)) if keep)


def fit(pages: DataFrame, html_col: str = "html", fit_pages: int = FIT_PAGES) -> tuple[float, ...]:
    """Weights (intercept first) of the block classifier, from blocks that the pages' mark-up names.

    About ``fit_pages`` whole pages by hash of their other columns' page_id and url; all if there
    are no more. Where the mark-up names one kind of block only, or none, ``PRIOR`` is returned.
    """
    total = pages.count()
    share = F.pmod(F.xxhash64(*[F.col(c) for c in ("page_id", "url") if c in pages.columns]), F.lit(1_000_000))
    some = pages if total <= fit_pages else pages.where(share < max(1, 1_000_000 * fit_pages // total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            rows = []
            for html in b.column(0):
                rows += [(float(block.said > 0), features(block)) for block in parse(html.as_py()) if block.said]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))],
                                  ["label", "x"])

    rows = written(some.select(whole_text(html_col).alias("html")).mapInArrow(run, "label double, x array<double>"), "blocks")
    if rows.select("label").distinct().count() < 2:
        return PRIOR
    model = LogisticRegression(maxIter=30, regParam=0.01).fit(rows.select("label", array_to_vector("x").alias("features")))
    return tuple(round(float(w), 6) for w in (model.intercept, *model.coefficients))


def extract(pages: DataFrame, weights: tuple[float, ...] | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (content blocks joined by two line feeds), n_chars.

    Null or empty pages, and pages without content, give an empty text; repeated rows give equal
    rows; null ids and urls stay null; an empty table gives no rows; other columns are not read.
    Character references are decoded, white space inside a block (line breaks of the mark-up too)
    becomes one space. Long pages are read whole: memory holds one page, its blocks and its graph.
    ``weights``: of a fitted classifier, else fitted on these pages.
    """
    if weights is None:
        weights = fit(pages, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            texts = [main_text(h.as_py(), weights) for h in b.column(2)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  ["page_id", "url", "text", "n_chars"])

    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         whole_text(html_col).alias("html"))
    return given.mapInArrow(run, "page_id long, url string, text string, n_chars long")
