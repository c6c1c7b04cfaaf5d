"""Main text of web pages by a tree-structured graphical model over their elements.

A page becomes a tree of elements and texts. Each node is content or not; a node's kind, names, amount of text and
share of links are evidence for its state (node potentials), and a child's state depends on its parent's by the
child's kind (parent-child potentials). Messages pass up from the leaves and down from the root, a level
of all pages of a batch at a time, and leave each text's marginal; texts with a marginal of a half or more are kept.

The potentials are counted on labelled pages: those whose markup tells their article (an article element or
``itemprop="articleBody"``), less what inside it is named as something else. A bounded sample of them is
enough; only the table of counts reaches the driver. Mild fixed counts stand for markup the sample lacks.

Edge cases: null, empty or broken markup gives the text that is left, maybe none; open elements end with the page;
stray end tags are passed over; columns of the input are kept and one with the name of the result is replaced;
repeated rows are rows of their own; an empty table gives an empty result. Without labelled pages the fixed
counts decide alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import ready

#: Labelled pages that the potentials are counted on (expected number of a sample by hash).
SAMPLE = 3000

# Elements by kind, elements that end no paragraph, and words in names of elements.
KINDS = {
    "page": "html body",
    "article": "article main",
    "box": "div section center figure table tbody thead tfoot tr td th dl fieldset hgroup details",
    "menu": "nav menu",
    "header": "header",
    "footer": "footer address",
    "side": "aside dialog",
    "form": "form",
    "hidden": "head title script style noscript template svg canvas iframe object select option textarea button datalist audio video map math",
    "heading": "h1 h2 h3 h4 h5 h6",
    "paragraph": "p pre blockquote figcaption caption dt dd summary",
    "list": "ul ol",
    "item": "li",
    "link": "a",
    "inline": "abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby s samp small span strike strong sub sup time tt u var wbr",
}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
OTHER_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
    disclaimer footer form header login masthead menu meta nav navbar navigation newsletter notice notices outbrain pager
    pagination popup promo promoted related reply replies respond search share sharing sidebar signup social sponsor
    sponsored subscribe taboola tags toolbar tooltip widget complementary contentinfo alert warning warnings response responses
    copyright colophon legal modal recommended""".split()
)
PART_NAMES = frozenset("area bar block body box container form item items line link links list panel section text thread wrap wrapper".split())
CONTENT_NAMES = frozenset(
    "article articlebody body content entry main maincontent page post postbody story storybody text".split()
)

_KIND_NAMES = [*KINDS, "text"]
_KIND = {tag: i for i, (_, tags) in enumerate(KINDS.items()) for tag in tags.split()}
_BOX, _HIDDEN, _LINK, _INLINE, _TEXT = (_KIND_NAMES.index(k) for k in ("box", "hidden", "link", "inline", "text"))
_PARAGRAPH = _KIND_NAMES.index("paragraph")
_OTHER_KINDS = frozenset(_KIND_NAMES.index(k) for k in ("menu", "side", "footer", "form", "hidden"))
_TAG = re.compile(
    r"""<(?:!--(?:.*?-->|.*)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[!?][^>]*+>)""", re.DOTALL
)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_UNSEEN = re.compile(r"""(?:^|\s)hidden(?:[\s=]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_HOLD = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}

N_KINDS, NAMES, SIZES, SHARES = len(_KIND_NAMES), 3, 8, 4
#: Weight of the evidence of sizes and link shares: nested elements hold the same text, so it counts in part.
OVERLAP = 0.3
#: Counts: transitions (kind, parent, child), names (kind, state, name), sizes and link shares (kind, state, bucket).
SHAPES = ((N_KINDS, 2, 2), (N_KINDS, 2, NAMES), (N_KINDS, 2, SIZES), (N_KINDS, 2, SHARES))


def _other_name(word: str) -> bool:
    """Whether a word of a name is one of other parts of a page, alone or before a part's name ("commentlist")."""
    if word in OTHER_NAMES:
        return True
    return any(word[:k] in OTHER_NAMES and word[k:] in PART_NAMES for k in range(2, len(word) - 2))


def _names_of(attributes: str, memo: dict[str, tuple[int, bool]]) -> tuple[int, bool]:
    """(0 none, 1 content, 2 other; unseen) from an element's attributes."""
    known = memo.get(attributes)
    if known is None:
        words = {w.lower() for value in _NAMES.findall(attributes) for w in _NAME_WORD.findall(value)}
        joined = {re.sub("[^a-z]", "", v.lower()) for v in _NAMES.findall(attributes)}
        name = 2 if any(map(_other_name, words)) else 1 if (words | joined) & CONTENT_NAMES else 0
        known = (name, bool(_UNSEEN.search(attributes)))
        if len(memo) < 10_000:
            memo[attributes] = known
    return known


class Pages:
    """Trees of several pages, node by node in page order; a parent comes before its children."""

    def __init__(self):
        self.parent: list[int] = []
        self.kind: list[int] = []
        self.name: list[int] = []
        self.depth: list[int] = []
        self.size: list[int] = []
        self.linked: list[int] = []
        self.article: list[bool] = []
        self.texts: list[tuple[int, int, int, str]] = []
        self.memo: dict[str, tuple[int, bool]] = {}
        self.page = self.block = 0

    def _node(self, parent: int, kind: int, name: int, size: int = 0, linked: int = 0, article: bool = False) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.name.append(name)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.size.append(size)
        self.linked.append(linked)
        self.article.append(article)
        return len(self.parent) - 1

    def add(self, html: str | None) -> None:
        """Append a page."""
        html = html or ""
        root = self._node(-1, _KIND["html"], 0)
        tags, nodes = ["#root"], [root]
        at, end, links = 0, len(html), 0
        # No tag ends after the last bracket, so that open ones are not looked at again and again.
        search, last = _TAG.search, html.rfind(">") + 1

        def close(depth: int) -> None:
            nonlocal links
            links -= tags[depth:].count("a")
            del tags[depth:], nodes[depth:]

        def put(text: str) -> None:
            if text and not text.isspace():
                shown = len(text)
                leaf = self._node(nodes[-1], _TEXT, 0, shown, shown if links else 0)
            else:
                leaf = -1
            if text:
                self.texts.append((self.page, self.block, leaf, text))

        while at < end:
            m = search(html, at, last) if at < last else None
            if m is None:
                rest, _, _ = html[at:].partition("<!--")
                put(rest)
                break
            if m.start() > at:
                put(html[at : m.start()])
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            kind = _KIND.get(tag, _BOX if "-" in tag else _INLINE)
            inline = kind == _INLINE or kind == _LINK
            if not inline:
                self.block += 1
            if m[1]:
                for depth in range(len(tags) - 1, 0, -1):
                    if tags[depth] == tag:
                        close(depth)
                        break
                continue
            if tag in VOID:
                if tag == "br":
                    self.texts.append((self.page, self.block, -1, " "))
                elif tag == "hr":
                    self.block += 1
                continue
            if tag in ("html", "body") and tag in tags:
                continue
            attributes = m[3]
            name, unseen = _names_of(attributes, self.memo) if attributes.strip() else (0, False)
            if not inline and kind != _HIDDEN and "p" in tags:
                for depth in range(len(tags) - 1, 0, -1):
                    if tags[depth] == "p":
                        close(depth)
                        break
                    if _KIND.get(tags[depth], _INLINE) not in (_INLINE, _LINK):
                        break
            if tag in _ENDS:
                for depth in range(len(tags) - 1, 0, -1):
                    if tags[depth] in _ENDS[tag]:
                        close(depth)
                        break
                    if tags[depth] in _HOLD[tag]:
                        break
            marked = tag == "article" or "articlebody" in attributes.lower()
            node = self._node(nodes[-1], _HIDDEN if unseen else kind, name, article=marked)
            if tag in RAW:
                stop = re.compile(rf"</{tag}\s*+[^>]*+>", re.IGNORECASE).search(html, at)
                at = stop.end() if stop else end
                continue
            if not attributes.rstrip().endswith("/") or tag not in ("path", "rect"):
                tags.append(tag)
                nodes.append(node)
                links += tag == "a"
        self.page += 1
        self.block += 1

    def arrays(self) -> dict[str, np.ndarray]:
        """Columns of the nodes, with the text of whole subtrees added up and put into buckets."""
        columns = {k: np.array(getattr(self, k), np.int64) for k in ("parent", "kind", "name", "depth", "size", "linked")}
        levels = [np.flatnonzero(columns["depth"] == d) for d in range(int(columns["depth"].max(initial=-1)) + 1)]
        for own in reversed(levels[1:]):
            np.add.at(columns["size"], columns["parent"][own], columns["size"][own])
            np.add.at(columns["linked"], columns["parent"][own], columns["linked"][own])
        size = columns["size"]
        share = columns["linked"] / np.maximum(size, 1)
        columns["sizes"] = np.searchsorted([1, 10, 25, 60, 150, 400, 1500], size, side="right")
        columns["shares"] = np.searchsorted([0.01, 0.3, 0.7], share, side="right")
        columns["levels"] = levels
        return columns


def told_states(pages: Pages, columns: dict[str, np.ndarray]) -> np.ndarray:
    """1 for content, 0 for other nodes, -1 where a page does not tell its article."""
    n = len(pages.parent)
    inside, state, page, told = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(pages.page, bool)
    article = np.array(pages.article, bool)
    page = np.cumsum(columns["parent"] < 0) - 1
    told[np.unique(page[article])] = True
    other = (columns["name"] == 2) | np.isin(columns["kind"], list(_OTHER_KINDS))
    barred = other.copy()
    for own in columns["levels"]:
        up = columns["parent"][own]
        held = np.where(up >= 0, inside[np.maximum(up, 0)], False)
        inside[own] = held | article[own]
        barred[own] = other[own] | (np.where(up >= 0, barred[np.maximum(up, 0)], False) & held)
    state[:] = inside & ~barred
    return np.where(told[page], state, -1)


def prior_counts() -> list[np.ndarray]:
    """Mild counts for what a sample may lack: states last, content begins at articles, other kinds are not content."""
    move, name, size, share = (np.full(shape, smooth) for shape, smooth in zip(SHAPES, (0.5, 0.01, 0.5, 0.5)))
    for k, kind in enumerate(_KIND_NAMES):
        move[k] += [[40.0, 0.5], [0.5, 40.0]]
        if kind == "article":
            move[k] = [[0.1, 40.0], [0.5, 40.0]]
        if kind == "box":
            move[k] += [[0.0, 2.0], [3.0, 0.0]]
        if kind == "header":
            move[k] += [[20.0, 0.0], [20.0, 0.0]]
        if k in _OTHER_KINDS:  # not content wherever they stand, so this outweighs that states last
            move[k] = [[80.0, 0.1], [80.0, 0.1]]
        name[k] += [[20.0, 0.2, 16.0], [20.0, 2.0, 0.0]]
    size += np.array([[8, 8, 6, 4, 2, 1, 1, 1], [2, 2, 2, 4, 6, 8, 8, 8]])[None]
    share += np.array([[4, 2, 2, 8], [16, 3, 0.5, 0.5]])[None]
    return [move, name, size, share]


def tally(pages: Pages, total: list[np.ndarray]) -> None:
    """Adds the counts of labelled pages."""
    c = pages.arrays()
    state = told_states(pages, c)
    up = c["parent"]
    own = np.flatnonzero((state >= 0) & (up >= 0))
    np.add.at(total[0], (c["kind"][own], state[up[own]], state[own]), 1)
    for table, column in zip(total[1:], ("name", "sizes", "shares")):
        np.add.at(table, (c["kind"][own], state[own], c[column][own]), 1)


def potentials(counts: list[np.ndarray]) -> list[np.ndarray]:
    summed = [a + b for a, b in zip(counts, prior_counts())]
    logs = [np.log(t / t.sum(axis=-1, keepdims=True)) for t in summed]
    # Long texts speak for content; that a text is short says next to nothing, as articles have short ones too.
    sizes = np.stack((np.zeros_like(logs[2][:, 0]), np.maximum(logs[2][:, 1] - logs[2][:, 0], -0.01)), axis=1)
    return [logs[0], logs[1], OVERLAP * sizes, OVERLAP * logs[3]]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(c: dict[str, np.ndarray], tables: list[np.ndarray]) -> np.ndarray:
    """Probability of content for every node, by sum-product messages up and down the trees."""
    move, *rest = tables
    kind, parent = c["kind"], c["parent"]
    below = sum(t[kind, :, c[name]] for t, name in zip(rest, ("name", "sizes", "shares")))
    below[kind == _HIDDEN, 1] -= 60
    up = np.zeros_like(below)
    for own in reversed(c["levels"][1:]):
        up[own] = _log_sum(move[kind[own]] + below[own][:, None, :], 2)
        np.add.at(below, parent[own], up[own])
    above = np.zeros_like(below)
    if c["levels"]:
        above[c["levels"][0]] = np.log([0.99, 0.01])
    for own in c["levels"][1:]:
        context = above[parent[own]] + below[parent[own]] - up[own]
        above[own] = _log_sum(context[:, :, None] + move[kind[own]], 1)
    both = above + below
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))


def main_texts(htmls: list[str | None], tables: list[np.ndarray]) -> list[str]:
    pages = Pages()
    for html in htmls:
        pages.add(html)
    chance = marginals(pages.arrays(), tables)
    parts: list[list[str]] = [[] for _ in htmls]
    at, run, kept = None, [], False

    def flush() -> None:
        if kept:
            shown = " ".join(unescape("".join(run)).split())
            if shown:
                parts[at[0]].append(shown)

    for page, block, leaf, text in pages.texts:
        if (page, block) != at:
            flush()
            at, run, kept = (page, block), [], False
        if leaf < 0:
            run.append(text)
        elif chance[leaf] >= 0.5:
            run.append(text)
            kept = True
    flush()
    return [" ".join(p) for p in parts]


def train(pages: DataFrame, html: str, chosen: Column, sample: int = SAMPLE) -> list[np.ndarray]:
    """Potentials from a sample of the labelled pages. chosen: a hash that decides which pages are sampled."""
    labelled = pages.filter(F.col(html).rlike("(?i)<article[\\s>]|articleBody"))
    n = labelled.count()
    taken = labelled.filter(F.pmod(chosen, F.lit(2**20)) < -(-sample * 2**20 // n)) if n else labelled

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(shape) for shape in SHAPES]
        for batch in batches:
            own = Pages()
            for page in batch.column(0):
                own.add(page.as_py())
            tally(own, total)
        flat = np.concatenate([t.reshape(-1) for t in total])
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(flat[used])], ["i", "n"])

    summed = taken.select(html).mapInArrow(count, "i int, n double").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    flat = np.zeros(sum(int(np.prod(shape)) for shape in SHAPES))
    flat[summed["i"].to_numpy(int)] = summed["n"].to_numpy(float)
    edges = np.cumsum([0, *(int(np.prod(shape)) for shape in SHAPES)])
    return potentials([flat[a:b].reshape(shape) for a, b, shape in zip(edges, edges[1:], SHAPES)])


def extract(pages: DataFrame, tables: list[np.ndarray], html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with their main text."""
    ready(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(tables)

    @F.arrow_udf("string")
    def text_of(htmls: pa.Array) -> pa.Array:
        own = htmls.to_pylist()
        found: list[str] = []
        for at in range(0, len(own), 256):
            found += main_texts(own[at : at + 256], sent.value)
        return pa.array(found, pa.string())

    return pages.withColumn(into, text_of(F.col(html)))
