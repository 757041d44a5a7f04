"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes text blocks in page order. A logistic classifier gives each block the cost of calling it content
or boilerplate; these costs are the capacities from the source and to the sink. Neighbouring blocks and
blocks with one parent are joined by smoothness edges, the stronger the more of the document tree they
share. The blocks on the source's side after a maximum flow are the text.

The classifier is fitted on at most ``FIT_PAGES`` pages, those whose html hashes least: blocks inside article or main elements are
examples of content, those inside navigation, footers, asides and forms of boilerplate. It starts from,
and is drawn towards, ``PRIOR``; for half of the pages the element names are hidden, so the weights of length, links
and names of classes are learnt as well. Every page and every block is labelled; nothing is cut or capped.

Defined results: null and empty pages, and pages without content, give an empty text; a page without any
element is one block; broken markup is read leniently (open elements end with their parents); repeated rows are rows of their own.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.llm.arrowtext import with_columns

FIT_PAGES = 400
SMOOTHNESS = 0.8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_HINTS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VALUES = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|$)", re.I)
_UNSHOWN = re.compile(r"aria-hidden\s*=\s*[\"']?true|\bstyle\s*=\s*(?:\"[^\"]*|'[^']*)display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg canvas iframe select button textarea title object audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter output q s samp small span strike strong "
    "sub sup time tt u var wbr br".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_HINTS = frozenset("article content main post entry story body text prose".split())
BOILER_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended share sharing social follow "
    "subscribe subscription newsletter signup login register search comment comments reply replies disqus discussion respond footer header masthead "
    "copyright legal disclaimer pagination pager tags toolbar contentinfo complementary".split())
#: Words that say where or what kind of box a part is, and first words of names that tell what else is on the page.
BOX_WORDS = frozenset(
    "left right top bottom main primary secondary list item items box block wrapper wrap container inner outer section area bar panel "
    "link links form title text content body button buttons group row column icon count author meta module region".split())
ABOUT_WORDS = frozenset("has have with without no not is".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: Features and the weights towards which the fit is drawn (positive: content).
FEATURES = ("bias", "boiler_tag", "boiler_hint", "article", "content_hint", "log_words", "links", "sentence", "heading", "item", "copyright")
PRIOR = np.array([-1.0, -6.0, -6.0, 4.0, 2.0, 0.6, -3.0, 0.5, 0.5, -0.5, -2.0])
SEMANTIC = [1, 3]


def hinted(name: str) -> tuple[bool, bool]:
    """Whether a class, id or role names (boilerplate, content), going by the whole name.

    The last word says what a thing is (``site-footer``), or the first one does and the others where it is
    (``sidebar-left``); a boilerplate word elsewhere (``search-page``, ``has-sidebar``) says nothing of what is inside.
    """
    words = [w.lower() for w in _PARTS.findall(name)]
    if not words or words[0] in ABOUT_WORDS:
        return False, False
    boiler = [w in BOILER_HINTS for w in words]
    if boiler[-1] or (boiler[0] and all(x or w in BOX_WORDS for x, w in zip(boiler, words))):
        return True, False
    return False, not any(boiler) and any(w in CONTENT_HINTS for w in words)


class _Node:
    __slots__ = ("article", "block", "boiler_tag", "content_hint", "depth", "heading", "hinter", "item", "link", "name", "outer_hinter", "parent", "proper")

    def __init__(self, name: str, attributes: str, parent: _Node | None):
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        boiler = content = False
        if attributes and name not in ("html", "body"):
            for a, b, c in _HINTS.findall(attributes):
                for word in (a or b or c).split():
                    one, other = hinted(word)
                    boiler, content = boiler or one or word == "hidden", content or other
            if boiler and content:
                boiler = content = False
            if _HIDDEN.search(_VALUES.sub(" ", attributes)) or _UNSHOWN.search(attributes):
                boiler, content = True, False
        up = parent
        self.article = name in ("article", "main") or bool(up and up.article)
        outer_header = name == "header" and not self.article
        self.boiler_tag = name in BOILER_TAGS or outer_header or bool(up and up.boiler_tag)
        self.outer_hinter = up.hinter if up else None
        self.hinter = self if boiler else self.outer_hinter
        self.content_hint = content or bool(up and up.content_hint)
        self.proper = name in ("article", "main", "h1") or content
        self.link = name == "a" or bool(up and up.link)
        self.heading = (len(name) == 2 and name[0] == "h" and name[1].isdigit()) or bool(up and up.heading)
        self.item = name in ("li", "td", "dt", "dd") or bool(up and up.item)
        self.block = self if name not in INLINE or up is None else up.block


def _boiler_hints(owners: list[_Node], words: list[int], wrappers: set[_Node]) -> list[bool]:
    """Whether a boilerplate name counts for each block.

    It does not if its element holds most of the page's words and the content's own element is inside it.
    """
    held: dict[_Node, int] = {}
    for owner, n in zip(owners, words):
        at = owner.hinter
        while at is not None:
            held[at] = held.get(at, 0) + n
            at = at.outer_hinter
    total, out = sum(words), []
    for owner in owners:
        at = owner.hinter
        while at is not None and at in wrappers and 2 * held[at] > total:
            at = at.outer_hinter
        out.append(at is not None)
    return out


def blocks_of(html: str) -> tuple[list[str], np.ndarray, list[tuple[int, int, float]]]:
    """(texts, features, edges (i, j, weight)) of a page's blocks."""
    root = _Node("", "", None)
    node, texts, features, edges = root, [], [], []
    parts: list[tuple[str, bool]] = []
    owner, least, last_of = root, 0, {}

    def flush():
        nonlocal parts, least
        if not parts:
            return
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            size = sum(len(t.strip()) for t, _ in parts) or 1
            words = text.count(" ") + 1
            k = len(texts)
            features.append((
                1.0, owner.boiler_tag, False, owner.article, owner.content_hint, np.log1p(words),
                sum(len(t.strip()) for t, link in parts if link) / size, text[-1] in ".!?:;…\"'”)", owner.heading, owner.item,
                "©" in text or "copyright" in text.lower(),
            ))
            texts.append(text)
            if k:
                shared = min(least, owner.depth)
                edges.append((k - 1, k, SMOOTHNESS * (1 + shared) / (1 + max(owner.depth, depths[-1]))))
            key = id(owner.parent)
            if key in last_of and last_of[key] < k - 1:
                edges.append((last_of[key], k, SMOOTHNESS / 2))
            last_of[key] = k
            keep.append(owner)
            depths.append(owner.depth)
            least = owner.depth
        parts = []

    keep: list[_Node] = []
    wrappers: set[_Node] = set()
    depths: list[int] = []

    def add(text: str):
        nonlocal owner
        if text:
            if not parts:
                owner = node.block
            parts.append((unescape(text), node.link))

    at, end = 0, len(html)
    while at < end:
        found = _TOKEN.search(html, at)
        if not found:
            add(html[at:])
            break
        add(html[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name == "br" or (name in VOID and name in INLINE):
            if name == "br" and parts:
                parts.append((" ", node.link))
            continue
        if name not in INLINE:
            flush()
        if found["end"]:
            up = node
            while up is not None and up.name != name:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
                least = min(least, node.depth)
            continue
        if name in VOID:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if name in CLOSES or name not in INLINE:
            up = node
            while up.parent is not None and (up.name in INLINE or up.name in CLOSES.get(name, ()) or (up.name == "p" and name not in INLINE)):
                if up.name not in INLINE:
                    node = up.parent
                    least = min(least, node.depth)
                    if up.name == name or up.name == "p":
                        break
                up = up.parent
        if not found["attributes"].rstrip().endswith("/"):
            node = _Node(name, found["attributes"], node)
            if node.proper and node.outer_hinter is not None:
                wrappers.add(node.outer_hinter)
    flush()
    matrix = np.array(features, np.float64).reshape(len(texts), len(FEATURES))
    matrix[:, 2] = _boiler_hints(keep, [t.count(" ") + 1 for t in texts], wrappers)
    return texts, matrix, edges


def source_side(to_source: np.ndarray, to_sink: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Mask of the nodes on the source's side of a minimum cut (Dinic's algorithm).

    ``to_source`` is paid by a node cut off from the source, ``to_sink`` by one that stays with it.
    """
    n = len(to_source)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(u, v, there, back):
        heads[u].append(len(to))
        heads[v].append(len(to) + 1)
        to.extend((v, u))
        room.extend((there, back))

    for k in range(n):
        net = float(to_source[k] - to_sink[k])
        if net > 0:
            join(source, k, net, 0.0)
        elif net < 0:
            join(k, sink, -net, 0.0)
    for u, v, w in edges:
        join(u, v, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in heads[u]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return np.array([level[k] >= 0 for k in range(n)], bool)
        turn = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[u] < len(heads[u]):
                e = heads[u][turn[u]]
                if room[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            else:
                if u == source:
                    break
                level[u] = -1
                u = to[path.pop() ^ 1]
                continue
            path.append(e)
            u = to[e]


def page_text(html: str | None, weights: np.ndarray) -> str:
    """The content blocks of one page."""
    texts, features, edges = blocks_of(html or "")
    if not texts:
        return ""
    score = features @ weights
    mask = source_side(np.logaddexp(0, score), np.logaddexp(0, -score), edges)
    return "\n\n".join(t for t, m in zip(texts, mask) if m)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [blocks_of(h or "")[1] for h in batch.column(0).to_pylist()]
        matrix = np.concatenate([*rows, np.empty((0, len(FEATURES)))])
        yield pa.RecordBatch.from_arrays([pa.array(matrix.tolist(), pa.list_(pa.float64()))], names=["x"])


def fit(pages: DataFrame, html_col: str = "html", fit_pages: int = FIT_PAGES) -> np.ndarray:
    """Weights of the block classifier."""
    chosen = pages.select(F.col(html_col).cast("string").alias("html")).where("html is not null")
    chosen = chosen.orderBy(F.xxhash64("html")).limit(fit_pages)
    rows = chosen.mapInArrow(_examples, "x array<double>").toArrow().column("x").to_pylist()
    x = np.array(rows, np.float64).reshape(len(rows), len(FEATURES))
    boiler = (x[:, 1] > 0) | (x[:, 2] > 0)
    known = boiler | (x[:, 3] > 0)
    x, y = x[known], (~boiler[known]).astype(np.float64)
    if not len(x):
        return PRIOR.copy()
    hidden = x.copy()
    hidden[:, SEMANTIC] = 0
    x, y = np.concatenate([x, hidden]), np.concatenate([y, y])
    weights = PRIOR.copy()
    for _ in range(25):  # Newton steps of the penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) / len(x) - 0.02 * (weights - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + 0.02 * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def _extractor(weights: np.ndarray, html_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(h.as_py(), weights) for h in batch.column(html_col)]
            yield with_columns(batch.drop_columns([html_col]), {"text": pa.array(texts, pa.string())})

    return run


def main_texts(pages: DataFrame, html_col: str = "html", weights: np.ndarray | None = None) -> DataFrame:
    """The pages with ``text`` instead of the html; an input column of that name is replaced."""
    weights = fit(pages, html_col) if weights is None else weights
    pages = pages if html_col == "text" else pages.drop("text")
    kept = [f for f in pages.schema.fields if f.name != html_col]
    return pages.mapInArrow(_extractor(weights, html_col), T.StructType([*kept, T.StructField("text", T.StringType())]))
