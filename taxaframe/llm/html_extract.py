"""Main text of web pages by boosted trees over DOM-node features.

A tolerant parser gives the element tree and, as leaves, the text runs between block
borders. Every node gets features (tag, attribute tokens of its own and of its ancestors,
text and link density of its subtree, depth, sibling statistics, place in the page), and a
gradient-boosted ensemble gives the probability that its subtree holds main text. Decoding
is hierarchical: the most likely labelling in which nothing below a rejected node is
accepted, so ancestors and descendants never contradict. Accepted runs are the text.

The ensemble is fitted on at most ``sample_pages`` pages of at most ``sample_chars`` characters (smallest hashes of the id) that mark
their article semantically; copies of these pages with the marks renamed and with notices,
comments, sidebars, forms, adverts and menus put in teach the other features.

Character references are decoded, white space within a block becomes one space, blocks are
joined by one line feed. Null and empty pages give an empty text; null ids and urls are carried;
repeated rows give repeated rows; empty tables give no rows; very long pages are read whole. If no page
marks an article, the fit uses two built-in example pages. Other columns are ignored.
"""

from __future__ import annotations

import html as _html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTR = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title iframe".split())
#: No main text where closed by their own tag; one that never closes takes nothing with it.
_REJECTED = set("noscript select svg template".split())
_FOREIGN = set("math svg".split())
_BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = _BLOCK - set("body head html option td th tr tbody thead tfoot caption legend".split())
#: A paragraph outside these is not closed by a block inside them.
_HOLDS_P = set("article aside blockquote body dd details div figure footer form header li main nav section table td th noscript object select svg template".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_NEGATIVE = re.compile(r"(?:^|[^a-z])(?:ad|ads|advert\w*|banner|breadcrumb\w*|comment\w*|cookie\w*|copyright|disclaimer|discussion|dialog|footer|foot|form|header|login|masthead|menu\w*|meta|modal|nav\w*|newsletter|notice\w*|alert|pager|pagination|popup|promo\w*|recommend\w*|related|repl(?:y|ies)|respond|share|sharing|side|sidebar\w*|signup|social|sponsor\w*|subscribe\w*|tags|toolbar|widget\w*|complementary|contentinfo|search)(?:$|[^a-z])", re.I)
_POSITIVE = re.compile(r"(?:^|[^a-z])(?:article\w*|body|content|entry|main|post|story|text)(?:$|[^a-z])", re.I)
_TAGS = "text p h1 h2 h3 li ul ol dl table td div section article main body html blockquote pre figure nav header footer aside form head fieldset details button a".split()
_TAG_NUMBER = {t: i + 1 for i, t in enumerate(_TAGS)}


class Node:
    __slots__ = ("tag", "parent", "kids", "attrs", "text", "chars", "links", "tags", "order", "neg", "pos", "within", "gone", "pieces", "border")

    def __init__(self, tag: str, parent: "Node | None", attrs: str = "", order: int = 0):
        self.tag, self.parent, self.attrs, self.order = tag, parent, attrs, order
        self.kids: list[Node] = []
        self.text, self.chars, self.links, self.tags = "", 0, 0, 0
        self.within: Node | None = None  # the innermost open element of _REJECTED
        self.gone = False  # of _REJECTED and closed
        self.pieces: list[tuple] = []  # of a run after the first such element
        self.border = 0  # number of its end among the ends of runs
        names = " ".join(filter(None, (x for m in _ATTR.findall(attrs) for x in m))) if attrs else ""
        self.neg = len(_NEGATIVE.findall(names)) if names else 0
        self.pos = len(_POSITIVE.findall(names)) if names else 0


def parse(html: str) -> tuple[Node, list[Node]]:
    """(root, all block elements and text runs in page order)."""
    root = Node("html", None)
    nodes, stack = [root], [root]  # open elements, inline ones too
    buffer: list[tuple[str, int, Node | None]] = []  # text, its characters in links, the element of _REJECTED around it
    rejected: list[Node] = []
    borders: list[Node | None] = []  # ends of runs: the element of _REJECTED around each
    within: Node | None = None
    n_links = 0

    def block() -> Node:
        return next(n for n in reversed(stack) if n.tag in _BLOCK)

    def fill(run: Node, pieces: list[tuple]):
        run.text = " ".join("".join(p[0] for p in pieces).split())
        run.chars = len(run.text)
        run.links = min(sum(p[1] for p in pieces), run.chars)

    def flush():
        if not all(p[0].isspace() or not p[0] for p in buffer):
            run = Node("text", block(), order=len(nodes))
            fill(run, buffer)
            if rejected:
                run.pieces, run.border = list(buffer), len(borders)
            run.parent.kids.append(run)
            nodes.append(run)
        buffer.clear()
        borders.append(within)

    def add(text: str):
        if text:
            text = _html.unescape(text)
            buffer.append((text, len(text.strip()) if n_links else 0, within))

    def pop_to(at: int):
        nonlocal n_links, within
        if any(n.tag in _BLOCK for n in stack[at:]):
            flush()
        n_links -= sum(n.tag == "a" for n in stack[at:])
        del stack[at:]
        if within:
            within = next((n for n in reversed(stack) if n.tag in _REJECTED), None)

    at, lower = 0, None
    while m := _TOKEN.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        closing, tag, attrs = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if found:
                stack[found].gone = tag in _REJECTED
                pop_to(found)
            elif tag in _BLOCK:
                flush()
            continue
        foreign = (tag in _RAW or attrs.endswith("/")) and any(n.tag in _FOREIGN for n in stack)
        if tag in _RAW and not (foreign and tag == "title"):
            if not attrs.endswith("/"):
                lower = html.lower() if lower is None or len(lower) != len(html) else lower
                end = lower.find(f"</{tag}", at)
                at = len(html) if end < 0 else end
            continue
        if tag == "html" or attrs.endswith("/") and (foreign or tag in _REJECTED or tag in _FOREIGN or tag == "object"):
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                buffer.append((" ", 0, within))
            continue
        if tag in _CLOSES_P:
            p = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag in _HOLDS_P), 0)
            if p and stack[p].tag == "p":
                pop_to(p)
        if tag in _SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _SAME[tag]:
                    pop_to(i)
                    break
                if stack[i].tag in _SCOPE[tag]:
                    break
        if tag in _BLOCK:
            flush()
            parent = block()
            node = Node(tag, parent, attrs, len(nodes))
            node.within = within
            parent.kids.append(node)
            nodes.append(node)
            stack.append(node)
        else:
            stack.append(Node(tag, stack[-1]))
            if tag in _REJECTED:
                stack[-1].within, within = within, stack[-1]
                rejected.append(within)
            n_links += tag == "a"
            if len(stack) > 400:  # inline tags that never close: forget the oldest of the run
                stack[:] = [n for n in stack if n.tag in _BLOCK or n.tag in _REJECTED]
                n_links = 0
    add(html[at:])
    flush()
    for n in rejected:
        n.gone = n.gone or n.within is not None and n.within.gone
    if any(n.gone for n in rejected):
        left = lambda n: n is None or not n.gone
        stays = lambda n: left(n.within) and (n.tag != "text" or bool(n.text))
        for n in nodes:
            if n.pieces:
                n.pieces = [p for p in n.pieces if left(p[2])]
                fill(n, n.pieces)
        for n in nodes:
            kids: list[Node] = []
            for k in filter(stays, n.kids):
                last = kids[-1] if kids else k
                # runs that only a dropped element parts are one
                if last is not k and last.pieces and k.pieces and not any(map(left, borders[last.border : k.border])):
                    last.pieces, last.border = last.pieces + k.pieces, k.border
                    fill(last, last.pieces)
                    fill(k, [])
                else:
                    kids.append(k)
            n.kids = kids
        nodes = [n for n in nodes if stays(n)]
    for node in reversed(nodes):
        if node.parent:
            node.parent.chars += node.chars
            node.parent.links += node.links
            node.parent.tags += node.tags + 1
    return root, nodes


N_FEATURES = 22


def features(nodes: list[Node]) -> np.ndarray:
    out = np.zeros((len(nodes), N_FEATURES), np.float32)
    total = max(1, nodes[0].chars)
    up: dict[int, tuple] = {}
    tags: dict[int, Counter] = {}  # of the children of each node
    before = 0
    for i, n in enumerate(nodes):
        p = n.parent
        depth, neg, pos, article, bad, link = up[p.order] if p else (0, 0, 0, 0, 0, 0)
        up[n.order] = (depth + 1, neg + n.neg, pos + n.pos, article or n.tag in ("article", "main"), bad or n.tag in ("nav", "header", "footer", "aside", "form", "menu", "head", "dialog", "fieldset"), link)
        depth, neg, pos, article, bad, _ = up[n.order]
        sib = p.kids if p else [n]
        if n.kids:
            tags[n.order] = Counter(k.tag for k in n.kids)
        same = tags[p.order][n.tag] if p else 1
        text = n.text
        words = text.count(" ") + 1 if text else 0
        out[i] = (
            _TAG_NUMBER.get(n.tag, 0), _TAG_NUMBER.get(p.tag, 0) if p else 0, math.log1p(n.chars), n.links / max(1, n.chars), n.chars / (n.tags + 1), n.tags,
            depth, len(sib), same, neg, pos, n.neg, n.pos, article, bad, before / total, n.chars / total,
            words, sum(text.count(c) for c in ".,;!?") / max(1, words), len(n.kids), (p.chars if p else n.chars) / total, (p.links / max(1, p.chars)) if p else 0,
        )
        if n.tag == "text":
            before += n.chars
    return out


class Boosted:
    """Gradient-boosted regression trees for the logistic loss over binned features."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, least: int = 8):
        self.n, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], 1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        self.edges = []
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            mid = (values[1:] + values[:-1]) / 2
            self.edges.append(mid if len(mid) < self.bins else np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])))
        b = self._bin(x)
        width = max(len(e) for e in self.edges) + 1
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        z = np.full(len(y), self.base)
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, p * (1 - p) + 1e-9
            size = 2 ** (self.depth + 1) - 1
            feature, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
            at = np.zeros(len(y), np.int64)
            for node in range(size):
                rows = np.flatnonzero(at == node)
                if not len(rows):
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                value[node] = -gs / (hs + 1)
                if node >= 2**self.depth - 1 or len(rows) < 2 * self.least:
                    continue
                best = (1e-6, -1, 0)
                for f in range(x.shape[1]):
                    col = b[rows, f]
                    gl, hl, nl = (np.cumsum(np.bincount(col, w, width))[:-1] for w in (g[rows], h[rows], None))
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    gain[(nl < self.least) | (len(rows) - nl < self.least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
                if best[1] >= 0:
                    feature[node], cut[node] = best[1], best[2]
                    at[rows] = 2 * node + 1 + (b[rows, best[1]] > best[2])
            self.trees.append((feature, cut, value))
            z += self.rate * value[at]
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                at = np.where(f < 0, at, 2 * at + 1 + (b[rows, np.maximum(f, 0)] > cut[at]))
            z += self.rate * value[at]
        return z


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The most likely labels with no accepted node below a rejected one."""
    yes = np.where(odds > 0, 0, odds) - np.log1p(np.exp(-np.abs(odds)))
    no = yes - odds
    place = {n.order: i for i, n in enumerate(nodes)}
    take, leave = yes.tolist(), no.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        p = place[nodes[i].parent.order]
        take[p] += max(take[i], leave[i])
        leave[p] += leave[i]
    kept = [True] * len(nodes)
    for i, n in enumerate(nodes):
        kept[i] = take[i] > leave[i] and (n.parent is None or kept[place[n.parent.order]])
    return kept


# --- training pages --------------------------------------------------------------------------

#: Wrappers put into copies of training pages: what they hold is no main text.
_NOISE = (
    '<div class="comments"><h3>{a}</h3><div class="comment"><p>{b}</p></div><div class="comment"><p>{c}</p></div></div>',
    '<section id="comments"><p>{b}</p><p>{c}</p></section>', '<ol class="comment-list"><li>{b}</li><li>{c}</li></ol>',
    '<aside><h2>{a}</h2><p>{b}</p></aside>', '<div class="sidebar"><p>{b}</p><ul><li><a href="/">{a}</a></li></ul></div>', '<aside class="related"><a href="/">{a}</a></aside>',
    '<div class="cookie-notice"><p>{b}</p><button>{a}</button></div>', '<div id="notice">{b}</div>', '<div role="alert"><p>{b}</p></div>',
    '<form action="/"><label>{a}</label><input name="q"><p>{b}</p></form>', '<div class="newsletter"><form><p>{b}</p></form></div>',
    '<div class="ad">{b}</div>', '<div class="advert"><p>{b}</p></div>', '<div class="ads"><a href="/">{a}</a> {b}</div>', '<div class="promo"><p>{b}</p></div>',
    '<header><h2>{a}</h2><p>{b}</p></header>', '<div class="menu"><a href="/">{a}</a> <a href="/">{a}</a></div>', '<nav><a href="/">{a}</a></nav>',
    '<footer><p>{b}</p></footer>', '<div class="footer">{b}</div>', '<div class="share"><a href="/">{a}</a></div>', '<div class="banner">{b}</div>',
)
_EXAMPLES = tuple(
    f'<html><body><nav><ul><li><a href="/">Home</a></li><li><a href="/a">News</a></li></ul></nav><div class="ad">Buy this now and save a lot.</div><article><h1>A title of the page</h1>{"".join(f"<p>Some long paragraph, number {i}, that tells of things which happened. It goes on for a while, as such texts do.</p>" for i in range(k))}</article><footer>All rights reserved, example.</footer></body></html>'
    for k in (3, 9)
)
_NO_TEXT = set("nav header footer aside form menu dialog head fieldset button".split())


def _targets(nodes: list[Node]) -> np.ndarray:
    """1 for nodes whose subtree holds main text by the page's own marks."""
    state: dict[int, tuple[bool, bool]] = {}
    out = np.zeros(len(nodes))
    place = {n.order: i for i, n in enumerate(nodes)}
    for i, n in enumerate(nodes):
        inside, out_of = state[n.parent.order] if n.parent else (False, False)
        if "data-mark=" in n.attrs:
            inside, out_of = (True, False) if 'data-mark="1"' in n.attrs else (inside, True)
        inside = inside or n.tag in ("article", "main")
        out_of = out_of or n.tag in _NO_TEXT or (n.neg > 0 and n.tag not in ("article", "main", "body", "html"))
        state[n.order] = (inside, out_of)
        if n.tag == "text" and inside and not out_of:
            while n is not None and not out[place[n.order]]:
                out[place[n.order]] = 1
                n = n.parent
    return out


def _variants(pages: list[str], draw: random.Random) -> Iterator[str]:
    runs = [n.text for p in pages[:50] for n in parse(p)[1] if n.text]
    for page in pages:
        yield page
        for _ in range(3):
            new = page
            if draw.random() < 0.6:
                mark = draw.choice(['<div class="content" data-mark="1">', '<div id="main" data-mark="1">', '<section class="post" data-mark="1">', '<div data-mark="1">', '<main data-mark="1">', '<div class="article-body" data-mark="1">'])
                new = re.sub(r"<(?:article|main)\b[^>]*>", lambda m, x=mark: x, new)
                new = re.sub(r"</(?:article|main)>", f"</{re.match(r'<(\w+)', mark)[1]}>", new)
            for _ in range(draw.randint(1, 4)):
                a, b, c = (draw.choice(runs) for _ in range(3))
                noise = draw.choice(_NOISE).format(a=_html.escape(a[:60]), b=_html.escape(b[: draw.choice([40, 120, 400, 2000])]), c=_html.escape(c[:300]))
                noise = re.sub(r"^<(\w+)", r'<\1 data-mark="0"', noise)
                borders = [m.end() for m in re.finditer(r"</(?:p|h1|nav|article|main|section)>|<body[^>]*>", new)] or [len(new)]
                at = draw.choice(borders)
                new = new[:at] + noise + new[at:]
            yield new


def fit_extractor(pages: DataFrame, sample_pages: int = 150, sample_chars: int = 60_000, id_col: str = "page_id", html_col: str = "html") -> Boosted:
    """An ensemble fitted on at most ``sample_pages`` pages of at most ``sample_chars`` characters that
    hold an article or main element: the driver fits, so both bound its memory. Extraction reads every page whole."""
    marked = pages.filter(F.col(html_col).rlike(r"(?i)<(article|main)\b") & (F.length(html_col) <= sample_chars))
    marked = marked.select(F.col(html_col).alias("h"), F.xxhash64(F.col(id_col)).alias("o0"), F.xxhash64(F.col(html_col)).alias("o1"))
    # only hashes are ordered; the pages of the chosen ones follow, a repeated page once
    chosen = marked.select("o0", "o1").distinct().orderBy("o0", "o1").limit(sample_pages)
    pages_of = marked.join(F.broadcast(chosen), ["o0", "o1"]).dropDuplicates(["o0", "o1"])
    sample = [r["h"] for r in sorted(pages_of.collect(), key=lambda r: (r["o0"], r["o1"]))] or list(_EXAMPLES)
    xs, ys = [], []
    for page in _variants(sample, random.Random(5)):
        _, nodes = parse(page)
        xs.append(features(nodes))
        ys.append(_targets(nodes))
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys))


def extract_pages(pages: DataFrame, model: Boosted, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and main text of every page."""
    held = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                trees = [parse(h)[1] for h in part.column(2).to_pylist()]
                odds = held.value.log_odds(np.concatenate([features(t) for t in trees]))
                texts, lo = [], 0
                for nodes in trees:
                    kept = decode(nodes, odds[lo : lo + len(nodes)])
                    texts.append("\n".join(n.text for n, k in zip(nodes, kept) if k and n.text))
                    lo += len(nodes)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.coalesce(F.col(html_col), F.lit(""))).mapInArrow(run, "page_id long, url string, text string")
