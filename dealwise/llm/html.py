"""Main text of web pages: gradient-boosted trees over DOM-node features.

A page is parsed into block elements; the text between block boundaries is a block
of text.  Each element gets features (subtree density, link share, attribute
tokens, depth, sibling statistics), and boosted trees give the probability that it
belongs to the main text.  Decoding is hierarchical: on every path from the root
the states run outside -> inside -> excluded, so nothing is kept inside an excluded
element and the kept part of a path is one piece.  A tree programme takes the best
assignment.

The trees are fitted on at most ``SAMPLE_PAGES`` pages with at most ``SAMPLE_CHARS``
characters, chosen by hash of the url.  Their teacher is markup that says what it
is (article, nav, class tokens).  Each page is also shown with such hints removed,
renamed and with further boilerplate put in, so that the trees do not depend on one
template.  Every page is extracted from its whole html.

Null and empty pages give an empty text.  Broken markup is read leniently: unknown
or unclosed tags never fail.  Rows, repeats and other columns stay.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import hash_sample, small_batches

SAMPLE_PAGES = 300
SAMPLE_CHARS = 50_000
TREES, TREE_DEPTH, BINS, RATE = 30, 4, 32, 0.3

# HTML element kinds.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "select", "object", "canvas")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big button cite code data del dfn em font i ins kbd label mark q s samp small "
                    "span strike strong sub sup time tt u var").split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table div article section main body".split())
# Words in tags, classes, ids and roles that say what an element is for.
GOOD = ("article", "main", "content", "post", "entry", "story", "body", "text", "prose")
BAD = ("nav", "navigation", "menu", "header", "masthead", "banner", "footer", "sidebar", "aside", "complementary", "ad", "ads",
       "advert", "advertisement", "promo", "sponsor", "sponsored", "cookie", "consent", "notice", "alert", "popup", "modal",
       "comment", "comments", "reply", "replies", "disqus", "form", "search", "newsletter", "subscribe", "signup", "login",
       "share", "social", "related", "recommended", "breadcrumb", "breadcrumbs", "pagination", "widget", "tags", "copyright")
_GOOD, _BAD = frozenset(GOOD), frozenset(BAD)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S | re.I)
_HINT = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "up", "depth", "kids", "hints", "blocks", "chars", "link", "n_blocks", "marks", "order", "tags")

    def __init__(self, tag: str, up: "Node | None", hints: frozenset[str]):
        self.tag, self.up, self.hints = tag, up, hints
        self.depth = up.depth + 1 if up else 0
        self.kids: list[Node] = []
        self.blocks: list[int] = []
        self.chars = self.link = self.n_blocks = self.marks = self.order = self.tags = 0


def _hints(tag: str, attributes: str) -> frozenset[str]:
    words = {tag}
    if attributes:
        for m in _HINT.finditer(attributes):
            words.update(_SPLIT.split((m[1] or m[2] or m[3] or "").lower()))
    return frozenset(words & (_GOOD | _BAD))


def parse(page: str) -> tuple[list[Node], list[str]]:
    """Block elements in document order (the root first) and the texts of their blocks."""
    root = Node("html", None, frozenset())
    nodes, texts = [root], []
    at, run, linked, links = root, [], 0, 0  # linked: inside <a>

    def flush() -> None:
        nonlocal run, linked
        text = _SPACE.sub(" ", entities.unescape("".join(run))).strip() if run else ""
        if text:
            at.blocks.append(len(texts))
            texts.append(text)
            at.chars += len(text)
            at.link += min(linked, len(text))
            at.marks += text.count(".") + text.count(",")
        run, linked = [], 0

    place = 0
    for m in _TOKEN.finditer(page):
        start = m.start()
        if start > place:
            piece = page[place:start]
            run.append(piece)
            if links:
                linked += len(piece.strip())
        place = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br" or tag == "hr" or tag == "img":
            run.append(" ")
            if tag != "hr":
                continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if m[2] else 1
            at.tags += not m[2]
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if m[2]:
            node = at
            while node is not None and node.tag != tag:
                node = node.up
            if node is not None and node.up is not None:
                at = node.up
            continue
        if at.tag == "p" or (at.tag[0] == "h" and at.tag[1:].isdigit()):
            at = at.up or root
        ends = CLOSES.get(tag)
        if ends:
            node = at
            while node.up is not None and node.tag not in ends and node.tag not in SCOPE:
                node = node.up
            if node.tag in ends and node.up is not None:
                at = node.up
        node = Node(tag, at, _hints(tag, m[4]))
        at.kids.append(node)
        at = node
        nodes.append(node)
    if place < len(page):
        run.append(page[place:])
    flush()
    for k, node in enumerate(nodes):
        node.order = k
        node.n_blocks += len(node.blocks)
    for node in reversed(nodes):  # subtree sums
        if node.up is not None:
            up = node.up
            up.chars += node.chars
            up.link += node.link
            up.n_blocks += node.n_blocks
            up.marks += node.marks
            up.tags += node.tags + 1
    return nodes, texts


KINDS = (("p", "blockquote", "pre"), ("li", "ul", "ol", "dl", "dt", "dd"), ("h1", "h2", "h3", "h4", "h5", "h6"),
         ("article", "main"), ("nav", "aside", "footer", "header", "form"), ("div", "section"), ("table", "tr", "td", "th"))
_KIND = {t: k for k, ts in enumerate(KINDS) for t in ts}
N_FEATURES = 22


def features(nodes: list[Node]) -> list[list[float]]:
    """One row per element; also what its ancestors say."""
    root = nodes[0]
    total, n = max(root.chars, 1), len(nodes)
    said: list[tuple[int, int]] = []  # nearest hint above: good, bad
    rows = []
    place = [0] * n  # among its siblings
    for node in nodes:
        for i, kid in enumerate(node.kids):
            place[kid.order] = i
    for node in nodes:
        up = node.up
        good = 1 if node.hints & _GOOD else 0
        bad = 1 if node.hints & _BAD else 0
        above = said[up.order] if up else (0, 0)
        said.append((1 if good and not bad else above[0], 1 if bad else above[1]))
        family = up.kids if up else [node]
        chars, blocks = node.chars, node.n_blocks
        around = up.chars - chars if up else 0
        rows.append([
            chars ** 0.25, node.link / chars if chars else 0.0, chars / (node.tags + 1), blocks, chars / (blocks or 1),
            node.marks / (chars / 100 + 1), chars / total, node.depth, node.order / n, len(node.kids), len(family),
            place[node.order] / len(family), around / (len(family) - 1) if len(family) > 1 else 0.0,
            chars / (around + chars) if chars else 0.0, up.link / up.chars if up and up.chars else 0.0,
            up.chars / total if up else 1.0, len(node.blocks), _KIND.get(node.tag, len(KINDS)), good, bad, above[0], above[1]])
    return rows


def decode(nodes: list[Node], log_in: list[float], log_out: list[float]) -> list[bool]:
    """Whether each element is inside the main text: the best assignment in which every path
    runs outside -> inside -> excluded.  An element weighs with its own text and a little."""
    n = len(nodes)
    outside, inside, excluded = [0.0] * n, [0.0] * n, [0.0] * n
    for k in range(n - 1, -1, -1):
        node = nodes[k]
        yes, no = log_in[k], log_out[k]
        a, b, c = no, yes, no
        for kid in node.kids:
            j = kid.order
            a += max(outside[j], inside[j])
            b += max(inside[j], excluded[j])
            c += excluded[j]
        outside[k], inside[k], excluded[k] = a, b, c
    state = [0] * n
    for k, node in enumerate(nodes):
        above = state[node.up.order] if node.up else 0
        if above == 0:
            state[k] = 1 if inside[k] > outside[k] else 0
        elif above == 1:
            state[k] = 1 if inside[k] >= excluded[k] else 2
        else:
            state[k] = 2
    return [s == 1 for s in state]


class Boosted:
    """Gradient-boosted regression trees for the logistic loss, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        bins = self._binned(x)
        share = float((weight * y).sum() / weight.sum()) if len(y) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        z = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            tree = self._grow(bins, weight * (y - p), weight * p * (1 - p))
            self.trees.append(tree)
            z += self._tree(bins, tree)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1).astype(np.int16)

    @staticmethod
    def _grow(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = 2 ** (TREE_DEPTH + 1)
        feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        at = np.ones(len(bins), int)  # heap positions
        for level in range(TREE_DEPTH + 1):
            first, width = 2 ** level, 2 ** level
            slot = at - first
            live = (slot >= 0) & (slot < width)
            g = np.bincount(slot[live], grad[live], width)
            h = np.bincount(slot[live], hess[live], width)
            value[first:first + width] = RATE * g / (h + 1.0)
            if level == TREE_DEPTH:
                break
            best = np.full(width, 1e-3)
            for f in range(bins.shape[1]):
                key = slot[live] * BINS + bins[live, f]
                gl = np.bincount(key, grad[live], width * BINS).reshape(width, BINS).cumsum(axis=1)[:, :-1]
                hl = np.bincount(key, hess[live], width * BINS).reshape(width, BINS).cumsum(axis=1)[:, :-1]
                gr, hr = g[:, None] - gl, h[:, None] - hl
                gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - (g ** 2 / (h + 1))[:, None]
                gain[(hl < 0.5) | (hr < 0.5)] = 0
                top = gain.argmax(axis=1)
                won = gain[np.arange(width), top] > best
                best[won] = gain[np.arange(width), top][won]
                feature[first:first + width][won] = f
                cut[first:first + width][won] = top[won]
            split = live & (feature[at] >= 0)
            right = bins[np.arange(len(bins)), np.maximum(feature[at], 0)] > cut[at]
            at = np.where(split, 2 * at + right, at)
        return feature, cut, value

    @staticmethod
    def _tree(bins: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        feature, cut, value = tree
        at, rows = np.ones(len(bins), int), np.arange(len(bins))
        for _ in range(TREE_DEPTH):
            f = feature[at]
            at = np.where(f >= 0, 2 * at + (bins[rows, np.maximum(f, 0)] > cut[at]), at)
        return value[at]

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        bins = self._binned(x)
        z = np.full(len(x), self.base)
        for tree in self.trees:
            z += self._tree(bins, tree)
        return z


# ------------------------------------------------------------------ teaching

_TEACH_BAD = re.compile(r"<(nav|aside|footer|header|form)\b", re.I)


def teach(nodes: list[Node]) -> list[bool] | None:
    """What self-describing markup says about each element; None if it says nothing."""
    state: list[int] = []
    for node in nodes:
        above = state[node.up.order] if node.up else 0
        if above == 2 or (node.hints & _BAD and not (node.hints & {"article", "main"})):
            state.append(2)
        elif above == 1 or node.tag in ("article", "main") or node.hints & {"article", "main", "entry", "story"}:
            state.append(1)
        else:
            state.append(0)
    return [s == 1 for s in state] if 1 in state else None


def _words(text: str, rng: random.Random, n: int) -> str:
    words = text.split() or ["word"]
    return " ".join(rng.choice(words) for _ in range(n))


def _boilerplate(text: str, rng: random.Random) -> list[str]:
    """Elements that are not main text, filled with the page's own words."""
    name = rng.choice(("sidebar", "comments", "cookie-notice", "newsletter", "related", "share", "banner", "widget"))
    long = " ".join(f"<p>{_words(text, rng, rng.randint(5, 40))}.</p>" for _ in range(rng.randint(1, 5)))
    items = "".join(f'<li><a href="#">{_words(text, rng, rng.randint(1, 6))}</a></li>' for _ in range(rng.randint(3, 9)))
    return [f'<div class="{name}">{long}</div>', f'<aside class="{name}"><h3>{_words(text, rng, 2)}</h3><ul>{items}</ul></aside>',
            f'<section id="comments"><h2>Comments</h2>{long}</section>',
            f'<form action="#"><label>{_words(text, rng, 3)}</label><input><p>{_words(text, rng, 6)}</p></form>',
            f'<header class="masthead"><div>{_words(text, rng, 3)}</div><ul>{items}</ul></header>',
            f'<div class="cookie-notice" role="alert"><p>{_words(text, rng, rng.randint(6, 25))}.</p></div>']


def lessons(page: str, seed: int) -> list[tuple[str, bool]]:
    """The page itself and variants (page, whether hints are hidden from the features)."""
    rng = random.Random(seed)
    out = [(page, False), (page, True)]
    if m := re.search(r"<(article|main)\b[^>]*>", page, re.I):
        text = re.sub(r"<[^>]*>", " ", page[m.end():m.end() + 4000])
        parts = _boilerplate(text, rng)
        before = "".join(rng.sample(parts, rng.randint(1, 2)))
        after = "".join(rng.sample(parts, rng.randint(1, 3)))
        inside = rng.choice(parts) if rng.random() < 0.5 else ""
        end = page.lower().rfind(f"</{m[1].lower()}")
        if end > m.end():
            spread = page[:m.start()] + before + page[m.start():end] + inside + page[end:]
            close = spread.lower().rfind(f"</{m[1].lower()}")
            close = spread.find(">", close) + 1
            spread = spread[:close] + after + spread[close:]
            out += [(spread, False), (spread, True)]
    return out


def fit(pages: list[str]) -> Boosted | None:
    """Trees from a bounded list of pages."""
    xs, ys, ws = [], [], []
    for k, page in enumerate(pages):
        for lesson, hidden in lessons(page, k):
            nodes, _ = parse(lesson)
            truth = teach(nodes)
            if truth is None:
                continue
            if hidden:
                for node in nodes:
                    node.hints = frozenset()
                    if _KIND.get(node.tag) in (3, 4):
                        node.tag = "div"
            xs += features(nodes)
            ys += truth
            ws += [1.0 + (sum(1 for _ in node.blocks) > 0) for node in nodes]
    if not any(ys):
        return None
    return Boosted(np.array(xs, float), np.array(ys, float), np.array(ws))


def extract(pages: list[str], model: Boosted | None) -> list[tuple[str, list[int]]]:
    """Main text of each page, and the numbers of the blocks kept.  Without a model (no page
    to learn from) the markup's own hints decide, or else all text is kept."""
    parsed = [parse(page) for page in pages]
    kept: list[list[bool]] = []
    if model is not None:
        rows = [r for nodes, _ in parsed for r in features(nodes)]
        z = model.margin(np.array(rows, float)) if rows else np.zeros(0)
        yes = -np.logaddexp(0, -z)
        no = -np.logaddexp(0, z)
        at = 0
        for nodes, _ in parsed:
            own = slice(at, at + len(nodes))
            at += len(nodes)
            kept.append(decode(nodes, yes[own].tolist(), no[own].tolist()))
    else:
        kept = [teach(nodes) or [True] * len(nodes) for nodes, _ in parsed]
    out = []
    for (nodes, texts), flags in zip(parsed, kept):
        blocks = sorted(b for node, ok in zip(nodes, flags) if ok for b in node.blocks)
        out.append(("\n".join(texts[b] for b in blocks), blocks))
    return out


def main_text(df: DataFrame, html: str = "html", url: str = "url", out: str = "main",
              sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Add the struct column ``out``: ``text`` (blocks joined by newlines, empty if none)
    and ``n_blocks``.  A column already named ``out`` is replaced."""
    small_batches(df.sparkSession)
    given = df.select(F.col(html).alias("h"), F.col(url).alias("u"))
    chosen = hash_sample(given.where(F.length("h").between(1, SAMPLE_CHARS)), sample_pages, ["u", "h"], total=df.count())
    model = fit([r["h"] for r in chosen.collect()])
    kind = pa.struct([("text", pa.string()), ("n_blocks", pa.int64())])

    @F.arrow_udf("struct<text string, n_blocks bigint>")
    def body(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            found = extract([x or "" for x in column.to_pylist()], model)
            yield pa.array([{"text": t, "n_blocks": len(b)} for t, b in found], kind)

    return df.withColumn(out, body(F.col(html)))
