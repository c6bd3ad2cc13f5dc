"""Main text of web pages by gradient-boosted trees over the nodes of the document tree.

Each page is parsed once into a tree of elements. An element's features are its tag, hashed class, id and role
tokens, depth, text and link density of its subtree, numbers of children and its place among its siblings,
with the same of its parent. Boosted trees give each element the log-odds of being main text.

There are no labels, so the trees learn from pages that label themselves: on a bounded sample of pages
(``sample_pages``, by hash) elements inside article or main are positive, and elements inside navigation, header, footer, aside,
form, notices, adverts and comments, known by tag or attribute token, negative. Pages without article or main are
then read by what the trees have learned.

Decoding is hierarchical: the accepted elements are those with the largest sum of log-odds, where an element can be
accepted only if none above it is rejected; a rejected element is opened, at the cost of its log-odds, when what is
accepted below outweighs it. Parts that the page itself names (``labels``) are decided by their names: article and main are
accepted, navigation, headers, footers, asides, forms, notices, adverts and comments rejected with all below them. On such pages
the trees decide only what lies outside the named parts; on pages that name nothing they decide all.

Defined results: null html is empty; very long pages take time in proportion to their length, whatever is left open; a page without main text gives an empty text; repeated pages are
treated alike; a page that is one text without tags is one block; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, hash_share

SAMPLE_PAGES, ELEMENTS, TREES, DEPTH, BINS, RATE = 400, 30, 24, 4, 16, 0.3
#: A tag whose quoted values hold no angle brackets; others are read quote by quote in ``_tokens``.
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>\"']*(?:(?:\"[^\"<>]*\"|'[^'<>]*')[^<>\"']*)*)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_MARK = re.compile(r"[<>\"']")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style", "textarea")}
_ATTR = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?|\"[^\"]*\"|'[^']*'")
#: Fixed values of HTML: empty elements, elements that make a block of their own, and what ends an open paragraph or item.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
ITEMS = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}
HEAD = frozenset(["head", "title"])
#: Elements that show no text, if their end tag comes; without it they are treated as any other, so that they hide nothing after them.
UNSEEN = frozenset(["svg", "select", "noscript", "template"])
MAIN = frozenset(["article", "main"])
OTHER = frozenset("nav header footer aside form dialog menu button".split())
#: Attribute tokens that name what is not main text.
OTHER_WORDS = frozenset("ad ads advert advertisement banner breadcrumb comment comments cookie cookies consent footer header menu "
                        "nav navbar navigation newsletter notice popup promo related share sidebar social sponsor sponsored "
                        "subscribe widget".split())
#: Attribute tokens that tell of a layout: such an element, or a form, may stand around a whole page.
AROUND = frozenset("banner header footer menu nav navbar navigation sidebar widget".split())


def _tokens(page: str) -> Iterator[tuple[str, str, str, str]]:
    """Texts as ("", "", "", text) and tags as (slash, name, attributes, ""), in one pass forward: what was looked at is consumed, so
    time is in proportion to the page whatever is left open in it.

    Comments, declarations and the contents of script, style and textarea are left out, to the end of the page if need be. A tag
    that is never closed ends before the next tag; what looks like a tag up to the end of the page is text.
    """
    at, size = 0, len(page)
    last = {c: page.rfind(c) for c in ">\"'"}
    while at < size:
        start = page.find("<", at)
        if start != at:
            yield "", "", "", page[at:start if start >= 0 else size]
            if start < 0:
                return
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page.startswith(("<!", "<?"), start) and start < last[">"]:
            at = page.find(">", start) + 1
            continue
        m = _TAG.match(page, start)
        if m:
            slash, name, attrs = m.groups()
            at = m.end()
        else:
            m = _NAME.match(page, start)
            if not m:
                yield "", "", "", "<"
                at = start + 1
                continue
            slash, name = m.groups()
            p = m.end()
            while True:
                mark = _MARK.search(page, p)
                if mark is None:
                    yield "", "", "", page[start:]
                    return
                p, c = mark.start(), mark.group()
                if c in "<>":
                    break
                p = page.find(c, p + 1) + 1 if p < last[c] and page[m.end():p].rstrip().endswith("=") else p + 1
            attrs, at = page[m.end():p], p + (c == ">")
        yield slash, name, attrs, ""
        if not slash and name.lower() in _RAW_END and (not attrs or attrs[0] in " \t\n\r\f\x0b/"):
            end = _RAW_END[name.lower()].search(page, at)
            at = page.find(">", end.end()) + 1 or size if end else size


class _Open:
    """Open elements from the root down, with the places of each tag among them."""

    def __init__(self):
        self.nodes, self.tags, self.places = [0], [""], {}

    def push(self, node: int, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.nodes))
        self.nodes.append(node)
        self.tags.append(tag)

    def cut(self, place: int) -> None:
        while len(self.nodes) > place:
            self.nodes.pop()
            self.places[self.tags.pop()].pop()

    def last(self, *tags: str) -> int:
        """Deepest place of any of these tags, or 0."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


class Node:
    __slots__ = ("tag", "words", "parent", "depth", "place", "children", "chars", "links", "tags", "label", "hidden", "unseen")

    def __init__(self, tag: str, words: list[str], parent: int, depth: int, place: int, hidden: bool):
        self.tag, self.words, self.parent, self.depth, self.place = tag, words, parent, depth, place
        self.children = self.chars = self.links = self.tags = 0
        self.label, self.hidden, self.unseen = 0, hidden, False


def parse(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements in page order (the first is the root), and texts as (element of the block, text).

    Inline elements are no nodes: their text belongs to the block around them. A line break is white space.
    UNSEEN elements leave neither nodes nor texts.
    """
    nodes, texts = [Node("", [], -1, 0, 0, False)], []
    open_, links, unseen = _Open(), 0, False
    for slash, tag, attrs, text in _tokens(page or ""):
        if not tag:
            here = open_.nodes[-1]
            texts.append((here, text))
            nodes[here].chars += len(text)
            nodes[here].links += len(text) if links > 0 else 0
            continue
        tag = tag.lower()
        if tag in _RAW_END:
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if slash else 1))
            continue
        if tag in VOID:
            texts.append((open_.nodes[-1], " "))
            continue
        if slash:
            at = open_.last(tag)
            if at:
                if tag in UNSEEN:
                    nodes[open_.nodes[at]].unseen = unseen = True
                open_.cut(at)
            links = 0
            if tag not in UNSEEN:
                texts.append((open_.nodes[-1], ""))
            continue
        # a new block ends an open paragraph, a new item the item before it in its list
        in_select = open_.last("select") > 0
        if in_select and tag not in ("option", "optgroup", "template"):  # a block ends an open select
            open_.cut(open_.places["select"][0])
        cut = open_.last("p")
        if cut and tag not in UNSEEN and open_.last(*UNSEEN) < cut:
            open_.cut(cut)
        elif tag in ITEMS:
            same = open_.last(*(("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)))
            if same > open_.last(*ITEMS[tag].split()):
                open_.cut(same)
        words, hidden = [], False
        for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
            value, name = (a or b or c).lower(), name.lower()
            hidden |= (name == "hidden" or name == "aria-hidden" and value.strip() == "true"
                       or name == "style" and "display:none" in value.replace(" ", ""))
            if name in ("class", "id", "role"):
                words += re.findall(r"[a-z]+", value)
        up = nodes[open_.nodes[-1]]
        nodes.append(Node(tag, words, open_.nodes[-1], up.depth + 1, up.children, hidden))
        up.children += 1
        links = 0
        if tag == "option" and in_select:
            nodes[-1].unseen = unseen = True
        if not attrs.endswith("/"):
            open_.push(len(nodes) - 1, tag)
        elif tag in UNSEEN:
            nodes[-1].unseen = unseen = True
            continue
        texts.append((open_.nodes[-1], ""))
    return _seen(nodes, texts) if unseen else (nodes, texts)


def _seen(nodes: list[Node], texts: list[tuple[int, str]]) -> tuple[list[Node], list[tuple[int, str]]]:
    """The page as if its unseen elements were not there."""
    new, out = np.full(len(nodes), -1), []
    for i, n in enumerate(nodes):
        if n.unseen or i and new[n.parent] < 0:
            continue
        new[i], n.children = len(out), 0
        if i:
            n.parent = int(new[n.parent])
            n.place = out[n.parent].children
            out[n.parent].children += 1
        out.append(n)
    return out, [(int(new[at]), text) for at, text in texts if new[at] >= 0]


def features(nodes: list[Node], named: bool = True) -> np.ndarray:
    """One row for each element; without names the landmarks and paragraphs are plain divisions and have no attribute tokens."""
    own = np.zeros((len(nodes), 10), np.float32)
    total = np.array([[n.chars, n.links, 1] for n in nodes], np.float64)
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
        total[nodes[i].parent] += total[i]
    for i, n in enumerate(nodes):
        tag, words = (n.tag, n.words) if named else ("div" if n.tag in MAIN or n.tag in OTHER or n.tag == "p" else n.tag, ())
        own[i] = (_code(tag), _code(words[0]) if words else -1, _code(words[-1]) if words else -1,
                  n.depth, np.log1p(total[i, 0]), total[i, 1] / max(total[i, 0], 1), np.log1p(total[i, 2]),
                  total[i, 0] / total[i, 2], n.place, n.children)
    up = np.array([max(n.parent, 0) for n in nodes])
    share = (total[:, 0] / np.maximum(total[up, 0], 1)).astype(np.float32)
    kin = np.array([nodes[p].children for p in up], np.float32)
    return np.column_stack([own, own[up], share, kin])


def _code(word: str) -> float:
    return _CODES.setdefault(word, float(xxhash.xxh32_intdigest(word) % 256))


_CODES: dict[str, float] = {}
#: Columns that hold codes: trees ask whether they are equal to a value, of the others whether they are above one.
_CODED = np.array([0, 1, 2, 10, 11, 12])


def labels(nodes: list[Node]) -> np.ndarray:
    """1 inside article or main, -1 inside other named parts, 0 unknown; the nearest named ancestor decides.

    What is inside another named part stays there, an article too (a comment, a teaser), but where the page has no article or main
    elsewhere and nothing but a form or AROUND stands around it: then it is main text.
    """
    away = np.zeros(len(nodes), np.int8)  # 1 a part that may be around main text, 2 another named part
    for i, n in enumerate(nodes):
        said = OTHER_WORDS.intersection(n.words) if n.words and n.tag not in ("html", "body") else ()
        if n.tag in HEAD or n.hidden or n.tag in OTHER and n.tag != "form" or not AROUND.issuperset(said):
            away[i] = 2
        elif n.tag in OTHER or said:
            away[i] = 1
    above = np.zeros(len(nodes), np.int8)  # the worst of an element and those above it
    for i, n in enumerate(nodes):
        above[i] = max(away[i], above[n.parent]) if i else away[i]
    mains = [i for i, n in enumerate(nodes) if n.tag in MAIN and not away[i]]
    elsewhere = any(above[i] == 0 for i in mains)
    out = np.zeros(len(nodes), np.int8)
    for i, n in enumerate(nodes):
        up = out[n.parent] if i else 0
        if away[i]:
            out[i] = -1
        elif n.tag in MAIN and (up >= 0 or not elsewhere and above[i] < 2):
            out[i] = 1
        else:
            out[i] = up
    return out


class Trees:
    """Boosted regression trees for log-odds, each of DEPTH levels; a level of a tree may ask differently in each node."""

    def __init__(self):
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        tests = []
        for f in range(x.shape[1]):
            if f in _CODED:
                values, n = np.unique(x[:, f], return_counts=True)
                tests += [(f, v, True) for v in values[np.argsort(-n)][:BINS]]
            else:
                cuts = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
                tests += [(f, v, False) for v in cuts]
        answers = np.array([x[:, f] == v if eq else x[:, f] > v for f, v, eq in tests], np.float32)  # tests x rows
        z = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p) + 1e-6
            leaf, asked = np.zeros(len(y), np.int64), []
            for _ in range(DEPTH):
                level = {}
                for node in np.unique(leaf):
                    at = leaf == node
                    a = answers[:, at]
                    g1, h1 = a @ g[at], a @ h[at]
                    g0, h0 = g[at].sum() - g1, h[at].sum() - h1
                    gain = g1 * g1 / (h1 + 1) + g0 * g0 / (h0 + 1)
                    level[int(node)] = int(gain.argmax())
                asked.append(level)
                bit = np.array([level[int(n)] for n in range(int(leaf.max()) + 1) if n in level])
                index = {n: k for k, n in enumerate(sorted(level))}
                t = bit[np.array([index[int(n)] for n in leaf])]
                leaf = leaf * 2 + answers[t, np.arange(len(y))].astype(np.int64)
            values = np.zeros(1 << DEPTH)
            np.add.at(values, leaf, g)
            weight = np.bincount(leaf, h, 1 << DEPTH)
            values = RATE * values / (weight + 1)
            z += values[leaf]
            self.trees.append(([{n: tests[t] for n, t in level.items()} for level in asked], values))
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for levels, values in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for level in levels:
                yes = np.zeros(len(x), np.int64)
                for node, (f, v, eq) in level.items():
                    at = leaf == node
                    if at.any():
                        yes[at] = x[at, f] == v if eq else x[at, f] > v
                leaf = leaf * 2 + yes
            z += values[leaf]
        return z


_SPACE = re.compile(r"\s+")
#: Least log-odds of an element that the page itself marks as main text.
MARKED = 1.0


def choose(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """1 for accepted elements, 0 for opened ones (rejected, but something below is accepted), -1 for rejected with all below.

    Of all choices in which nothing is accepted or opened below a rejected element, the one with the largest sum of log-odds over
    accepted and opened elements; the root, html and body are open. Named parts go first: elements marked as main text
    are accepted, other named parts rejected, and opened only around an article or main that counts.
    """
    named = labels(nodes)
    odds = np.where(named > 0, np.maximum(odds, MARKED), odds)
    around = named > 0
    for i in range(len(nodes) - 1, 0, -1):
        around[nodes[i].parent] |= around[i]
    total = odds.copy()  # of the best choice in the subtree
    for i in range(len(nodes) - 1, 0, -1):
        if total[i] > 0 and named[i] >= 0:
            total[nodes[i].parent] += total[i]
    state = np.zeros(len(nodes), np.int8)
    for i, n in enumerate(nodes):
        if i and state[n.parent] < 0:
            state[i] = -1
        elif named[i] < 0:
            state[i] = 0 if around[i] and i else -1
        elif odds[i] > 0:
            state[i] = 1
        else:
            state[i] = 0 if i == 0 or n.tag in ("html", "body") or around[i] or total[i] > 0 else -1
    return state


def decode(nodes: list[Node], texts: list[tuple[int, str]], odds: np.ndarray) -> str:
    """Blocks of accepted elements in page order."""
    state = choose(nodes, odds)
    blocks, parts, last = [], [], None

    def close():
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        if text:
            blocks.append(text)
        parts.clear()

    for at, text in texts:
        if at != last or text == "":
            close()
            last = at
        if state[at] > 0:
            parts.append(text)
    close()
    return "\n\n".join(blocks)


def _samples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        xs, ys = [], []
        for page in pdf["html"]:
            nodes, _ = parse(page)
            y = labels(nodes)
            keep = np.flatnonzero(y) if (y > 0).any() else np.empty(0, int)
            keep = keep[np.unique(np.linspace(0, len(keep) - 1, ELEMENTS).astype(int))] if len(keep) > ELEMENTS else keep
            for named in (True, False):
                xs.append(features(nodes, named)[keep].astype(np.float32).tobytes())
                ys.append(y[keep].tobytes())
        yield pd.DataFrame({"x": xs, "y": ys})


def train(pages: DataFrame, html_col: str = "html", key_col: str = "page_id", sample_pages: int = SAMPLE_PAGES) -> Trees | None:
    """Trees from at most about ``sample_pages`` pages, chosen by hash, and ELEMENTS elements of each, once as they
    are and once without their names: so the trees learn from density and place as well, for pages that name nothing."""
    n = pages.count()
    if not n:
        return None
    some = pages.where(hash_share(F.col(key_col).cast("string"), 3) < min(1.0, sample_pages / n))
    rows = some.select(F.col(html_col).alias("html")).mapInPandas(_samples, "x binary, y binary").toPandas()
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, 22) if len(rows) else np.empty((0, 22), np.float32)
    y = (np.frombuffer(b"".join(rows["y"]), np.int8) > 0).astype(float) if len(rows) else np.empty(0)
    if not len(y) or y.min() == y.max():
        return None
    order = np.lexsort([*x.T, y])  # the order of rows must not decide the training
    return Trees().fit(x[order], y[order])


def extract(pages: DataFrame, key_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``pages`` without the html column, with its main text. Where nothing could be learned, the named parts decide."""
    bounded_batches(pages.sparkSession, 500)
    model = pages.sparkSession.sparkContext.broadcast(train(pages, html_col, key_col, sample_pages))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, found = model.value, {}
        for pdf in batches:
            parsed = [parse(p) for p in pdf.pop(html_col)]
            if trees is None:
                odds = [np.where(labels(n) < 0, -1.0, 1.0) for n, _ in parsed]
            else:
                x = np.concatenate([features(n) for n, _ in parsed])
                odds = np.split(trees.log_odds(x), np.cumsum([len(n) for n, _ in parsed])[:-1])
            yield pdf.assign(**{"__text": [decode(n, t, o) for (n, t), o in zip(parsed, odds)]})

    rest = [c for c in pages.columns if c != html_col]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html_col] + ["__text string"])
    out = pages.mapInPandas(run, schema)
    return out.select(*[c for c in rest if c != "text"], F.col("__text").alias("text"))
