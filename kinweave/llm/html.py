"""Main text of web pages: boosted trees over DOM nodes and a consistent choice of subtrees."""
from __future__ import annotations

import math
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, table

#: Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head title script style noscript template iframe svg object select option textarea button form".split())
BLOCK = set("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
TAGS = "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li a nav aside header footer form table td blockquote pre span b i".split()
#: Cells that attribute words are hashed into, beside the counts of known ones.
CELLS = 16
#: Attribute words of boilerplate and of content.
AWAY = set("ad ads advert advertisement banner breadcrumb comment comments cookie footer header login menu nav navigation newsletter notice pagination popup promo related share sidebar social sponsor widget".split())
TOWARD = set("article body content entry main post story text".split())
OUT_TAGS = HIDDEN | {"nav", "aside", "footer", "menu"}
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt", "li"}
AGAIN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Tree(HTMLParser):
    """Elements in page order (tag, parent, attribute words) and texts with their element."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.up, self.marks = ["html"], [-1], [frozenset()]
        self.texts: list[tuple[int, str]] = []
        self.open = [0]
        self.feed(html)
        self.close()

    def shut(self, names, stop=BLOCK) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[k]]
            if tag in names:
                del self.open[k:]
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag in CLOSES_P:
            self.shut({"p"})
        if tag in AGAIN:
            self.shut(AGAIN[tag], {"ul", "ol", "dl", "table", "select"})
        words = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))
        self.tags.append(tag)
        self.up.append(self.open[-1])
        self.marks.append(frozenset(re.findall(r"[a-z]+", words.lower())))
        if tag in VOID:
            if tag in ("br", "hr"):  # others stand inside a line, or even a word
                self.texts.append((len(self.tags) - 1, " "))
        else:
            self.open.append(len(self.tags) - 1)

    def handle_endtag(self, tag):
        self.shut({tag}, {"article", "main", "body"} if tag not in ("article", "main", "body") else set())

    def handle_data(self, data):
        self.texts.append((self.open[-1], data))


def features(t: Tree) -> np.ndarray:
    """One row per element: tag, attribute words, depth, density and what its siblings hold."""
    n = len(t.tags)
    depth, chars, linked, stops, below, kids = (np.zeros(n) for _ in range(6))
    for at, s in t.texts:
        k = len(s.strip())
        chars[at] += k
        stops[at] += sum(s.count(c) for c in ".,!?")
    for i in range(1, n):
        depth[i] = depth[t.up[i]] + 1
        kids[t.up[i]] += 1
    place = np.zeros(n)
    seen = np.zeros(n)
    for i in range(1, n):
        place[i] = seen[t.up[i]] / kids[t.up[i]]
        seen[t.up[i]] += 1
    for i in range(n - 1, 0, -1):
        if t.tags[i] == "a":
            linked[i] = chars[i]
        for v in (chars, linked, stops):
            v[t.up[i]] += v[i]
        below[t.up[i]] += below[i] + 1
    up = np.array([max(u, 0) for u in t.up])
    code = [TAGS.index(x) if x in TAGS else len(TAGS) for x in t.tags]
    away = [len(m & AWAY) for m in t.marks]
    toward = [len(m & TOWARD) for m in t.marks]
    out_tag = [x in OUT_TAGS or x == "header" for x in t.tags]
    for i in range(1, n):
        away[i] += away[t.up[i]] + out_tag[i]
    one = np.maximum(chars, 1)
    words = np.zeros((n, CELLS))
    for i, m in enumerate(t.marks):
        for w in m:
            words[i, zlib.crc32(w.encode()) % CELLS] += 1
    return np.column_stack([code, np.array(code)[up], away, toward, depth, np.log1p(chars), linked / one, stops / one, chars / (below + 1), below, kids, place, chars / one[up], chars / one[0], words])


def teacher(t: Tree) -> np.ndarray | None:
    """Labels for learning, from pages that mark their article; None for others."""
    n = len(t.tags)
    inside, out = np.zeros(n, bool), np.zeros(n, bool)
    for i in range(n):
        u = t.up[i]
        bad = t.tags[i] in OUT_TAGS or bool(t.marks[i] & AWAY and not t.marks[i] & TOWARD)
        out[i] = bad or (i > 0 and out[u])
        inside[i] = not out[i] and (t.tags[i] in ("article", "main") or (i > 0 and inside[u]))
    if not inside.any():
        return None
    for i in range(n - 1, 0, -1):
        if inside[i]:
            inside[t.up[i]] = True
    return inside


def grow(x, g, h, depth, min_rows=10):
    """One regression tree as nested tuples (feature, cut, low, high) or a leaf value."""
    leaf = float(-g.sum() / (h.sum() + 1.0))
    if not depth or len(g) < 2 * min_rows:
        return leaf
    best, base = (1e-6, None, None), g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(x.shape[1]):
        for c in np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 19))):
            low = x[:, f] <= c
            k = int(low.sum())
            if min_rows <= k <= len(g) - min_rows:
                a, b = g[low].sum(), h[low].sum()
                gain = a * a / (b + 1) + (g.sum() - a) ** 2 / (h.sum() - b + 1) - base
                if gain > best[0]:
                    best = (gain, f, float(c))
    if best[1] is None:
        return leaf
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[low], g[low], h[low], depth - 1), grow(x[~low], g[~low], h[~low], depth - 1)


def value(tree, x) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, c, low, high = tree
    return np.where(x[:, f] <= c, value(low, x), value(high, x))


def boost(x, y, rounds: int = 24, rate: float = 0.3, depth: int = 3) -> list:
    """Gradient-boosted trees for the log odds of y."""
    s, trees = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-s))
        tree = grow(x, p - y, p * (1 - p), depth)
        trees.append(tree)
        s += rate * value(tree, x)
    return [rate, trees]


def fit(pages: DataFrame, max_pages: int = 200) -> list | None:
    """Learn from at most `max_pages` pages that mark their article, those of lowest hash; None without any."""
    ids = pages.where("html is not null").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)
    rows = pages.where("html is not null").join(F.broadcast(ids), "page_id", "left_semi").select("html")  # at most max_pages ids

    def collect(frames):
        for f in frames:
            for html in f["html"]:
                t = Tree(html)
                y = teacher(t)
                if y is not None:
                    yield pd.DataFrame({"x": list(features(t)), "y": y.astype(float)})

    got = rows.mapInPandas(collect, "x array<double>, y double").toPandas()
    return boost(np.array(got["x"].tolist()), got["y"].to_numpy()) if len(got) else None


def main_text(html: str | None, model: list | None) -> str:
    """Text of the chosen elements; choosing an element means choosing all above it.

    Among all such choices the one with the highest sum of log odds is taken.
    """
    if not html:
        return ""
    t = Tree(html)
    n = len(t.tags)
    x = features(t)
    s = sum(model[0] * value(tree, x) for tree in model[1]) if model else np.where(x[:, 2] > 0, -1.0, 1.0)
    gain = np.array(s, dtype=float)
    for i in range(n - 1, 0, -1):
        if t.tags[i] in HIDDEN:
            gain[i] = -math.inf
        gain[t.up[i]] += max(gain[i], 0.0)
    chosen, block = np.ones(n, bool), list(range(n))
    for i in range(1, n):
        u = t.up[i]
        inline = t.tags[i] not in BLOCK
        chosen[i] = chosen[u] and (gain[i] > 0 or inline and t.tags[i] not in HIDDEN)
        if inline:
            block[i] = block[u]
    out: list[list] = []
    for at, text in t.texts:
        if chosen[at]:
            if not out or out[-1][0] != block[at]:
                out.append([block[at], []])
            out[-1][1].append(text)
    blocks = (" ".join("".join(parts).split()) for _, parts in out)
    return "\n\n".join(b for b in blocks if b)


def extract(pages: DataFrame, model: list | None) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null or empty html gives empty text; urls may be null. Pages are read whole,
    however long. Repeated rows and null ids are read each; an empty table gives
    no rows; other columns are not read.
    """
    def run(b):
        texts = [main_text(h, model) for h in b["html"].to_pylist()]
        return b["page_id"], b["url"], texts, [len(x) for x in texts]

    return per_batch(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")


def op9_html(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
