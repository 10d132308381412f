"""Main text of web pages by a tree-structured graphical model.

Every block element and every run of text of a page is a node with a hidden
label, content or not. A node has a potential from what it looks like (its
element, class words, length, share of links), and each parent-child edge one
from the pair of labels and the child's kind. The page is a tree, so one pass
of sum-product messages upward and one downward give exact marginals. The
potentials are learnt from labelled pages by gradient ascent on the
likelihood, with the same messages.

All nodes of a batch of pages form one forest, worked off level by level in
numpy; Spark deals the pages, and nothing is shuffled.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.dom import TEXT, Page
from panelcast.llm.page_layouts import labelled_pages
from panelcast.llm.token_cache import in_blocks

#: Elements with a potential of their own; all others share one.
NAMED = ("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tr td th pre blockquote "
         "figure figcaption nav header footer aside form menu dialog details summary address fieldset legend center").split()
_NAME = {n: k + 1 for k, n in enumerate(NAMED)}
N_NAMES = len(NAMED) + 1
#: Kinds of edges, by the child: text, the elements above, the same with class, id or role words.
N_EDGES = 1 + 2 * N_NAMES
HASHED = 1024
SIZES = np.array([1, 2, 4, 8, 16, 32, 64, 128])
SHARES = np.array([0.01, 0.2, 0.5, 0.9])
PARTS = np.array([0.02, 0.1, 0.3, 0.6])
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|\b(hidden|display\s*:\s*none)\b""", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARK = re.compile(r'data-content="([01])"')
# Places of the feature groups in the weight vector.
_AT, _next = {}, 0
for _group, _n in (("text", 1), ("in", N_NAMES), ("words", 9), ("links", 5), ("ends", 2), ("commas", 3), ("sign", 2),
                   ("element", N_NAMES), ("below", 9), ("below links", 5), ("part", 5), ("hashed", HASHED)):
    _AT[_group] = _next
    _next += _n
N_FEATURES = _next


def attr_features(attrs: str, seen: dict) -> list[int]:
    """Places of an element's class, id and role words in the weight vector."""
    got = seen.get(attrs)
    if got is None:
        words = set()
        for m in _ATTR.finditer(attrs):
            words.update(w.lower() for w in _PIECE.findall(m[2])) if m[2] else words.add("!hidden")
        got = sorted({_AT["hashed"] + zlib.crc32(w.encode()) % HASHED for w in words})
        if len(seen) > 20_000:
            seen.clear()
        seen[attrs] = got
    return got


class Forest:
    """The nodes of some pages as arrays, with their features and levels."""

    def __init__(self, sources: list[str], seen: dict | None = None):
        seen = {} if seen is None else seen
        parent, name, text, linked, page, marks = [], [], [], [], [], []
        rows, cols = [], []
        for k, source in enumerate(sources):
            p = Page(source)
            base = len(parent)
            parent += [x + base if x >= 0 else -1 for x in p.parent]
            name += [-1 if n == TEXT else _NAME.get(n, 0) for n in p.name]
            text += p.text
            linked += p.linked
            page += [k] * len(p.parent)
            for i, a in enumerate(p.attrs):
                if a:
                    f = attr_features(a, seen)
                    rows += [base + i] * len(f)
                    cols += f
                    if "data-content" in a and (m := _MARK.search(a)):
                        marks.append((base + i, int(m[1])))
        self.text, self.page = text, np.array(page, np.int64)
        self.parent, self.name = np.array(parent, np.int64), np.array(name, np.int64)
        n = len(parent)
        self.depth = np.zeros(n, np.int64)
        for i, p in enumerate(parent):      # parents stand before their children
            if p >= 0:
                self.depth[i] = self.depth[p] + 1
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(self.depth.max() + 2 if n else 1))
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        self.is_text = self.name < 0
        worded = np.zeros(n, bool)
        worded[rows] = True
        self.edge = self.name + 1 + N_NAMES * worded        # 0 for text
        self.marks = marks
        self._features(np.array(linked, float), rows, cols)

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sums over each node's subtree."""
        out = values.copy()
        for level in self.levels[:0:-1]:
            np.add.at(out, self.parent[level], out[level])
        return out

    def _features(self, linked, rows, cols):
        leaf = np.flatnonzero(self.is_text)
        texts = [self.text[i] for i in leaf]
        chars, words = np.zeros(len(self.text)), np.zeros(len(self.text))
        chars[leaf] = [len(t) for t in texts]
        words[leaf] = [t.count(" ") + 1 for t in texts]
        commas = np.array([t.count(",") for t in texts], np.int64)
        ends = np.array([t[-1] in ".!?…\"'”»:" for t in texts], np.int64)
        sign = np.array(["©" in t for t in texts], np.int64)
        f = [(leaf, np.full(len(leaf), _AT["text"])), (leaf, _AT["in"] + np.maximum(self.name[self.parent[leaf]], 0)),
             (leaf, _AT["words"] + np.searchsorted(SIZES, words[leaf], "right")),
             (leaf, _AT["links"] + np.searchsorted(SHARES, linked[leaf] / np.maximum(chars[leaf], 1), "right")),
             (leaf, _AT["ends"] + ends), (leaf, _AT["commas"] + np.minimum(commas, 2)), (leaf, _AT["sign"] + sign)]
        el = np.flatnonzero(~self.is_text)
        below, below_linked, below_words = self.up(chars), self.up(linked), self.up(words)
        whole = np.zeros(len(self.text))
        for level in self.levels:
            whole[level] = np.where(self.parent[level] < 0, below[level], whole[self.parent[level]])
        f += [(el, _AT["element"] + self.name[el]), (el, _AT["below"] + np.searchsorted(SIZES, below_words[el], "right")),
              (el, _AT["below links"] + np.searchsorted(SHARES, below_linked[el] / np.maximum(below[el], 1), "right")),
              (el, _AT["part"] + np.searchsorted(PARTS, below[el] / np.maximum(whole[el], 1), "right"))]
        self.rows = np.concatenate([np.array(rows, np.int64), *[a for a, _ in f]])
        self.cols = np.concatenate([np.array(cols, np.int64), *[b for _, b in f]])
        self.chars = chars

    def labels(self) -> np.ndarray:
        """Text takes the nearest mark above; an element is content if most of its text is."""
        y = np.full(len(self.text), -1.0)
        for i, m in self.marks:
            y[i] = m
        for level in self.levels:
            unset = level[y[level] < 0]
            above = self.parent[unset]
            y[unset] = np.where(above >= 0, y[above], 0)
        content = self.up(np.where(self.is_text, self.chars * y, 0))
        total = self.up(np.where(self.is_text, self.chars, 0))
        return np.where(self.is_text, y, (content * 2 > total) * 1.0).astype(np.int64)


def _logsum(x):
    return np.logaddexp(x[..., 0], x[..., 1])


def messages(forest: Forest, unary: np.ndarray, edges: np.ndarray, pairs: bool = False):
    """Sum-product on all trees: P(content) per node and, if asked, the joint
    marginals (parent label, child label) per edge, in the child's place.

    ``unary`` is the score of label 1 against 0; ``edges[kind, parent, child]``
    are the pair scores.
    """
    n = len(unary)
    inside = np.zeros((n, 2))
    inside[:, 1] = unary
    to_parent = np.zeros((n, 2))
    for level in forest.levels[:0:-1]:
        to_parent[level] = _logsum(edges[forest.edge[level]] + inside[level][:, None, :])
        np.add.at(inside, forest.parent[level], to_parent[level])
    outside = np.zeros((n, 2))
    joint = np.zeros((n, 2, 2)) if pairs else None
    for level in forest.levels[1:]:
        p = forest.parent[level]
        rest = inside[p] + outside[p] - to_parent[level]
        both = rest[:, :, None] + edges[forest.edge[level]]
        down = _logsum(both.transpose(0, 2, 1))
        outside[level] = down - down.max(axis=1, keepdims=True)
        if pairs:
            j = both + inside[level][:, None, :]
            j = np.exp(j - j.max(axis=(1, 2), keepdims=True))
            joint[level] = j / j.sum(axis=(1, 2), keepdims=True)
    belief = inside + outside
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint


def likelihood(forest: Forest, y: np.ndarray, w: np.ndarray, edges: np.ndarray):
    """Log-likelihood of the labels and its gradients."""
    unary = np.bincount(forest.rows, w[forest.cols], minlength=len(y))
    p, joint = messages(forest, unary, edges, pairs=True)
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros_like(edges)
    np.add.at(seen, (forest.edge[child], y[forest.parent[child]], y[child]), 1)
    expected = np.zeros_like(edges)
    np.add.at(expected, forest.edge[child], joint[child])
    grad_w = np.bincount(forest.cols, (y - p)[forest.rows], minlength=len(w))
    score = (unary * y).sum() + (edges * seen).sum() - _partition(forest, unary, edges)
    return score, grad_w, seen - expected


def _partition(forest: Forest, unary: np.ndarray, edges: np.ndarray) -> float:
    inside = np.zeros((len(unary), 2))
    inside[:, 1] = unary
    for level in forest.levels[:0:-1]:
        np.add.at(inside, forest.parent[level], _logsum(edges[forest.edge[level]] + inside[level][:, None, :]))
    return float(_logsum(inside[forest.parent < 0]).sum())


def fit(pages: list[str], steps: int = 100, rate: float = 0.2, penalty: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """Potentials from labelled pages (``data-content`` marks), by Adam with an L2 penalty."""
    forest = Forest(pages)
    y = forest.labels()
    w = np.zeros(N_FEATURES + N_EDGES * 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        _, gw, ge = likelihood(forest, y, w[:N_FEATURES], w[N_FEATURES:].reshape(N_EDGES, 2, 2))
        g = np.concatenate((gw, ge.ravel())) - penalty * w
        m, v = .9 * m + .1 * g, .999 * v + .001 * g * g
        w = w + rate * min(1.0, 2 * (1 - t / steps)) * (m / (1 - .9 ** t)) / (np.sqrt(v / (1 - .999 ** t)) + 1e-8)
    return w[:N_FEATURES], w[N_FEATURES:].reshape(N_EDGES, 2, 2)


def extract(sources: list[str], model, seen: dict | None = None) -> list[str]:
    """Main text per page: its content blocks in page order, joined by line ends."""
    forest = Forest(sources, seen)
    w, edges = model
    p, _ = messages(forest, np.bincount(forest.rows, w[forest.cols], minlength=len(forest.text)), edges)
    out: list[list[str]] = [[] for _ in sources]
    for i in np.flatnonzero(forest.is_text & (p >= .5)).tolist():
        out[forest.page[i]].append(forest.text[i])
    return ["\n".join(x) for x in out]


def main_text(pages: DataFrame, train_pages: int = 600, labelled: list[str] | None = None) -> DataFrame:
    """page_id, url, text (main text) and n_chars of every row of ``pages``.

    The model is fitted on ``train_pages`` invented layouts (page_layouts) and
    on ``labelled``, html texts marked with ``data-content``, if given.
    Defined cases: null or empty html has the empty text; pages without any
    content too; broken markup is read as far as it goes; pages of any length
    are read whole; null ids and repeated rows keep their row; an empty table
    gives an empty result; other columns are ignored.
    """
    model = fit(labelled_pages(train_pages) + list(labelled or []))

    def read(frames):
        seen: dict = {}
        for pdf in frames:
            sources = pdf["html"].tolist()
            texts = []
            for s in in_blocks(sources, 1_000_000):
                texts += extract(sources[s], model, seen)
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": pd.Series(texts, dtype=object)})

    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return (rows.mapInPandas(read, "page_id string, url string, text string")
            .select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")))
