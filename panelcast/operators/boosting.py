"""Gradient-boosted trees from histograms, several fits at once.

Rows are binned once and packed into blocks of bytes. A boosting round grows
one tree per fit, level by level. For each level every block adds up the
gradients of its rows by (fit, node, feature, bin); one keyed reduce sums them
over the blocks, and the same tasks find each node's best split over their
features. Only the candidates (one per fit, node and feature group) reach the
driver. Of two siblings only the smaller is summed: the other is its parent
minus it, from the level before, which lies in the same partitions.

The tree of a round is grown to the depth limit and then cut best-first to the
leaf limit, which gives the leaf-wise tree. A fit stops when the asymmetric
error of its validation rows has not improved for ``patience`` rounds, and
keeps its best round.

Recovery: blocks are checkpointed; scores are the checkpointed scores plus the
trees since then, so a lost executor repeats a few trees at most.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import cut_lineage, ensure_checkpoint_dir

GROUP = 16          # features whose histograms are reduced together


@dataclass(frozen=True)
class BoostParams:
    """Defaults are the reference's settings."""
    rounds: int = 100_000
    rate: float = 0.01
    patience: int = 50
    depth: int = 5
    leaves: int = 50
    bins: int = 128         # the last one holds missing values
    min_rows: int = 50
    min_weight: float = 1e-3
    l1: float = 0.5
    l2: float = 0.5
    block_rows: int = 8192
    sample_rows: int = 200_000
    task_rows: int = 12_000
    refresh: int = 16       # rounds between two writes of the scores


@dataclass
class Tree:
    """Node arrays; ``feature`` is -1 in leaves. ``value`` includes the learning rate."""
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    missing_left: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    cover: list = field(default_factory=list)
    gain: list = field(default_factory=list)

    def add(self, value, cover):
        for name, x in (("feature", -1), ("cut", -1), ("missing_left", False), ("left", -1), ("right", -1),
                        ("value", value), ("cover", cover), ("gain", 0.0)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def leaf_of(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """Leaf number of each row of binned features."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right, missing_left = np.array(self.left), np.array(self.right), np.array(self.missing_left)
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                return at
            b = bins[rows, np.maximum(feature[at], 0)]
            go_left = np.where(b == missing, missing_left[at], b <= cut[at])
            at = np.where(inner, np.where(go_left, left[at], right[at]), at)


@dataclass
class BoostedTrees:
    """The kept trees of each fit, with the cuts in feature values.

    ``edges[fit][feature]`` are the upper ends of the bins, ``base[fit]`` the
    score before the first tree, ``history`` one row per fit and round.
    """
    feature_cols: list
    params: BoostParams
    edges: dict
    base: dict
    trees: dict
    history: list

    def threshold(self, fit, feature: int, cut: int) -> float:
        """Values up to this one go left (infinity: all but the missing ones)."""
        ends = self.edges[fit][feature]
        return float(ends[cut]) if cut < len(ends) else float("inf")

    def bins_of(self, fit, X: np.ndarray) -> np.ndarray:
        return bin_rows(X, self.edges[fit], self.params.bins)

    def predict(self, fit, X: np.ndarray) -> np.ndarray:
        """Scores (log scale) of raw feature rows; NaN is missing."""
        bins = self.bins_of(fit, np.asarray(X, float))
        out = np.full(len(bins), self.base[fit])
        for t in self.trees[fit]:
            out += np.array(t.value)[t.leaf_of(bins, self.params.bins - 1)]
        return out

    def node_table(self, spark) -> DataFrame:
        """One row per node: fit, tree, node, parent, feature, threshold, missing_left, value, cover, gain."""
        rows = []
        for fit, trees in self.trees.items():
            for k, t in enumerate(trees):
                parent = {c: i for i, pair in enumerate(zip(t.left, t.right)) for c in pair if c >= 0}
                for i, f in enumerate(t.feature):
                    rows.append((str(fit), k, i, parent.get(i), self.feature_cols[f] if f >= 0 else None,
                                 self.threshold(fit, f, t.cut[i]) if f >= 0 else None, bool(t.missing_left[i]) if f >= 0 else None,
                                 float(t.value[i]), float(t.cover[i]), float(t.gain[i])))
        return spark.createDataFrame(rows, "fit string, tree int, node int, parent int, feature string, threshold double, "
                                           "missing_left boolean, value double, cover double, gain double")

    def history_table(self, spark) -> DataFrame:
        """The metric curve: fit, round, train_error, valid_error, kept (up to the best round)."""
        return spark.createDataFrame([(str(f), r, a, b, r <= len(self.trees[f])) for f, r, a, b in self.history],
                                     "fit string, round int, train_error double, valid_error double, kept boolean")


def name_of(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def value_edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Upper bin ends: between neighbouring values if they are few, else quantiles."""
    x = x[~np.isnan(x)]
    u = np.unique(x)
    if len(u) <= bins:
        return (u[:-1] + u[1:]) / 2
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def bin_edges(train: DataFrame, feature_cols, params: BoostParams, fit_col: str) -> dict:
    """Bin ends of every feature and fit, from about ``sample_rows`` training
    rows a fit (by hash; the sample shapes the bins only). A task sees one
    feature's values of one fit; the ends (at most ``bins`` numbers) are collected."""
    cols = list(feature_cols)
    values = [F.expr(f"cast({name_of(c)} as double)").alias(f"f{i}") for i, c in enumerate(cols)]
    rows = train.select(F.col(fit_col).alias("fit"), *values)
    most = rows.groupBy("fit").count().agg(F.max("count")).first()[0] or 0
    share = -(-most // params.sample_rows)
    if share > 1:
        rows = rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(share)) == 0)
    kind = train.schema[fit_col].dataType

    def columns(frames):
        for pdf in frames:
            for fit, part in pdf.groupby("fit", sort=False):
                yield pd.DataFrame({"fit": [fit] * len(cols), "feature": range(len(cols)),
                                    "x": [part[f"f{i}"].to_numpy(float).tobytes() for i in range(len(cols))]})

    def ends(key, pdf):
        x = np.concatenate([np.frombuffer(v) for v in pdf["x"]])
        return pd.DataFrame({"fit": [key[0]], "feature": [key[1]], "ends": [value_edges(x, params.bins - 1)]})

    fit_field = T.StructField("fit", kind)
    packed = rows.mapInPandas(columns, T.StructType([fit_field, T.StructField("feature", T.IntegerType()),
                                                     T.StructField("x", T.BinaryType())]))
    out: dict = {}
    for r in packed.groupBy("fit", "feature").applyInPandas(ends, T.StructType([
            fit_field, T.StructField("feature", T.IntegerType()), T.StructField("ends", T.ArrayType(T.DoubleType()))])).collect():
        out.setdefault(r["fit"], [np.zeros(0)] * len(cols))[r["feature"]] = np.array(r["ends"], float)
    return out


def bin_rows(X: np.ndarray, edges, bins: int) -> np.ndarray:
    out = np.empty(X.shape, np.uint8 if bins <= 256 else np.uint16)
    for f, e in enumerate(edges):
        x = X[:, f]
        out[:, f] = np.where(np.isnan(x), bins - 1, np.searchsorted(e, x, "left"))
    return out


def _soft(g, l1):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def asymmetric_errors(score, y):
    """Squared errors, under-predictions weighted 1.1, others 0.9 (before squaring)."""
    return (np.where(score < y, 1.1, 0.9) * (score - y)) ** 2


def node_splits(hist: np.ndarray, first_feature: int, p: BoostParams) -> list[tuple]:
    """Best split of each node over one feature group.

    ``hist`` is (nodes, features, bins, 3): gradient, weight and row sums. Per node:
    (gain, feature, cut, missing_left, left G, H, N, node G, H, N); gain is -1 where
    no split leaves ``min_rows`` on both sides.
    """
    total = hist[:, :1].sum(axis=2)                               # the node's sums, from any feature
    run = hist[:, :, :-1].cumsum(axis=2)
    sides = np.stack((run, run + hist[:, :, -1:]), axis=3)        # missing right, missing left
    G, H, N = (sides[..., k] for k in range(3))
    g, h, n = (total[:, :, None, None, k][:, :, 0] for k in range(3))
    g, h, n = (x[:, :, None, :] for x in (g, h, n))
    gain = (_soft(G, p.l1) ** 2 / (H + p.l2) + _soft(g - G, p.l1) ** 2 / (h - H + p.l2) - _soft(g, p.l1) ** 2 / (h + p.l2))
    bad = (N < p.min_rows) | (n - N < p.min_rows) | (H < p.min_weight) | (h - H < p.min_weight)
    gain = np.where(bad, -1.0, gain)
    out = []
    for k in range(len(hist)):
        f, c, m = np.unravel_index(int(gain[k].argmax()), gain[k].shape)
        out.append((float(gain[k, f, c, m]), first_feature + int(f), int(c), bool(m), *(float(x) for x in sides[k, f, c, m]),
                    *(float(x) for x in total[k, 0])))
    return out


def leafwise(splits: dict, p: BoostParams) -> Tree:
    """The best-first tree of at most ``leaves`` leaves out of all splits to the
    depth limit. ``splits[node]`` as in ``node_splits``; children of node k are
    2k + 1 and 2k + 2."""
    t = Tree()

    def value(g, h):
        return -float(_soft(g, p.l1)) / (h + p.l2) * p.rate

    g, h = splits[0][7], splits[0][8]
    open_ = {0: t.add(value(g, h), h)}
    leaves = 1
    while leaves < p.leaves:
        ready = [(-splits[k][0], k) for k in open_ if k in splits and splits[k][0] > 1e-12]
        if not ready:
            break
        k = min(ready)[1]
        gain, f, cut, missing_left, gl, hl, _, g, h, _ = splits[k]
        i = open_.pop(k)
        a, b = t.add(value(gl, hl), hl), t.add(value(g - gl, h - hl), h - hl)
        t.feature[i], t.cut[i], t.missing_left[i], t.left[i], t.right[i], t.gain[i] = f, cut, missing_left, a, b, gain
        open_[2 * k + 1], open_[2 * k + 2] = a, b
        leaves += 1
    return t


def _place(bins: np.ndarray, splits: dict, depth: int, missing: int) -> np.ndarray:
    """Heap number of the node of each row after ``depth`` levels of ``splits``
    (-1: the row's node is not split any further)."""
    at = np.zeros(len(bins), np.int64)
    for level in range(depth):
        new = np.full(len(bins), -1, np.int64)
        for k in range(2 ** level - 1, 2 ** (level + 1) - 1):
            if k in splits and splits[k][0] > 1e-12:
                rows = np.flatnonzero(at == k)
                b = bins[rows, splits[k][1]]
                go_left = np.where(b == missing, splits[k][3], b <= splits[k][2])
                new[rows] = np.where(go_left, 2 * k + 1, 2 * k + 2)
        at = new
    return at


def pack(df: DataFrame, feature_cols, edges: dict, params: BoostParams, fit_col: str, target: str, weight: str,
         valid: str) -> DataFrame:
    """Binned rows in blocks: fit, bins, y, w, valid as bytes. Missing labels are left out."""
    schema = df.schema[fit_col].dataType
    cols = list(feature_cols)
    rows = df.where(F.col(target).isNotNull()).select(
        F.col(fit_col).alias("__fit"), F.log1p(target).alias("__y"), F.col(weight).cast("double").alias("__w"),
        F.col(valid).alias("__v"), *[F.expr(f"cast({name_of(c)} as double)").alias(f"f{i}") for i, c in enumerate(cols)])

    def run(frames):
        for pdf in frames:
            for fit, part in pdf.groupby("__fit", sort=False):
                X = part[[f"f{i}" for i in range(len(cols))]].to_numpy(float)
                for a in range(0, len(part), params.block_rows):
                    s = slice(a, a + params.block_rows)
                    yield pd.DataFrame([{
                        "fit": fit, "bins": bin_rows(X[s], edges[fit], params.bins).tobytes(),
                        "y": part["__y"].to_numpy(float)[s].tobytes(), "w": part["__w"].to_numpy(float)[s].tobytes(),
                        "valid": part["__v"].to_numpy(bool)[s].tobytes()}])

    return rows.mapInPandas(run, T.StructType([T.StructField("fit", schema), *[
        T.StructField(c, T.BinaryType()) for c in ("bins", "y", "w", "valid")]]))


def unpacked(row, n_features, bins):
    """One packed block as (fit, bins, y, w, valid, score), the form tasks keep between jobs."""
    kind = np.uint8 if bins <= 256 else np.uint16
    y = np.frombuffer(row["y"])
    return (row["fit"], np.frombuffer(row["bins"], kind).reshape(-1, n_features), y, np.frombuffer(row["w"]),
            np.frombuffer(row["valid"], bool), np.zeros(len(y)))


def scored(block, trees, missing):
    out = block[5].copy()
    for t in trees:
        out += np.array(t.value)[t.leaf_of(block[1], missing)]
    return out


def fit_boosted(df: DataFrame, feature_cols, target: str, weight: str, valid: str, params: BoostParams = BoostParams(),
                fit_col: str | None = None) -> BoostedTrees:
    """Boosted trees on log1p(target), one fit per value of ``fit_col`` (all in the same jobs).

    ``valid`` marks the rows that only decide when to stop. Missing feature
    values go to the side that gains more.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    ensure_checkpoint_dir(spark)
    if fit_col is None:
        fit_col, df = "__fit", df.withColumn("__fit", F.lit("all"))
    p, cols, missing = params, list(feature_cols), params.bins - 1
    n_features = len(cols)
    edges = bin_edges(df.where(~F.col(valid) & F.col(target).isNotNull()), cols, p, fit_col)
    packed = cut_lineage(pack(df, cols, edges, p, fit_col, target, weight, valid))
    n_features_, bins_ = n_features, p.bins
    state = packed.rdd.map(lambda r: unpacked(r, n_features_, bins_))
    blocks = state.map(lambda b: len(b[2]))
    tasks = max(1, min(state.getNumPartitions(), -(-blocks.sum() // p.task_rows)))     # small tables in few tasks
    parts = min(sc.defaultParallelism, tasks)
    state = state.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)

    def sums(b):
        fit, _, y, w, valid, _ = b
        return fit, np.array([(w * y)[~valid].sum(), w[~valid].sum()])

    start = state.map(sums).reduceByKey(lambda a, b: a + b, parts).collectAsMap()
    base = {f: float(v[0] / v[1]) for f, v in start.items() if v[1] > 0}
    starts = dict(base)
    state0 = state

    def set_base(b):
        return (*b[:5], np.full(len(b[2]), starts.get(b[0], 0.0)))

    state = state.map(set_base).persist(StorageLevel.MEMORY_AND_DISK)
    trees = {f: [] for f in base}
    best = {f: (np.inf, 0) for f in base}
    history, active, written = [], set(base), 0
    round_ = 0
    while active:
        pending = {f: trees[f][written:] for f in active}
        splits = {f: {} for f in active}
        nodes = {f: [0] for f in active}            # nodes of this level whose histograms are wanted
        ask, errors, older = dict(nodes), {}, None
        for level in range(p.depth):
            hist = _level(state, pending, splits, ask, level, p, n_features, parts, errors=level == 0)
            if older is not None:
                hist = _with_siblings(hist, older, ask, splits, nodes, level, parts)
            hist = hist.persist(StorageLevel.MEMORY_AND_DISK)
            found = hist.flatMap(_candidates(nodes, p, missing)).collect()
            if older is not None:
                older.unpersist()
            older = hist
            for kind, fit, k, s in found:
                if kind == "error":
                    errors[fit] = s
                elif k not in splits[fit] or (-s[0], s[1], s[2]) < (-splits[fit][k][0], splits[fit][k][1], splits[fit][k][2]):
                    splits[fit][k] = s
            if level == 0:
                for f in sorted(errors, key=str):
                    e = errors[f]
                    shown = (e[0] / e[1] if e[1] else None, e[2] / e[3] if e[3] else None)
                    history.append((f, round_, shown[0], shown[1]))
                    error = shown[1] if shown[1] is not None else shown[0]
                    if round_ == 0 or error < best[f][0]:
                        best[f] = (error, round_)
                    elif round_ - best[f][1] >= p.patience:
                        active.discard(f)
                if round_ >= p.rounds:
                    active.clear()
                nodes = {f: nodes[f] for f in active}
                if not active:
                    break
            ask, following = {}, {}
            for f in nodes:
                small, all_ = [], []
                for k in nodes[f]:
                    if k in splits[f] and splits[f][k][0] > 1e-12:
                        s = splits[f][k]
                        small.append(2 * k + 1 if 2 * s[6] <= s[9] else 2 * k + 2)
                        all_ += [2 * k + 1, 2 * k + 2]
                if small:
                    ask[f], following[f] = small, all_
            nodes = following
            if not nodes:
                break
        older.unpersist()
        grown = 0
        for f in active:
            t = leafwise(splits[f], p)
            trees[f].append(t)
            grown += len(t.feature) > 1
        round_ += 1
        if active and not grown:                    # no split left anywhere: further rounds would repeat this one
            for f in active:
                history.append((f, round_, *history[-1][2:]))
            active.clear()
        if active and round_ - written >= p.refresh:
            more, done = {f: trees[f][written:] for f in active}, state

            def advance(b, more=more):
                return (*b[:5], scored(b, more.get(b[0], []), missing))

            state = done.map(advance).persist(StorageLevel.MEMORY_AND_DISK)
            state.checkpoint()
            state.count()
            done.unpersist()
            written = round_
    state.unpersist()
    state0.unpersist()
    kept = {f: trees[f][:best[f][1]] for f in trees}
    return BoostedTrees(cols, p, edges, base, kept, history)


def _level(state, pending, splits, ask, level, p, n_features, parts, errors):
    """Histograms of the asked nodes: ((fit, first feature), array), summed over all blocks."""
    missing = p.bins - 1

    def block(b):
        fit, bins, y, w, valid, _ = b
        if fit not in ask and not (errors and fit in pending):
            return
        score = scored(b, pending.get(fit, []), missing)
        if errors:
            e = asymmetric_errors(score, y)
            yield (fit, -1), np.array([e[~valid].sum(), (~valid).sum(), e[valid].sum(), valid.sum()], float)
        if fit not in ask:
            return
        slot = np.full(2 ** (level + 1), -1, np.int64)
        slot[ask[fit]] = np.arange(len(ask[fit]))
        at = _place(bins, splits[fit], level, missing)
        rows = np.flatnonzero((at >= 0) & ~valid)
        where = slot[at[rows]]
        rows, where = rows[where >= 0], where[where >= 0]
        g, h = (w * (score - y))[rows], w[rows]
        n = len(ask[fit])
        for first in range(0, n_features, GROUP):
            x = bins[rows, first:first + GROUP]
            k = x.shape[1]
            at_ = ((where[:, None] * k + np.arange(k)) * p.bins + x).ravel()
            size = n * k * p.bins
            out = np.stack([np.bincount(at_, np.repeat(v, k), size) for v in (g, h)] +
                           [np.bincount(at_, minlength=size).astype(float)], axis=-1)
            yield (fit, first), out.reshape(n, k, p.bins, 3)

    return state.flatMap(block).reduceByKey(lambda a, b: a + b, parts)


def _with_siblings(small, older, ask, splits, nodes, level, parts):
    """Histograms of all nodes of a level from those of the smaller children and of their parents."""
    parents = {f: sorted({(k - 1) // 2 for k in nodes[f]}) for f in nodes}
    above = {f: sorted(k for k in splits[f] if 2 ** (level - 1) - 1 <= k < 2 ** level - 1) for f in nodes}

    def fill(kv):
        (fit, first), (mine, theirs) = kv
        if mine is None or theirs is None or fit not in nodes:
            return (fit, first), None
        out = np.empty((len(nodes[fit]), *mine.shape[1:]))
        for i, parent in enumerate(parents[fit]):
            child = ask[fit][i]
            j = child - (2 * parent + 1)
            out[2 * i + j] = mine[i]
            out[2 * i + 1 - j] = theirs[above[fit].index(parent)] - mine[i]
        return (fit, first), out

    both = small.join(older.filter(lambda kv: kv[0][1] >= 0 and kv[1] is not None), parts)
    return both.map(fill, preservesPartitioning=True)


def _candidates(nodes, p, missing):
    def best(kv):
        (fit, first), hist = kv
        if first < 0:
            yield "error", fit, -1, tuple(float(x) for x in hist)
        elif hist is not None and fit in nodes:
            for k, s in zip(nodes[fit], node_splits(hist, first, p)):
                yield "split", fit, k, s
    return best


# ---------------------------------------------------------------- O43
def tree_contributions(tree: Tree, bins: np.ndarray, missing: int, n_features: int) -> tuple[np.ndarray, float]:
    """Path-dependent Shapley values of one tree for each row, and its mean score.

    A leaf pays its value if the row meets the conditions of the known features
    on its path, times the share of training weight that takes the same way for
    each unknown one. The Shapley value of such a product is a sum over the
    number of known features, from the coefficients of prod(share + met * t).
    """
    out, mean = np.zeros((len(bins), n_features)), 0.0
    todo = [(0, {})]
    while todo:
        node, path = todo.pop()
        f = tree.feature[node]
        if f >= 0:
            b = bins[:, f]
            go_left = np.where(b == missing, tree.missing_left[node], b <= tree.cut[node])
            for child, met in ((tree.left[node], go_left), (tree.right[node], ~go_left)):
                share = tree.cover[child] / tree.cover[node]
                old_met, old_share = path.get(f, (True, 1.0))
                todo.append((child, path | {f: (old_met & met, old_share * share)}))
            continue
        value, m = tree.value[node], len(path)
        mean += value * float(np.prod([s for _, s in path.values()]))
        weight = [1.0 / m] if m else []         # k! (m - k - 1)! / m!
        for k in range(1, m):
            weight.append(weight[-1] * k / (m - k))
        for f, (met, share) in path.items():
            known = np.zeros((m, len(bins)))
            known[0] = 1.0
            for g, (met2, share2) in path.items():
                if g != f:
                    known[1:] = known[1:] * share2 + known[:-1] * met2
                    known[0] *= share2
            out[:, f] += value * (met - share) * (np.array(weight) @ known)
    return out, mean


def contributions(model: BoostedTrees, df: DataFrame, keep, fit_col: str | None = None) -> DataFrame:
    """O43 per row: ``keep`` columns, prediction, base and contributions (one per
    feature column; base plus their sum is the prediction, on the log scale)."""
    cols, keep = model.feature_cols, list(keep)
    rows = df.select(*keep, (F.col(fit_col) if fit_col else F.lit("all")).alias("__fit"),
                     *[F.expr(f"cast({name_of(c)} as double)").alias(f"__f{i}") for i, c in enumerate(cols)])
    fields = [f for f in rows.schema.fields if f.name in keep]

    def run(frames):
        for pdf in frames:
            for fit, part in pdf.groupby("__fit", sort=False):
                bins = model.bins_of(fit, part[[f"__f{i}" for i in range(len(cols))]].to_numpy(float))
                phi, mean = np.zeros(bins.shape), model.base[fit]
                for t in model.trees[fit]:
                    x, m = tree_contributions(t, bins, model.params.bins - 1, len(cols))
                    phi, mean = phi + x, mean + m
                yield part[keep].assign(prediction=phi.sum(axis=1) + mean, base=mean, contributions=list(phi))

    return rows.mapInPandas(run, T.StructType([*fields, T.StructField("prediction", T.DoubleType()),
                                               T.StructField("base", T.DoubleType()),
                                               T.StructField("contributions", T.ArrayType(T.DoubleType()))]))


def mean_contributions(per_row: DataFrame, feature_cols, top: int = 25) -> DataFrame:
    """The features of largest mean absolute contribution: rank, feature, importance."""
    spark = per_row.sparkSession
    names = spark.createDataFrame(list(enumerate(feature_cols)), "pos int, feature string")
    mean = (per_row.select(F.posexplode("contributions").alias("pos", "x")).groupBy("pos")
            .agg(F.avg(F.abs("x")).alias("importance")))
    # one row per feature column, so the ranking is bounded by the schema
    ranked = mean.join(names, "pos").orderBy(F.desc("importance"), "feature").limit(top).collect()
    return spark.createDataFrame([(i + 1, r["feature"], r["importance"]) for i, r in enumerate(ranked)],
                                 "rank int, feature string, importance double")


def score_frame(model: BoostedTrees, df: DataFrame, keep, out: str = "prediction", fit_col: str | None = None) -> DataFrame:
    """``keep`` columns and the model's score (log scale) of every row."""
    cols, keep = model.feature_cols, list(keep)
    rows = df.select(*keep, (F.col(fit_col) if fit_col else F.lit("all")).alias("__fit"),
                     *[F.expr(f"cast({name_of(c)} as double)").alias(f"__f{i}") for i, c in enumerate(cols)])

    def run(frames):
        for pdf in frames:
            for fit, part in pdf.groupby("__fit", sort=False):
                X = part[[f"__f{i}" for i in range(len(cols))]].to_numpy(float)
                yield part[keep].assign(**{out: model.predict(fit, X)})

    return rows.mapInPandas(run, T.StructType([*[f for f in rows.schema.fields if f.name in keep],
                                               T.StructField(out, T.DoubleType())]))
