"""Histogram boosting against a plain numpy version, its contributions against
Shapley values by enumeration, and its edge cases."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import boosting as B

PARAMS = B.BoostParams(rounds=12, rate=0.3, patience=3, depth=3, leaves=6, min_rows=5, bins=16, refresh=2, block_rows=64)


def data(seed, n=400, features=5):
    r = np.random.default_rng(seed)
    X = r.normal(size=(n, features))
    X[:, 1] = r.integers(0, 4, n)
    X[r.random((n, features)) < .05] = np.nan
    y = np.maximum(0, 3 + 2 * (np.nan_to_num(X[:, 0]) > .3) + np.nan_to_num(X[:, 1]) * (np.isnan(X[:, 2]) + .5) + r.normal(size=n) * .3)
    return X, y, r.choice([.25, 1., 1.25], n), np.arange(n) % 4 == 3


def frame(spark, X, y, w, valid, fit="all"):
    rows = [(fit, *[None if np.isnan(v) else float(v) for v in x], float(t), float(u), bool(b)) for x, t, u, b in zip(X, y, w, valid)]
    names = [f"x`{i}" if i == 0 else f"x{i}" for i in range(X.shape[1])]
    schema = "fit string, " + ", ".join(f"{B.name_of(c)} double" for c in names) + ", target double, weight double, valid boolean"
    return spark.createDataFrame(rows, schema).repartition(3), names


def plain_boosting(X, y, w, valid, p, edges):
    """Leaf-wise boosting row by row sets, no histograms kept: a dictionary of row masks."""
    bins, y = B.bin_rows(X, edges, p.bins), np.log1p(y)
    t = ~valid
    score = np.full(len(y), np.average(y[t], weights=w[t]))
    errors = []
    best, kept = (np.inf, 0), None
    trees = []
    for r in range(p.rounds + 1):
        e = B.asymmetric_errors(score, y)
        errors.append((e[t].mean(), e[valid].mean()))
        if r == 0 or errors[-1][1] < best[0]:
            best = (errors[-1][1], r)
        elif r - best[1] >= p.patience:
            break
        if r == p.rounds:
            break
        g = w * (score - y)

        def soft(x):
            return math.copysign(max(abs(x) - p.l1, 0), x)

        def find(mask):
            top = (1e-12,)
            rows = mask & t
            G, H = g[rows].sum(), w[rows].sum()
            for f in range(X.shape[1]):
                for cut in range(p.bins - 1):
                    for miss in (False, True):
                        left = np.where(bins[:, f] == p.bins - 1, miss, bins[:, f] <= cut)
                        a, b = rows & left, rows & ~left
                        if a.sum() < p.min_rows or b.sum() < p.min_rows:
                            continue
                        gl, hl = g[a].sum(), w[a].sum()
                        gain = soft(gl) ** 2 / (hl + p.l2) + soft(G - gl) ** 2 / (H - hl + p.l2) - soft(G) ** 2 / (H + p.l2)
                        if gain > top[0] + 1e-9:
                            top = (gain, f, cut, miss, left)
            return top if len(top) > 1 else None

        leaves = {0: (np.ones(len(y), bool), 0)}
        splits = {0: find(leaves[0][0])}
        while len(leaves) < p.leaves:
            ready = [(-splits[k][0], k) for k in leaves if splits.get(k) and leaves[k][1] < p.depth]
            if not ready:
                break
            k = min(ready)[1]
            mask, depth = leaves.pop(k)
            left = splits[k][4]
            for c, m in ((2 * k + 1, mask & left), (2 * k + 2, mask & ~left)):
                leaves[c] = (m, depth + 1)
                splits[c] = find(m)
        trees.append(len(leaves))
        for mask, _ in leaves.values():
            score = np.where(mask, score - soft(g[mask & t].sum()) / (w[mask & t].sum() + p.l2) * p.rate, score)
    return errors, best[1], trees


@pytest.fixture(scope="module")
def fitted(spark):
    X, y, w, valid = data(1)
    df, names = frame(spark, X, y, w, valid)
    return X, y, w, valid, df, names, B.fit_boosted(df, names, "target", "weight", "valid", PARAMS)


def test_equals_plain_version(fitted):
    X, y, w, valid, _, _, m = fitted
    errors, kept, leaves = plain_boosting(X, y, w, valid, PARAMS, m.edges["all"])
    assert np.allclose([h[2:] for h in m.history], errors, rtol=1e-9)
    assert len(m.trees["all"]) == kept
    assert [sum(f < 0 for f in t.feature) for t in m.trees["all"]] == leaves[:kept]


def test_several_fits_at_once_equal_single_ones(spark, fitted):
    X, y, w, valid, df, names, one = fitted
    X2, y2, w2, valid2 = data(7, n=300)
    df2, _ = frame(spark, X2, y2, w2, valid2, "b")
    both = B.fit_boosted(df.unionByName(df2), names, "target", "weight", "valid", PARAMS, fit_col="fit")
    two = B.fit_boosted(df2, names, "target", "weight", "valid", PARAMS)
    assert np.allclose(both.predict("all", X), one.predict("all", X)) and np.allclose(both.predict("b", X2), two.predict("all", X2))
    assert {f: len(t) for f, t in both.trees.items()} == {"all": len(one.trees["all"]), "b": len(two.trees["all"])}


def test_tables_and_scoring(spark, fitted):
    X, y, w, valid, df, names, m = fitted
    curve = m.history_table(spark).orderBy("round").collect()
    assert [r["round"] for r in curve] == list(range(len(curve))) and curve[0]["kept"]
    best = min(range(len(curve)), key=lambda k: curve[k]["valid_error"])
    assert best == len(m.trees["all"]) and len(curve) - 1 - best <= PARAMS.patience
    nodes = m.node_table(spark)
    assert nodes.where("feature is null").count() == sum(f < 0 for t in m.trees["all"] for f in t.feature)
    scored = B.score_frame(m, df, ["target"]).toPandas()
    want = sorted(zip(y.tolist(), m.predict("all", X).tolist()))
    assert np.allclose(sorted(zip(scored.target, scored.prediction)), want)


def test_contributions_are_shapley_values(fitted):
    X, _, _, _, df, names, m = fitted
    rows = X[:6]
    bins = m.bins_of("all", rows)
    phi, mean = np.zeros(rows.shape), m.base["all"]
    for t in m.trees["all"]:
        a, b = B.tree_contributions(t, bins, PARAMS.bins - 1, rows.shape[1])
        phi, mean = phi + a, mean + b
    assert np.allclose(phi.sum(axis=1) + mean, m.predict("all", rows))

    def value(t, b, known, node=0):
        f = t.feature[node]
        if f < 0:
            return t.value[node]
        kids = (t.left[node], t.right[node])
        if f in known:
            return value(t, b, known, kids[0 if (t.missing_left[node] if b[f] == PARAMS.bins - 1 else b[f] <= t.cut[node]) else 1])
        return sum(t.cover[k] / t.cover[node] * value(t, b, known, k) for k in kids)

    n = rows.shape[1]
    for i, b in enumerate(bins):
        for f in range(n):
            others = [g for g in range(n) if g != f]
            want = sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n)
                       * sum(value(t, b, {*s, f}) - value(t, b, set(s)) for t in m.trees["all"])
                       for k in range(n) for s in itertools.combinations(others, k))
            assert abs(want - phi[i, f]) < 1e-9


def test_contributions_in_spark(spark, fitted):
    X, y, _, _, df, names, m = fitted
    per_row = B.contributions(m, df, ["target"])
    bad = per_row.where(F.abs(F.aggregate("contributions", F.col("base"), lambda a, x: a + x) - F.col("prediction")) > 1e-9)
    assert bad.count() == 0 and per_row.count() == len(X)
    top = B.mean_contributions(per_row, names, top=3).collect()
    assert [r["rank"] for r in top] == [1, 2, 3] and top[0]["importance"] >= top[1]["importance"] >= top[2]["importance"] > 0
    mean = np.abs(np.array(per_row.toPandas().contributions.tolist())).mean(axis=0)
    assert top[0]["feature"] == names[int(mean.argmax())]


def test_nothing_to_split_and_no_validation_rows(spark):
    X, y, w, valid = data(3, n=30)
    df, names = frame(spark, X * 0, y, w, valid)
    m = B.fit_boosted(df, names, "target", "weight", "valid", PARAMS)
    t = ~valid
    assert np.allclose(m.predict("all", X[:3] * 0), np.average(np.log1p(y[t]), weights=w[t]), atol=1e-9)
    df, names = frame(spark, *data(4)[:3], np.zeros(400, bool))
    m = B.fit_boosted(df, names, "target", "weight", "valid", PARAMS)
    assert len(m.trees["all"]) == PARAMS.rounds and m.history[-1][3] is None
