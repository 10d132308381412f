"""The additive trend model against a solver that sees the raw rows."""

import datetime as dt

import numpy as np

from panelcast.operators import additive as A

START = dt.date(2019, 1, 1)
SCHEMA = "hierarchy1_id string, storetype_id string, date date, sales double"


def series():
    r = np.random.default_rng(4)
    n = 260
    t = np.arange(n)
    bend = 20 + .05 * t + .4 * np.maximum(t - 120, 0) + 3 * (t % 7 == 5) + r.normal(size=n)
    flat = np.full(n, 7.0)
    return {"bend": [(int(i), float(bend[i])) for i in t if i % 11 != 3], "flat": list(zip(t.tolist(), flat.tolist())),
            "short": [(0, 4.0), (1, 5.0)], "zero": [(i, 0.0) for i in range(30)], "nan": [(i, float("nan")) for i in range(9)]}


def raw_fit(rows, days):
    """Proximal gradient on the full design matrix, noise updated in the same turns."""
    day = np.array([d for d, _ in rows], float)
    y = np.array([v for _, v in rows])
    scale = np.abs(y).max() or 1.0
    y, span = y / scale, max(day[-1] - day[0], 1.0)
    early = int(np.floor(len(day) * A.HISTORY_SHARE))
    m = max(min(A.CHANGEPOINTS, early - 1), 0)
    at = [int(np.rint(j * (early - 1) / m)) for j in range(1, m + 1)]
    c = ((day - day[0]) / span)[at]

    def design(d):
        t = (d - day[0]) / span
        week = [A.season_row((START + dt.timedelta(days=int(x))).weekday()) for x in d]
        return np.column_stack((np.ones(len(d)), t, *[np.maximum(t - x, 0) for x in c], np.array(week)))

    X = design(day)
    ridge, lasso = A.priors(m, A.CHANGE_SCALE)
    b, s2 = np.zeros(X.shape[1]), max((y * y).mean(), 1e-12)
    for _ in range(6):
        L = np.linalg.eigvalsh(X.T @ X / s2 + np.diag(ridge)).max()
        z, k, old = b.copy(), 1.0, b
        for _ in range(60_000):
            g = X.T @ (X @ z - y) / s2 + ridge * z
            b = z - g / L
            b = np.sign(b) * np.maximum(np.abs(b) - lasso / L, 0)
            if (z - b) @ (b - old) > 0:       # restart the momentum
                k = 1.0
            k2 = (1 + np.sqrt(1 + 4 * k * k)) / 2
            z, k = b + (k - 1) / k2 * (b - old), k2
            if np.abs(b - old).max() < 1e-12:
                break
            old = b
        s2 = max(((y - X @ b) ** 2).mean(), 1e-12)
    return np.maximum(design(days) @ b * scale, 0), b[2:2 + m]


def test_laplace_trend_against_raw_solver(spark):
    every = series()
    hist = spark.createDataFrame([("h", k, START + dt.timedelta(days=d), v) for k, rows in every.items() for d, v in rows], SCHEMA)
    days = np.arange(255, 290)
    target = spark.createDataFrame([("h", k, START + dt.timedelta(days=int(d)), None) for k in [*every, "new"] for d in days], SCHEMA)
    got = {(r["storetype_id"], (r["date"] - START).days): r["predicted_fbprophet"]
           for r in A.laplace_trend_forecast(hist, target).collect()}
    assert len(got) == 6 * len(days)
    assert all(got[k, d] is None for k in ("nan", "new") for d in days)
    assert all(got["zero", d] == 0 for d in days)
    want, deltas = raw_fit(every["bend"], days)
    assert np.allclose([got["bend", d] for d in days], want, rtol=1e-3)
    assert (deltas == 0).sum() >= 5 and (deltas != 0).any()
    assert np.allclose([got["flat", d] for d in days], 7.0, atol=0.05)
    assert all(got["short", d] is not None for d in days)


def test_cells_give_the_normal_equations(spark):
    rows = series()["bend"]
    hist = spark.createDataFrame([("h", "s", START + dt.timedelta(days=d), v) for d, v in rows], SCHEMA)
    r = A.cell_sums(hist, "sales", ["hierarchy1_id", "storetype_id"], 6).first()
    xx, xy, yy, n = A.normal_equations(np.array([list(c) for c in r["cells"]]), np.array(r["changes"]))
    day = np.array([d for d, _ in rows], float)
    y, t = np.array([v for _, v in rows]) / r["scale"], (day - day[0]) / r["span"]
    X = np.column_stack((np.ones(len(t)), t, *[np.maximum(t - c, 0) for c in r["changes"]],
                         np.array([A.season_row((START + dt.timedelta(days=int(d))).weekday()) for d in day])))
    assert np.allclose(xx, X.T @ X) and np.allclose(xy, X.T @ y) and np.isclose(yy, y @ y) and n == len(y)
    assert len(r["changes"]) == 6 and list(r["changes"]) == sorted(r["changes"])
