"""Brute-force version of the recursive forecast: one group after another, day by
day, in numpy, with the fitted trees read from the model's text form."""

from __future__ import annotations

import datetime as dt
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig, MANUAL_CYCLE_MAX
from panelcast.functions.calendar import CYCLIC_ORDER
from panelcast.operators import models as MD
from panelcast.operators.boosting import BoostedTrees
from panelcast.operators.recursive import _history_arrays, _p

cloudpickle.register_pickle_by_value(sys.modules[__name__])
import re

import numpy as np

_IF = re.compile(r"^\s*If \(feature (\d+) <= (\S+)\)\s*$")
_ELSE = re.compile(r"^\s*Else \(feature (\d+) > (\S+)\)\s*$")
_LEAF = re.compile(r"^\s*Predict: (\S+)\s*$")
_TREE = re.compile(r"^\s*Tree (\d+) \(weight (\S+)\):\s*$")


def _parse_tree(lines, i):
    """Pre-order parse starting at lines[i]; returns (nodes, next index).
    node = [feature, threshold, left, right, value]; leaves have feature -1."""
    nodes = []

    def rec(i):
        m = _LEAF.match(lines[i])
        me = len(nodes)
        if m:
            nodes.append([-1, 0.0, -1, -1, float(m.group(1))])
            return i + 1
        m = _IF.match(lines[i])
        if not m:
            raise ValueError(f"unexpected tree line: {lines[i]!r}")
        nodes.append([int(m.group(1)), float(m.group(2)), -1, -1, 0.0])
        nodes[me][2] = len(nodes)
        i = rec(i + 1)
        if not _ELSE.match(lines[i]):
            raise ValueError(f"expected Else: {lines[i]!r}")
        nodes[me][3] = len(nodes)
        return rec(i + 1)

    return nodes, rec(i)


def export_ensemble(model) -> dict:
    """Parse ``model.toDebugString`` (continuous splits only, which is all a
    vector without categorical metadata produces)."""
    lines = [ln for ln in model.toDebugString.splitlines() if ln.strip()]
    trees, weights = [], []
    i = 1
    while i < len(lines):
        m = _TREE.match(lines[i])
        if not m:
            raise ValueError(f"expected tree header: {lines[i]!r}")
        weights.append(float(m.group(2)))
        nodes, i = _parse_tree(lines, i + 1)
        a = np.array(nodes, dtype=float)
        trees.append({"feature": a[:, 0].astype(np.int64), "threshold": a[:, 1],
                      "left": a[:, 2].astype(np.int64), "right": a[:, 3].astype(np.int64), "value": a[:, 4]})
    return {"trees": trees, "weights": np.array(weights)}


def predict(ens: dict, X: np.ndarray) -> np.ndarray:
    """Sum of weight x leaf value; a split sends `x <= threshold` left."""
    X = np.atleast_2d(X)
    n = X.shape[0]
    rows = np.arange(n)
    out = np.zeros(n)
    for t, w in zip(ens["trees"], ens["weights"]):
        idx = np.zeros(n, dtype=np.int64)
        while True:
            f = t["feature"][idx]
            internal = f >= 0
            if not internal.any():
                break
            x = X[rows, np.where(internal, f, 0)]
            go_left = x <= t["threshold"][idx]
            nxt = np.where(go_left, t["left"][idx], t["right"][idx])
            idx = np.where(internal, nxt, idx)
        out += w * t["value"][idx]
    return out


def recursive_forecast_grouped(model, predict_frame: DataFrame, panel: DataFrame, feature_cols,
                               cfg: ForecastConfig) -> DataFrame:
    """O45 as one Spark job: the prediction-window rows are grouped by K (a
    group holds at most `horizon` rows plus a `max(lags)`-long history, both
    fixed by the configuration), and each group rolls its days forward in
    numpy with the fitted trees. Same state rules as the per-day engine
    (``recursive_forecast``); the tests check that both agree."""
    missing = MD.MISSING
    cyc_order, cyc_max = tuple(CYCLIC_ORDER), dict(MANUAL_CYCLE_MAX)

    if isinstance(model, BoostedTrees):         # takes missing values as they are
        def score(row):
            return model.predict("all", row[None, :])[0]
    else:
        ens = export_ensemble(model)

        def score(row):
            return predict(ens, fill(row))[0]
    k = list(cfg.keys)
    lags, compat, mode = tuple(cfg.lags), cfg.compat, cfg.lag_mode
    depth, horizon, start = max(lags), cfg.horizon, cfg.prediction_start
    fcols = list(feature_cols)
    pos = {c: i for i, c in enumerate(fcols)}
    extra = ["week", "month", "year_month", "year_week", "month_sales_to_date", "week_sales_to_date",
             "avg_same_month_sales", "avg_same_week_sales"]
    cols = ["date", *k, *dict.fromkeys([*fcols, *extra])]
    frame = predict_frame.select(*[F.col(f"`{c}`") for c in cols])
    if not compat:
        frame = frame.join(_history_arrays(panel, cfg, depth), k, "left")
    else:
        frame = frame.withColumn("__hist", F.lit(None).cast("array<struct<d:date,v:double>>"))
    two_pi = 2 * np.pi

    def fill(row):
        r = np.where(np.isnan(row), missing, row)
        return r

    def setv(row, c, v):
        if c in pos:
            row[pos[c]] = v

    def getv(row, c, fallback):
        return row[pos[c]] if c in pos else fallback

    def clampb(x):
        p = np.expm1(x)
        return 0.0 if p < 0 else p  # NaN stays NaN (comparison is False)

    def ratio(a, b):
        if b is None or np.isnan(b) or b == 0 or a is None or np.isnan(a):
            return np.nan
        return a / b

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date").reset_index(drop=True)
        days = [start + dt.timedelta(days=i) for i in range(horizon)]
        dates = [pd.Timestamp(x).date() for x in pdf["date"]]
        Xall = pdf[fcols].astype(float).to_numpy()
        num = lambda c, i: float(pdf[c].iloc[i]) if pd.notna(pdf[c].iloc[i]) else np.nan
        by_day = {d: i for i, d in enumerate(dates)}
        if days[0] not in by_day:
            raise RuntimeError("prediction start row missing for a group")
        i0 = by_day[days[0]]
        preds = np.full(horizon, np.nan)
        preds[0] = score(Xall[i0])
        if compat:
            row = Xall[i0].copy()
            week_prev, month_prev = int(pdf["week"].iloc[i0]), int(pdf["month"].iloc[i0])
            avg_m, avg_w = num("avg_same_month_sales", i0), num("avg_same_week_sales", i0)
            for i in range(1, horizon):
                d = days[i]
                p = clampb(preds[i - 1])
                for lag in lags:
                    c = f"total_sales_last_{lag}_days"
                    if c in pos:
                        row[pos[c]] = p if lag == 1 else row[pos[c]] - p + p
                wk, mo = d.isocalendar()[1], d.month
                wtd = 0.0 if wk > week_prev else p
                mtd = 0.0 if mo > month_prev else p
                setv(row, "week_sales_to_date", wtd)
                setv(row, "month_sales_to_date", mtd)
                setv(row, "percentage_sold_of_month", ratio(mtd, getv(row, "avg_same_month_sales", avg_m)))
                setv(row, "percentage_sold_of_week", ratio(wtd, getv(row, "avg_same_week_sales", avg_w)))
                vals = {"weekday": d.weekday(), "week": wk, "month": mo, "quarter": (mo - 1) // 3 + 1}
                setv(row, "weekday", vals["weekday"])
                setv(row, "year", d.year)
                for c in cyc_order:
                    a = two_pi * float(vals[c]) / float(cyc_max[c])
                    setv(row, f"{c}_sin", np.sin(a))
                    setv(row, f"{c}_cos", np.cos(a))
                week_prev, month_prev = wk, mo
                preds[i] = score(row)
        else:
            h = pdf["__hist"].iloc[0]
            hist = [] if h is None else [(pd.Timestamp(e["d"]).date(), np.nan if e["v"] is None else float(e["v"]))
                                         for e in h]
            mtd, wtd = num("month_sales_to_date", i0), num("week_sales_to_date", i0)
            last_d, last_ym, last_yw = days[0], pdf["year_month"].iloc[i0], pdf["year_week"].iloc[i0]
            for i in range(1, horizon):
                d = days[i]
                if d not in by_day:
                    raise RuntimeError("prediction window has a gap for a group")
                j = by_day[d]
                p = clampb(preds[i - 1])
                hist = (hist + [(last_d, p)])[-depth:]
                row = Xall[j].copy()
                lv = []
                for lag in lags:
                    if len(hist) < lag:
                        lv.append(np.nan)
                    else:
                        e = hist[-lag]
                        lv.append(e[1] if (d - e[0]).days == lag else 0.0)
                for n in lags:
                    if mode == "calendar":
                        tot = sum(0.0 if np.isnan(v) else v for (dd_, v) in hist if (d - dd_).days <= n)
                    else:
                        tot = sum(0.0 if np.isnan(v) else v for v in lv[:n])
                    setv(row, f"total_sales_last_{n}_days", tot)
                ym, yw = pdf["year_month"].iloc[j], pdf["year_week"].iloc[j]
                mtd = mtd + p if ym == last_ym else 0.0
                wtd = wtd + p if yw == last_yw else 0.0
                setv(row, "month_sales_to_date", mtd)
                setv(row, "week_sales_to_date", wtd)
                setv(row, "percentage_sold_of_month", ratio(mtd, num("avg_same_month_sales", j)))
                setv(row, "percentage_sold_of_week", ratio(wtd, num("avg_same_week_sales", j)))
                preds[i] = score(row)
                last_d, last_ym, last_yw = d, ym, yw
        out = pd.DataFrame({"date": days, "predicted": preds})
        for c in k:
            out[c] = pdf[c].iloc[0]
        return out[["date", *k, "predicted"]]

    key_types = {f.name: f.dataType.simpleString() for f in predict_frame.schema.fields if f.name in k}
    schema = "date date, " + ", ".join(f"`{c}` {key_types[c]}" for c in k) + ", predicted double"
    res = frame.groupBy(*k).applyInPandas(run, schema)
    return res.withColumn("predicted", _p("predicted"))
