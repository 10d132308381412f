"""Recursive day-by-day forecast, all groups at once.

Two engines with the same rules. ``recursive_states`` scores boosted trees of
``operators.boosting`` in one Spark job: groups are dealt to buckets, and a
task rolls the days of its groups forward together, as arrays over groups.
``recursive_forecast`` serves MLlib models: each day is one distributed
transform over one row per group, with a reliable checkpoint every few days.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.config import ForecastConfig, MANUAL_CYCLE_MAX
from panelcast.functions.calendar import CYCLIC_ORDER
from panelcast.functions.scalar import clamp_non_negative, log_transform
from panelcast.operators import models as MD
from panelcast.operators.boosting import BoostedTrees, name_of
from panelcast.session import ensure_checkpoint_dir, cut_lineage


def _p(col: str = "predicted") -> Column:
    return clamp_non_negative(log_transform(col, "back"))


def _p_sql(col: str = "predicted") -> str:
    """Back-transformed, clamped forecast as SQL text (NULL stays NULL)."""
    return f"(CASE WHEN expm1(`{col}`) < 0 THEN 0.0D ELSE expm1(`{col}`) END)"


def _project(df: DataFrame, overrides: dict[str, str], keep_new_order: bool = False) -> DataFrame:
    """One projection: every column of `df`, with `overrides` (SQL text)
    replacing or adding columns. A single selectExpr call keeps per-step
    planning cost independent of the feature count."""
    cols = list(df.columns)
    items = [f"{overrides[c]} AS {name_of(c)}" if c in overrides else name_of(c) for c in cols]
    items += [f"{e} AS {name_of(c)}" for c, e in overrides.items() if c not in cols]
    return df.selectExpr(*items)


def _cyclic_sql(d: str) -> dict[str, str]:
    out = {}
    for c in CYCLIC_ORDER:
        v = f"quarter({d})" if c == "quarter" else f"`{c}`"
        arg = f"(2.0D * pi() * CAST({v} AS DOUBLE) / {float(MANUAL_CYCLE_MAX[c])!r}D)"
        out[f"{c}_sin"], out[f"{c}_cos"] = f"sin({arg})", f"cos({arg})"
    return out


def advance_state_compat(state: DataFrame, d: dt.date, lags, pred_col: str = "predicted") -> DataFrame:
    """O44 as in the reference: only the 1-day total takes the last forecast
    (the loop's update cancels for the others); to-date sums hold only the last
    forecast, reset when the ISO week / month number grows; ratios use the
    frozen prior-year totals; date parts and fixed-divisor cyclic columns of d."""
    p = _p_sql(pred_col)
    dd = f"DATE'{d.isoformat()}'"
    ov = {}
    for k in lags:
        name = f"total_sales_last_{k}_days"
        ov[name] = p if k == 1 else f"(`{name}` - {p} + {p})"
    ov["week_sales_to_date"] = f"CASE WHEN weekofyear({dd}) > `week` THEN 0.0D ELSE {p} END"
    ov["month_sales_to_date"] = f"CASE WHEN month({dd}) > `month` THEN 0.0D ELSE {p} END"
    x = _project(state, ov)
    ov2 = {"percentage_sold_of_month": "try_divide(month_sales_to_date, avg_same_month_sales)",
           "percentage_sold_of_week": "try_divide(week_sales_to_date, avg_same_week_sales)",
           "date": dd, "weekday": f"weekday({dd})", "week": f"weekofyear({dd})",
           "month": f"month({dd})", "year": f"year({dd})"}
    x = _project(x, ov2)
    return _project(x, _cyclic_sql(dd))


def _history_arrays(panel: DataFrame, cfg: ForecastConfig, depth: int) -> DataFrame:
    """Last `depth` rows before the prediction start per group, as an array
    (bounded by `depth`, not by the data)."""
    t = cfg.target
    w = Window.partitionBy(*cfg.keys).orderBy(F.col("date").desc())
    h = panel.where(F.col("date") < F.lit(cfg.prediction_start).cast("date")) \
             .withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= depth)
    return h.groupBy(*cfg.keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col("date").alias("d"), F.col(t).cast("double").alias("v"))))
         .alias("__hist"))


STATE_COLS = ("__hist", "__mtd", "__wtd", "__last_date", "__last_ym", "__last_yw", "__last_pred")


def advance_state_rolling(state: DataFrame, feats_d: DataFrame, d: dt.date, cfg: ForecastConfig) -> DataFrame:
    """O44 default mode: append the last forecast to the group's history and
    recompute lags, totals, to-date sums and ratios for d; every other
    feature is the panel's own value for (d, K)."""
    k = list(cfg.keys)
    depth = max(cfg.lags)
    p = _p_sql("__last_pred")
    s = state.selectExpr(*[f"`{c}`" for c in k],
                         f"slice(concat(__hist, array(named_struct('d', __last_date, 'v', {p}))), "
                         f"greatest(size(__hist) + 1 - {depth - 1}, 1), {depth}) AS __hist",
                         "__mtd", "__wtd", "__last_date", "__last_ym", "__last_yw", "__last_pred",
                         *[c for c in state.columns if c == "__out"])
    x = feats_d.drop(*[c for c in STATE_COLS if c in feats_d.columns]).join(s, k)
    lag_vals = []
    for j in cfg.lags:
        e = f"try_element_at(__hist, -{j})"
        lag_vals.append(f"(CASE WHEN size(__hist) < {j} THEN CAST(NULL AS DOUBLE) "
                        f"WHEN datediff(`date`, {e}.d) = {j} THEN {e}.v ELSE 0.0D END)")
    ov = {}
    for n in cfg.lags:
        if cfg.lag_mode == "calendar":
            ov[f"total_sales_last_{n}_days"] = (
                f"aggregate(filter(__hist, r -> datediff(`date`, r.d) <= {n}), 0.0D, "
                f"(acc, r) -> acc + coalesce(r.v, 0.0D))")
        else:
            ov[f"total_sales_last_{n}_days"] = "(" + " + ".join(
                f"coalesce({v}, 0.0D)" for v in lag_vals[:n]) + ")"
    ov["month_sales_to_date"] = f"CASE WHEN year_month = __last_ym THEN __mtd + {p} ELSE 0.0D END"
    ov["week_sales_to_date"] = f"CASE WHEN year_week = __last_yw THEN __wtd + {p} ELSE 0.0D END"
    x = _project(x, ov)
    return _project(x, {
        "percentage_sold_of_month": "try_divide(month_sales_to_date, avg_same_month_sales)",
        "percentage_sold_of_week": "try_divide(week_sales_to_date, avg_same_week_sales)"})


def _predict(model, df: DataFrame, feature_cols, out: str = "predicted") -> DataFrame:
    x = MD.with_features(df.drop("features"), feature_cols)
    return model.transform(x).withColumnRenamed("prediction", out)


OUT = "__out"


def recursive_forecast(model, predict_frame: DataFrame, panel: DataFrame, feature_cols,
                       cfg: ForecastConfig, checkpoint_every: int = 6) -> DataFrame:
    """Predict the first day from its panel row, then roll forward one day
    at a time for every group in parallel. The state (one row per group)
    carries its forecasts so far in an array bounded by the horizon; lineage
    is cut every `checkpoint_every` days. Returns (date, K, predicted) with
    predictions back-transformed and clamped once at the end."""
    ensure_checkpoint_dir(predict_frame.sparkSession)
    k = list(cfg.keys)
    kq = [f"`{c}`" for c in k]
    days = [cfg.prediction_start + dt.timedelta(days=i) for i in range(cfg.horizon)]
    predict_frame = cut_lineage(predict_frame)
    first = predict_frame.where(F.col("date") == F.lit(days[0]).cast("date"))
    append = f"array(named_struct('date', `date`, 'predicted', predicted))"
    state = _predict(model, first, feature_cols).drop("features")
    state = _project(state, {OUT: append})
    if not cfg.compat:
        hist = _history_arrays(panel, cfg, max(cfg.lags))
        state = (state.join(hist, k, "left")
                      .selectExpr(*kq, "coalesce(__hist, array()) AS __hist",
                                  "month_sales_to_date AS __mtd", "week_sales_to_date AS __wtd",
                                  "`date` AS __last_date", "year_month AS __last_ym", "year_week AS __last_yw",
                                  "predicted AS __last_pred", OUT))
    state = state.checkpoint(eager=True)
    for i, d in enumerate(days[1:], 1):
        if cfg.compat:
            nxt = advance_state_compat(state, d, cfg.lags)
            pr = _predict(model, nxt.drop("predicted"), feature_cols).drop("features")
            state = _project(pr, {OUT: f"concat({OUT}, {append})"})
        else:
            fd = predict_frame.where(F.col("date") == F.lit(d).cast("date"))
            row = advance_state_rolling(state, fd, d, cfg)
            pr = _predict(model, row, feature_cols)
            state = pr.selectExpr(*kq, "__hist", "month_sales_to_date AS __mtd",
                                  "week_sales_to_date AS __wtd", "`date` AS __last_date",
                                  "year_month AS __last_ym", "year_week AS __last_yw",
                                  "predicted AS __last_pred", f"concat({OUT}, {append}) AS {OUT}")
        if i % checkpoint_every == 0 or i == len(days) - 1:
            state = state.checkpoint(eager=True)
    out = state.selectExpr(*kq, f"explode({OUT}) AS __o").selectExpr("__o.date AS date", *kq,
                                                                      "__o.predicted AS predicted")
    return out.withColumn("predicted", _p("predicted"))


# ---------------------------------------------------------------- one job for the horizon
GROUPS_A_BUCKET = 500


def _clamped(x: np.ndarray) -> np.ndarray:
    """Back-transformed forecasts, negative ones 0 (NaN stays)."""
    p = np.expm1(x)
    return np.where(p < 0, 0.0, p)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(len(a), np.nan), where=(b != 0) & ~np.isnan(b) & ~np.isnan(a))


class _States:
    """The groups of one bucket and fit: feature rows by (group, day) and what the recursion carries."""

    def __init__(self, pdf: pd.DataFrame, cfg: ForecastConfig, feature_cols, groups: int):
        self.cfg, self.pos = cfg, {c: i for i, c in enumerate(feature_cols)}
        self.g, self.h = groups, len(pdf) // groups
        self.X = pdf[[f"__f{i}" for i in range(len(feature_cols))]].to_numpy(float).reshape(groups, self.h, -1)
        for name in ("__day", "week", "month", "avg_same_month_sales", "avg_same_week_sales",
                     "month_sales_to_date", "week_sales_to_date"):
            setattr(self, name.strip("_"), pdf[name].to_numpy(float).reshape(groups, self.h))
        self.ym, self.yw = (pdf[c].to_numpy().reshape(groups, self.h) for c in ("year_month", "year_week"))

    def put(self, X, name, values):
        if name in self.pos:
            X[:, self.pos[name]] = values

    def forecast(self, score, history) -> np.ndarray:
        return self._compat(score) if self.cfg.compat else self._rolling(score, history)

    def _rolling(self, score, history):
        """O44 default: forecasts join the history; lags, totals, to-date sums and ratios follow from it."""
        depth, lags = max(self.cfg.lags), self.cfg.lags
        value, day = np.full((self.g, depth), np.nan), np.full((self.g, depth), -np.inf)
        for k, rows in enumerate(history):
            for j, r in enumerate(reversed([] if rows is None else list(rows)[-depth:])):
                value[k, -1 - j], day[k, -1 - j] = np.nan if r["v"] is None else r["v"], r["d"]
        out = np.empty((self.g, self.h))
        out[:, 0] = score(self.X[:, 0])
        month, week = self.month_sales_to_date[:, 0], self.week_sales_to_date[:, 0]
        for i in range(1, self.h):
            p, today = _clamped(out[:, i - 1]), self.day[:, i]
            value = np.column_stack((value[:, 1:], p))
            day = np.column_stack((day[:, 1:], self.day[:, i - 1]))
            X = self.X[:, i].copy()
            lagged = [np.where(np.isinf(day[:, -k]), np.nan, np.where(today - day[:, -k] == k, value[:, -k], 0.0)) for k in lags]
            for n in lags:
                if self.cfg.lag_mode == "calendar":
                    total = np.where(today[:, None] - day <= n, np.nan_to_num(value), 0.0).sum(axis=1)
                else:
                    total = np.nan_to_num(np.array(lagged[:n])).sum(axis=0)
                self.put(X, f"total_sales_last_{n}_days", total)
            month = np.where(self.ym[:, i] == self.ym[:, i - 1], month + p, 0.0)
            week = np.where(self.yw[:, i] == self.yw[:, i - 1], week + p, 0.0)
            self._progress(X, month, week, self.avg_same_month_sales[:, i], self.avg_same_week_sales[:, i])
            out[:, i] = score(X)
        return out

    def _progress(self, X, month, week, same_month, same_week):
        self.put(X, "month_sales_to_date", month)
        self.put(X, "week_sales_to_date", week)
        self.put(X, "percentage_sold_of_month", _ratio(month, same_month))
        self.put(X, "percentage_sold_of_week", _ratio(week, same_week))

    def _compat(self, score):
        """O44 as in the reference: the first day's row is carried on (see ``advance_state_compat``)."""
        out = np.empty((self.g, self.h))
        X = self.X[:, 0].copy()
        out[:, 0] = score(X)
        old_week, old_month = self.week[:, 0], self.month[:, 0]
        dates = pd.to_datetime(self.day.astype("int64").ravel(), unit="D")
        parts = {"weekday": dates.weekday, "week": dates.isocalendar().week, "month": dates.month,
                 "quarter": dates.quarter, "year": dates.year}
        parts = {k: np.asarray(v, float).reshape(self.g, self.h) for k, v in parts.items()}
        for i in range(1, self.h):
            p = _clamped(out[:, i - 1])
            for k in self.cfg.lags:
                name = f"total_sales_last_{k}_days"
                if name in self.pos:
                    x = X[:, self.pos[name]]
                    X[:, self.pos[name]] = p if k == 1 else x - p + p
            now = {k: v[:, i] for k, v in parts.items()}
            week, month = np.where(now["week"] > old_week, 0.0, p), np.where(now["month"] > old_month, 0.0, p)
            self._progress(X, month, week, self.avg_same_month_sales[:, 0], self.avg_same_week_sales[:, 0])
            for name in ("weekday", "week", "month", "year"):
                self.put(X, name, now[name])
            for c in CYCLIC_ORDER:
                a = 2 * np.pi * now[c] / float(MANUAL_CYCLE_MAX[c])
                self.put(X, f"{c}_sin", np.sin(a))
                self.put(X, f"{c}_cos", np.cos(a))
            old_week, old_month = now["week"], now["month"]
            out[:, i] = score(X)
        return out


def recursive_states(model: BoostedTrees, predict_frame: DataFrame, panel: DataFrame, feature_cols, cfg: ForecastConfig,
                     fit_col: str | None = None) -> DataFrame:
    """O45 for boosted trees: (date, K, predicted) of every group in one job.

    ``predict_frame`` has one row per group and day of its window, without
    gaps (windows may differ between fits, ``fit_col`` being one of the keys
    then); ``panel`` holds the days before. A task holds ``GROUPS_A_BUCKET``
    groups at a time, each with its window and ``max(lags)`` days before it.
    """
    k, depth = list(cfg.keys), max(cfg.lags)
    on = [name_of(c) for c in k]
    day = F.datediff("date", F.lit("1970-01-01").cast("date"))
    starts = predict_frame.groupBy(*on).agg(F.min("date").alias("__start"))
    last = Window.partitionBy(*on).orderBy(F.col("date").desc())
    before = (panel.select(*on, "date", F.col(name_of(cfg.target)).cast("double").alias("v")).join(starts, k)
              .where(F.col("date") < F.col("__start")).withColumn("__rn", F.row_number().over(last)).where(F.col("__rn") <= depth)
              .groupBy(*on).agg(F.sort_array(F.collect_list(F.struct(day.cast("double").alias("d"), "v"))).alias("__hist")))
    extra = ["week", "month", "year_month", "year_week", "month_sales_to_date", "week_sales_to_date",
             "avg_same_month_sales", "avg_same_week_sales"]
    n = max(1, -(-starts.count() // GROUPS_A_BUCKET))
    rows = (predict_frame.join(starts.join(before, k, "left"), k)
            .select(*on, "date", day.alias("__day"), *extra, (F.col(name_of(fit_col)) if fit_col else F.lit("all")).alias("__fit"),
                    F.when(F.col("date") == F.col("__start"), F.col("__hist")).alias("__hist"),
                    F.pmod(F.xxhash64(*on), F.lit(n)).cast("int").alias("__bucket"),
                    *[F.expr(f"cast({name_of(c)} as double)").alias(f"__f{i}") for i, c in enumerate(feature_cols)]))

    def run(pdf):
        out = []
        for fit, part in pdf.groupby("__fit", sort=False):
            part = part.sort_values([*k, "date"]).reset_index(drop=True)
            first = np.flatnonzero(~part.duplicated(k))
            size = np.diff([*first, len(part)])
            gap = np.diff(part["__day"].to_numpy()) != 1
            gap[first[1:] - 1] = False
            if (size != size[0]).any() or gap.any():
                raise RuntimeError("prediction window has a gap for a group")
            s = _States(part, cfg, feature_cols, len(first))
            x = s.forecast(lambda X: model.predict(fit, X), part["__hist"].iloc[first])
            out.append(part[["date", *k]].assign(predicted=_clamped(x).ravel()))
        return pd.concat(out)

    fields = [f for f in predict_frame.schema.fields if f.name in k]
    schema = T.StructType([T.StructField("date", T.DateType()), *sorted(fields, key=lambda f: k.index(f.name)),
                           T.StructField("predicted", T.DoubleType())])
    return rows.groupBy("__bucket").applyInPandas(run, schema)
