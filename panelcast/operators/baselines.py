"""Baseline forecasts: trend + weekly season (O46), seasonal average (O47),
both together (O48), and the printed summary of the averages (O62).

All groups are fitted at once with grouped aggregates; the reference loops
over groups one by one. Per-group state is a handful of sums, so a hot
group costs the same as any other after map-side combine.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.config import ForecastConfig, KEYS
from panelcast.functions.scalar import clamp_non_negative
from panelcast.operators.additive import laplace_trend_forecast
from panelcast.operators.panel import filter_date_range


# ---------------------------------------------------------------- O47
def seasonal_average_baseline(history: DataFrame, prediction: DataFrame, target: str = "sales",
                              keys=KEYS) -> DataFrame:
    """O47. Y = latest prediction year of the group. If the history has any
    row before Y: mean by `weekday_week` times trend (sum in Y / sum in Y-1,
    1 when Y-1 is absent). Otherwise mean by weekday over year Y. Clamped;
    NULL for unseen keys and for a 0 denominator (pandas gives inf).

    History and prediction rows go into one frame; every statistic is a
    window over K or (K, weekday[_week]), so one hash partitioning on K
    serves all of them: a single exchange, no per-group tables joined back.
    `prediction` needs (date, year, weekday_week, weekday, K)."""
    k = list(keys)
    cols = ["date", "year", "weekday", "weekday_week", *k]
    pr = prediction.select(*cols).distinct().withColumn(target, F.lit(None).cast("double")) \
                   .withColumn("__pred", F.lit(True))
    h = history.select(*cols, F.col(target).cast("double").alias(target)).withColumn("__pred", F.lit(False))
    u = h.unionByName(pr)
    wk = Window.partitionBy(*k)
    hist, y, t = ~F.col("__pred"), F.col("year"), F.col(target)
    u = u.withColumn("__Y", F.max(F.when(F.col("__pred"), y)).over(wk))
    Y = F.col("__Y")
    u = u.withColumns({
        "__has_prev": F.max(F.when(hist & (y < Y), 1)).over(wk),
        "__has_ym1": F.max(F.when(hist & (y == Y - 1), 1)).over(wk),
        "__sY": F.coalesce(F.sum(F.when(hist & (y == Y), t)).over(wk), F.lit(0.0)),
        "__sY1": F.coalesce(F.sum(F.when(hist & (y == Y - 1), t)).over(wk), F.lit(0.0)),
        "__avg_ww": F.avg(F.when(hist, t)).over(Window.partitionBy(*k, "weekday_week")),
        "__avg_wd": F.avg(F.when(hist & (y == Y), t)).over(Window.partitionBy(*k, "weekday")),
    })
    trend = F.when(F.col("__has_ym1") == 1, F.try_divide(F.col("__sY"), F.col("__sY1"))).otherwise(F.lit(1.0))
    val = F.when(F.col("__has_prev") == 1, F.col("__avg_ww") * trend).otherwise(F.col("__avg_wd"))
    return u.where(F.col("__pred")).select("date", *k, clamp_non_negative(val).alias("predicted_seasonal_average"))


def seasonal_average_summary(history: DataFrame, prediction: DataFrame, target: str = "sales",
                             keys=KEYS) -> DataFrame:
    """Min / mean / max of the per-group averages the baseline uses."""
    k = list(keys)
    pr = prediction.select("year", *k).distinct()
    ymax = pr.groupBy(*k).agg(F.max("year").alias("__Y"))
    h = history.select(*k, "year", "weekday", "weekday_week", target).join(ymax, k)
    has_prev = h.groupBy(*k).agg(F.max((F.col("year") < F.col("__Y")).cast("int")).alias("__has_prev"))
    ww = h.groupBy(*k, "weekday_week").agg(F.avg(target).alias("a")).withColumn("__by", F.lit("weekday_week"))
    wd = h.where(F.col("year") == F.col("__Y")).groupBy(*k, "weekday").agg(F.avg(target).alias("a")) \
          .withColumn("__by", F.lit("weekday"))
    both = ww.select(*k, "__by", "a").unionByName(wd.select(*k, "__by", "a")).join(has_prev, k)
    chosen = both.where(F.when(F.col("__has_prev") == 1, F.col("__by") == "weekday_week")
                         .otherwise(F.col("__by") == "weekday"))
    return chosen.groupBy(*k).agg(F.min("a").alias("avg_min"), F.avg("a").alias("avg_mean"),
                                  F.max("a").alias("avg_max"))


# ---------------------------------------------------------------- O46 (a)
def _days_since(start: dt.date):
    return F.datediff(F.col("date"), F.lit(start).cast("date")).cast("double")


def linear_trend_forecast(history: DataFrame, apply_to: DataFrame, origin, target: str = "sales",
                          keys=KEYS, out_col: str = "predicted_fbprophet") -> DataFrame:
    """O46(a): per group least-squares line on x = days since `origin` (a
    date, or the name of a date column carried by both frames), plus the mean
    residual by weekday; clamped. `apply_to` needs (date, K).

    Like O47: one frame of history + target rows, window aggregates over K
    and (K, weekday), one exchange."""
    k = list(keys)
    extra = [origin] if isinstance(origin, str) else []
    o = F.col(origin) if extra else F.lit(origin).cast("date")
    h = history.select("date", *k, *extra, F.col(target).cast("double").alias("__y")) \
               .withColumn("__fit", F.lit(True))
    a = apply_to.select("date", *k, *extra).distinct().withColumn("__y", F.lit(None).cast("double")) \
                .withColumn("__fit", F.lit(False))
    u = h.unionByName(a).withColumn("__x", F.datediff(F.col("date"), o).cast("double")) \
         .withColumn("__wd", F.weekday("date"))
    fit, y, x = F.col("__fit"), F.col("__y"), F.col("__x")
    wk = Window.partitionBy(*k)
    u = u.withColumns({"__a": F.regr_intercept(F.when(fit, y), F.when(fit, x)).over(wk),
                       "__b": F.regr_slope(F.when(fit, y), F.when(fit, x)).over(wk)})
    u = u.withColumn("__e", F.avg(F.when(fit, y - F.col("__a") - F.col("__b") * x))
                     .over(Window.partitionBy(*k, "__wd")))
    yhat = F.col("__a") + F.col("__b") * x + F.coalesce(F.col("__e"), F.lit(0.0))
    return u.where(~fit).select("date", *k, clamp_non_negative(yhat).alias(out_col))


# ---------------------------------------------------------------- O46 (b)
N_CHANGEPOINTS = 8
N_FOURIER = 3


def _design_exprs(origin: dt.date, span_days: float):
    """Regressors: 1, t, hinge(t - c_j), weekly Fourier terms (t in [0, 1])."""
    t = _days_since(origin) / F.lit(float(max(span_days, 1.0)))
    wd = F.weekday("date").cast("double")
    cols = [F.lit(1.0), t]
    for j in range(N_CHANGEPOINTS):
        c = 0.8 * (j + 1) / (N_CHANGEPOINTS + 1)
        cols.append(F.greatest(t - F.lit(c), F.lit(0.0)))
    for m in range(1, N_FOURIER + 1):
        cols.append(F.sin(F.lit(2 * np.pi * m / 7.0) * wd))
        cols.append(F.cos(F.lit(2 * np.pi * m / 7.0) * wd))
    return cols


def ridge_trend_forecast(history: DataFrame, apply_to: DataFrame, origin: dt.date, end: dt.date,
                         target: str = "sales", keys=KEYS, out_col: str = "predicted_fbprophet",
                         changepoint_penalty: float = 10.0, base_penalty: float = 1e-6) -> DataFrame:
    """O46(b): piecewise-linear trend with 8 hinge changepoints and weekly
    Fourier season, ridge-penalised changepoints (a stand-in for Prophet's
    Laplace prior, changepoint scale 0.01).

    Spark computes the per-group sufficient statistics X'X and X'y with one
    grouped aggregate (map-side combined); a pandas function then solves one
    p x p system per group row. No raw rows reach Python."""
    k = list(keys)
    span = float((end - origin).days)
    X = _design_exprs(origin, span)
    p = len(X)
    h = history.select("date", *k, target).where(F.col(target).isNotNull())
    h = h.select(*k, F.col(target).alias("__y"), *[x.alias(f"__x{i}") for i, x in enumerate(X)])
    aggs = [F.count(F.lit(1)).alias("n"), F.max(F.abs("__y")).alias("ymax")]
    for i in range(p):
        for j in range(i, p):
            aggs.append(F.sum(F.col(f"__x{i}") * F.col(f"__x{j}")).alias(f"xx_{i}_{j}"))
        aggs.append(F.sum(F.col(f"__x{i}") * F.col("__y")).alias(f"xy_{i}"))
    stats = h.groupBy(*k).agg(*aggs)
    key_fields = [f for f in stats.schema.fields if f.name in k]
    out_schema = T.StructType(key_fields + [T.StructField(f"b{i}", T.DoubleType()) for i in range(p)])
    pen = np.full(p, base_penalty)
    pen[2:2 + N_CHANGEPOINTS] = changepoint_penalty

    row, col = np.triu_indices(p)

    def solve(batches):
        for pdf in batches:
            A = np.zeros((len(pdf), p, p))
            A[:, row, col] = A[:, col, row] = pdf[[f"xx_{i}_{j}" for i, j in zip(row, col)]].to_numpy(float)
            b = pdf[[f"xy_{i}" for i in range(p)]].to_numpy(float)
            ymax = pdf["ymax"].to_numpy(float)
            scale = np.where(ymax > 0, ymax, 1.0)
            A = (A + np.diag(pen) * pdf["n"].to_numpy(float)[:, None, None]) / scale[:, None, None]
            # the penalty makes every finite system regular; a group with other numbers gets NULL
            ok = np.isfinite(A).all(axis=(1, 2)) & np.isfinite(b).all(axis=1)
            beta = np.full((len(pdf), p), np.nan)
            beta[ok] = np.linalg.solve(A[ok], (b / scale[:, None])[ok][:, :, None])[:, :, 0]
            fitted = pd.DataFrame(beta, columns=[f"b{i}" for i in range(p)], index=pdf.index)
            yield pd.concat([pdf[[f.name for f in key_fields]], fitted], axis=1)

    coef = stats.mapInPandas(solve, out_schema)
    a = apply_to.select("date", *k).distinct()
    a = a.select("date", *k, *[x.alias(f"__x{i}") for i, x in enumerate(X)]).join(coef, k, "left")
    yhat = sum((F.col(f"__x{i}") * F.col(f"b{i}") for i in range(1, p)), F.col("__x0") * F.col("b0"))
    return a.select("date", *k, clamp_non_negative(yhat).alias(out_col))


def trend_forecast(history: DataFrame, apply_to: DataFrame, cfg: ForecastConfig,
                   fit_start: dt.date, fit_end: dt.date, out_col: str = "predicted_fbprophet") -> DataFrame:
    h = filter_date_range(history, fit_start, fit_end)
    if cfg.trend_model == "laplace":
        return laplace_trend_forecast(h, apply_to, cfg.target, cfg.keys, out_col)
    if cfg.trend_model == "ridge":
        return ridge_trend_forecast(h, apply_to, fit_start, fit_end, cfg.target, cfg.keys, out_col)
    return linear_trend_forecast(h, apply_to, fit_start, cfg.target, cfg.keys, out_col)


# ---------------------------------------------------------------- O48
def baseline_models(panel: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Both baselines fitted on train start .. test end, for every
    (date, K) of the prediction window."""
    hist = filter_date_range(panel, cfg.train_start, cfg.test_end)
    pred = filter_date_range(panel, cfg.prediction_start, cfg.prediction_end)
    sa = seasonal_average_baseline(hist, pred, cfg.target, cfg.keys)
    tr = trend_forecast(panel, pred, cfg, cfg.train_start, cfg.test_end)
    return sa.join(tr, ["date", *cfg.keys], "inner") \
             .select("date", *cfg.keys, "predicted_seasonal_average", "predicted_fbprophet")
