"""Additive trend model with a Laplace prior on the trend's changes.

y = offset + slope t + sum d_j (t - c_j)+ + weekly and daily season, t scaled
to the group's history. The changepoints c_j lie at even quantiles of the first
80 % of its rows. The prior on d_j is Laplace, on all else normal (the scales
below), so most d_j are exactly zero.

Spark reduces each group to five sums per (weekday, segment between
changepoints): inside such a cell every regressor is linear in t, so these
sums give X'X and X'y exactly. A pandas function then runs coordinate descent
on them, for all groups of a batch at once; no panel row reaches Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.config import KEYS
from panelcast.functions.scalar import clamp_non_negative

# The trend library's defaults behind the reference's settings.
CHANGEPOINTS = 25
HISTORY_SHARE = 0.8
CHANGE_SCALE = 0.01         # the reference's changepoint prior scale
GROWTH_SCALE = 5.0          # offset and slope
SEASON_SCALE = 10.0
WEEKLY_ORDER, DAILY_ORDER = 3, 4
N_SEASON = 2 * (WEEKLY_ORDER + DAILY_ORDER)


def season_row(weekday: float) -> list[float]:
    """Fourier terms of a day: by weekday for the week, at midnight for the day."""
    out = []
    for order, x in ((WEEKLY_ORDER, weekday / 7.0), (DAILY_ORDER, 0.0)):
        for m in range(1, order + 1):
            out += [float(np.sin(2 * np.pi * m * x)), float(np.cos(2 * np.pi * m * x))]
    return out


def cell_sums(history: DataFrame, target: str, keys, changepoints: int) -> DataFrame:
    """One row per group: its span, scale, changepoints and cells (weekday, segment, n, t, tt, y, ty)."""
    k = list(keys)
    whole, order = Window.partitionBy(*k), Window.partitionBy(*k).orderBy("date")
    h = history.select("date", *k, F.col(target).cast("double").alias("y")).where(F.col("y").isNotNull())
    first, last = F.min("date").over(whole), F.max("date").over(whole)
    h = h.select(*k, "y", F.weekday("date").alias("weekday"), first.alias("start"),
                 F.greatest(F.datediff(last, first), F.lit(1)).cast("double").alias("span"),
                 F.try_divide(F.datediff("date", first).cast("double"), F.greatest(F.datediff(last, first), F.lit(1))).alias("t"),
                 F.max(F.abs("y")).over(whole).alias("scale"),
                 (F.row_number().over(order) - 1).alias("rn"),
                 F.floor(F.count(F.lit(1)).over(whole) * HISTORY_SHARE).alias("early"))
    h = h.withColumn("m", F.greatest(F.least(F.lit(changepoints), F.col("early") - 1), F.lit(0)).cast("int"))
    # rows at which the slope may change; the segment is how many of them lie before the row
    at = F.expr("transform(sequence(1, greatest(m, 1)), j -> cast(rint(j * (early - 1) / greatest(m, 1)) as int))")
    h = h.withColumn("at", F.when(F.col("m") > 0, at).otherwise(F.array().cast("array<int>")))
    h = h.withColumn("segment", F.expr("size(filter(at, i -> i < rn))")) \
         .withColumn("place", F.when(F.array_contains("at", F.col("rn")), F.struct("rn", "t")))
    scaled = F.try_divide("y", F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0)))
    cells = h.groupBy(*k, "start", "span", "scale", "at", "weekday", "segment").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("t").alias("t"), F.sum(F.col("t") * F.col("t")).alias("tt"),
        F.sum(scaled).alias("y"), F.sum(scaled * F.col("t")).alias("ty"), F.sum(scaled * scaled).alias("yy"),
        F.collect_list("place").alias("places"))
    # at most 7 x (changepoints + 1) cells and as many places as changepoints in a group
    out = cells.groupBy(*k, "start", "span", "scale").agg(
        F.max("at").alias("at"),
        F.map_from_entries(F.flatten(F.collect_list("places"))).alias("places"),
        F.collect_list(F.array(F.col("weekday").cast("double"), F.col("segment").cast("double"), "n", "t", "tt", "y", "ty", "yy")).alias("cells"))
    return out.withColumn("changes", F.expr("transform(at, i -> places[i])")).drop("at", "places")


def normal_equations(cells: np.ndarray, changes: np.ndarray):
    """X'X, X'y, y'y and the row count of one group from its cells."""
    p = 2 + len(changes) + N_SEASON
    xx, xy = np.zeros((p, p)), np.zeros(p)
    seasons = np.array([season_row(w) for w in range(7)])
    for weekday, segment, n, t, tt, y, ty, _ in cells:
        on = np.arange(len(changes)) < segment
        a = np.concatenate(([1.0, 0.0], np.where(on, -changes, 0.0), seasons[int(weekday)]))
        b = np.concatenate(([0.0, 1.0], on.astype(float), np.zeros(N_SEASON)))
        xx += n * np.outer(a, a) + t * (np.outer(a, b) + np.outer(b, a)) + tt * np.outer(b, b)
        xy += y * a + ty * b
    return xx, xy, cells[:, 7].sum(), cells[:, 2].sum()


def priors(n_changes: int, change_scale: float):
    """Curvatures of the normal priors and weights of the Laplace priors, by regressor."""
    ridge = np.concatenate((np.full(2, GROWTH_SCALE ** -2), np.zeros(n_changes), np.full(N_SEASON, SEASON_SCALE ** -2)))
    lasso = np.concatenate((np.zeros(2), np.full(n_changes, 1 / change_scale), np.zeros(N_SEASON)))
    return ridge, lasso


def coordinate_descent(xx, xy, yy, n, ridge, lasso, noise_steps: int = 5, sweeps: int = 1000, tol: float = 1e-7):
    """Posterior modes of the coefficients of all groups; noise variance and coefficients in turn.

    Per group (first axis) this minimises (y - Xb)'(y - Xb) / (2 s2) + ridge b^2 / 2
    + lasso |b| and then sets s2 to the mean squared residual, ``noise_steps``
    times. Regressors without rows (padding) keep the coefficient 0.
    """
    p, n = xy.shape[1], np.maximum(n, 1.0)
    cols, diag = [np.ascontiguousarray(xx[:, :, j]) for j in range(p)], np.einsum("gjj->gj", xx)
    b, s2 = np.zeros_like(xy), np.maximum(yy / n, 1e-12)
    for _ in range(noise_steps):
        rest = xy - np.einsum("gij,gj->gi", xx, b)          # X'y - X'X b, kept up to date
        curve = diag + ridge * s2[:, None]
        inverse = np.divide(1.0, curve, out=np.zeros_like(curve), where=curve > 0)
        bound = lasso * s2[:, None]
        for _ in range(sweeps):
            most = 0.0
            for j in range(p):
                old = b[:, j]
                rho = rest[:, j] + diag[:, j] * old
                new = (rho - np.clip(rho, -bound[:, j], bound[:, j])) * inverse[:, j]
                step = new - old
                size = np.abs(step).max()
                if size:
                    rest -= cols[j] * step[:, None]
                    b[:, j] = new
                    most = max(most, size)
            if most < tol:
                break
        s2 = np.maximum((yy - 2 * (xy * b).sum(axis=1) + np.einsum("gi,gij,gj->g", b, xx, b)) / n, 1e-12)
    return b


def laplace_trend_forecast(history: DataFrame, apply_to: DataFrame, target: str = "sales", keys=KEYS,
                           out_col: str = "predicted_fbprophet", changepoints: int = CHANGEPOINTS,
                           change_scale: float = CHANGE_SCALE) -> DataFrame:
    """O46 for every (date, K) of ``apply_to``: the fitted curve, clamped at 0.

    Groups without history, or with values that are no numbers, get NULL. The
    curve itself is evaluated by Spark expressions from the coefficients.
    """
    k = list(keys)
    stats = cell_sums(history, target, k, changepoints)
    fields = [f for f in stats.schema.fields if f.name in k]

    def solve(frames):
        for pdf in frames:
            cells = [np.array([list(c) for c in x], float) for x in pdf["cells"]]
            changes = [np.array(list(x), float) for x in pdf["changes"]]
            good = [i for i, c in enumerate(cells) if np.isfinite(c).all()]
            most, p = changepoints, 2 + changepoints + N_SEASON
            xx, xy, yy, n = np.zeros((len(good), p, p)), np.zeros((len(good), p)), np.zeros(len(good)), np.zeros(len(good))
            for g, i in enumerate(good):
                m = len(changes[i])
                at = np.r_[0:2 + m, 2 + most:p]             # groups with fewer changepoints are padded
                xx[g][np.ix_(at, at)], xy[g][at], yy[g], n[g] = normal_equations(cells[i], changes[i])
            beta = coordinate_descent(xx, xy, yy, n, *priors(most, change_scale))
            rows = [(None, None, None, None)] * len(pdf)
            for b, i in zip(beta, good):
                rows[i] = (float(b[0]), float(b[1]), b[2:2 + len(changes[i])].tolist(), b[2 + most:].tolist())
            out = pdf[[*k, "start", "span", "scale", "changes"]].reset_index(drop=True)
            yield pd.concat([out, pd.DataFrame(rows, columns=["b0", "b1", "deltas", "season"])], axis=1)

    double, array = T.DoubleType(), T.ArrayType(T.DoubleType())
    coef = stats.mapInPandas(solve, T.StructType([*fields, T.StructField("start", T.DateType()), *[
        T.StructField(c, d) for c, d in (("span", double), ("scale", double), ("changes", array), ("b0", double), ("b1", double),
                                         ("deltas", array), ("season", array))]]))
    table = F.array(*[F.array(*[F.lit(x) for x in season_row(w)]) for w in range(7)])
    t = F.datediff("date", "start").cast("double") / F.col("span")
    x = (apply_to.select("date", *k).distinct().join(coef, k, "left")
         .withColumns({"__t": t, "__s": F.get(table, F.weekday("date"))}))
    dot = "aggregate(zip_with({0}, {1}, (a, b) -> {2}), 0.0D, (s, v) -> s + v)"
    curve = F.expr("b0 + b1 * __t + " + dot.format("deltas", "changes", "a * greatest(__t - b, 0.0D)") + " + "
                   + dot.format("season", "__s", "a * b"))
    scale = F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0))
    return x.select("date", *k, clamp_non_negative(curve * scale).alias(out_col))
