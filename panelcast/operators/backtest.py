"""Rolling-origin backtests.

The fold table has one row per fold; features, baselines and boosted models of
all folds are built at once by joining the fold table to the daily sums (fold
id becomes part of every key).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig, KEYS
from panelcast.functions.calendar import calendar_columns, CALENDAR_COLUMNS
from panelcast.functions.scalar import clamp_non_negative

FOLD_DATE_COLUMNS = ("train_start", "train_end", "test_start", "test_end",
                     "prediction_start", "prediction_end")


def _fold_dates(ends: DataFrame, train_start: dt.date) -> DataFrame:
    return (ends.withColumn("prediction_start", F.date_add(F.add_months("prediction_end", -1), 1))
                .withColumn("test_start", F.date_add(F.add_months("prediction_end", -2), 1))
                .withColumn("test_end", F.date_sub("prediction_start", 1))
                .withColumn("train_end", F.date_sub("test_start", 1))
                .withColumn("train_start", F.lit(train_start).cast("date"))
                .select(F.col("prediction_end").alias("prediction_period"), *FOLD_DATE_COLUMNS))


def backtest_folds(spark: SparkSession, first_end: dt.date, last_end: dt.date,
                   train_start: dt.date) -> DataFrame:
    """One row per month end in [first_end, last_end]; derived dates use
    month arithmetic that clips to the month end (Feb 28 - 1 month = Jan 28)."""
    base = spark.range(1).select(
        F.explode(F.sequence(F.trunc(F.lit(first_end).cast("date"), "month"),
                             F.trunc(F.lit(last_end).cast("date"), "month"),
                             F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return _fold_dates(base.select(F.last_day("m").alias("prediction_end")), train_start)


def sales_folds(sales: DataFrame, first_end: dt.date, last_end: dt.date, train_start: dt.date) -> DataFrame:
    """O51 from the fact table: a fold for each month up to ``last_end`` that has
    sales, from the month of ``first_end`` on. The dates are combined map-side."""
    start = first_end.replace(day=1)
    ends = (sales.where(F.col("date").between(F.lit(start).cast("date"), F.lit(last_end).cast("date")))
                 .select(F.last_day("date").alias("prediction_end")).distinct())
    return _fold_dates(ends, train_start)


def validate_folds(folds: DataFrame) -> DataFrame:
    """Folds that break the date order or the gap rule."""
    c = F.col
    ok = ((c("prediction_end") >= c("prediction_start")) & (c("prediction_start") > c("test_end"))
          & (c("test_end") >= c("test_start")) & (c("test_start") > c("train_end"))
          & (c("train_end") >= c("train_start"))
          & (F.datediff(c("prediction_start"), c("test_end")) >= 1))
    return folds.where(~F.coalesce(ok, F.lit(False)))


def fold_configs(folds_rows, base: ForecastConfig) -> list[tuple[dt.date, ForecastConfig]]:
    """Driver-side fold parameters (a handful of rows) for the per-fold GBT fits."""
    return [(r["prediction_period"], base.with_dates(
        train_start=r["train_start"], train_end=r["train_end"], test_start=r["test_start"],
        test_end=r["test_end"], prediction_start=r["prediction_start"],
        prediction_end=r["prediction_end"])) for r in folds_rows]


def fold_panels(sums: DataFrame, folds: DataFrame, target: str = "sales", keys=KEYS) -> DataFrame:
    """The panel of every fold in one frame, keyed by prediction_period.

    `sums` = daily sums (date, K, target) over all folds' ranges. History rows
    are range joins of the fold table (a handful of rows, broadcast) with the
    sums; the prediction spine is generated per (fold, group)."""
    k = list(keys)
    f = F.broadcast(folds)
    hist = sums.join(f, (sums.date >= f.train_start) & (sums.date <= f.test_end)
                     & ~((sums.date > f.train_end) & (sums.date < f.test_start)))
    hist = hist.select("prediction_period", "date", *k, target)
    groups = sums.join(f, sums.date.between(f.test_start, f.test_end)) \
                 .select("prediction_period", *k, "prediction_start", "prediction_end").distinct()
    spine = groups.select("prediction_period", *k, F.explode(
        F.sequence("prediction_start", "prediction_end", F.expr("INTERVAL 1 DAY"))).alias("date"))
    pred = spine.join(sums, ["date", *k], "left")
    fk = ["prediction_period", *k]
    from pyspark.sql import Window
    mx = F.max(target).over(Window.partitionBy(*fk))
    flag = pred.groupBy("prediction_period").agg((F.count(target) > 0).alias("__has"))
    pred = pred.withColumn("__max", mx).join(F.broadcast(flag), "prediction_period")
    pred = pred.where(~F.col("__has") | (F.col("__max") >= 0)) \
               .withColumn(target, F.when(F.col("__has"), F.coalesce(F.col(target), F.lit(0.0)))
                           .otherwise(F.col(target)).cast("double")) \
               .select("prediction_period", "date", *k, target)
    panel = hist.unionByName(pred)
    return calendar_columns(panel).select("prediction_period", "date", *k, *CALENDAR_COLUMNS, target)


def backtest_baselines(panels: DataFrame, folds: DataFrame, target: str = "sales", keys=KEYS) -> DataFrame:
    """O52 without the boosted model: seasonal average and linear trend for
    every fold at once; fold id is part of every grouping key."""
    from panelcast.operators.baselines import seasonal_average_baseline, linear_trend_forecast
    k = list(keys)
    fk = ["prediction_period", *k]
    f = F.broadcast(folds.select("prediction_period", "train_start", "test_end",
                                 "prediction_start", "prediction_end"))
    p = panels.join(f, "prediction_period")
    hist = p.where(F.col("date").between(F.col("train_start"), F.col("test_end")))
    pred = p.where(F.col("date").between(F.col("prediction_start"), F.col("prediction_end")))
    sa = seasonal_average_baseline(hist, pred, target, fk)
    tr = linear_trend_forecast(hist, pred, "train_start", target, fk)
    actual = pred.select(*fk, "date", target)
    return (actual.join(sa, [*fk, "date"], "inner").join(tr, [*fk, "date"], "inner")
                  .select("date", *k, target, "predicted_seasonal_average", "predicted_fbprophet",
                          "prediction_period"))
