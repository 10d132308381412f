"""Scoring: MAPE, day-share weights, APE columns and report tables.

O42, O53-O59. All are aggregates or per-row expressions; the per-date total
of O54 is a grouped aggregate joined back (dates are few), not a window over
all rows of a date, so a busy day is combined map-side first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.config import KEYS
from panelcast.functions.scalar import abs_pct_error, asymmetric_sq_error

# Model columns of the reference's results and their report labels.
MODEL_COLUMNS = {
    "lgb": "lgb_predicted",
    "fbprophet": "predicted_fbprophet",
    "seasonal_average": "predicted_seasonal_average",
}


def mape(df: DataFrame, actual: str, pred: str, by=None, alias: str = "mape") -> DataFrame:
    """mean(|(a - p) / (a + 1)|) * 100, optionally per group."""
    e = (F.avg(abs_pct_error(actual, pred, divide_first=True)) * 100).alias(alias)
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def asymmetric_mse(df: DataFrame, actual: str, pred: str, by=None, alias: str = "asymmetric_mse") -> DataFrame:
    """Mean squared error, x1.1 when under-predicting, x0.9 otherwise."""
    e = F.avg(asymmetric_sq_error(actual, pred)).alias(alias)
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def day_share_weight(results: DataFrame, target: str = "sales", date_col: str = "date",
                     min_share: float | None = 0.01) -> DataFrame:
    """weight = target / (total of the date + 1); keep weight > min_share."""
    tot = results.groupBy(date_col).agg(F.sum(target).alias("__day_total"))
    out = results.join(tot, date_col, "left") \
                 .withColumn("weight", F.try_divide(F.col(target), F.col("__day_total") + 1)) \
                 .drop("__day_total")
    return out.where(F.col("weight") > min_share) if min_share is not None else out


def ape_columns(results: DataFrame, models=None, target: str = "sales",
                weighted: bool = False) -> DataFrame:
    """100 * |p - a| / (a + 1) per model (times weight when weighted)."""
    models = models or MODEL_COLUMNS
    new = {}
    for name, col in models.items():
        e = F.lit(100.0) * abs_pct_error(target, col, divide_first=False)
        if weighted:
            new[f"weighted_mape_{name}"] = F.col("weight") * e
        else:
            new[f"mape_{name}"] = e
    return results.withColumns(new)


def score_by(results: DataFrame, by, score_cols, round_to: int | None = None) -> DataFrame:
    """O56 (by prediction_period) / O57 (by group, rounded like pandas
    round(n): half-even on the scaled double, rint(x * 10^n) / 10^n)."""
    aggs = []
    for c in score_cols:
        a = F.avg(c)
        if round_to is not None:
            s = float(10 ** round_to)
            a = F.rint(a * F.lit(s)) / F.lit(s)
        aggs.append(a.alias(c))
    return results.groupBy(*by).agg(*aggs)


def mape_by_group(results: DataFrame, models=None, target: str = "sales", keys=KEYS) -> DataFrame:
    """MAPE per group for each model."""
    models = models or MODEL_COLUMNS
    return results.groupBy(*keys).agg(
        *[(F.avg(abs_pct_error(target, c, divide_first=True)) * 100).alias(f"mape_{n}")
          for n, c in models.items()])


def column_totals(results: DataFrame, columns) -> DataFrame:
    """O59."""
    return results.agg(*[F.sum(c).alias(f"total_{c}") for c in columns])
