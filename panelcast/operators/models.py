"""Boosted-tree model (O41), feature ranking (O43), result combination (O13,
O49) and dataset preparation for the model.

``gbt_engine`` chooses between the histogram trees of ``operators.boosting``
(leaf-wise, L1/L2, patience on the asymmetric error, own side for missing
values) and MLlib's GBTRegressor (depth-wise, 128 bins, min 50 rows per leaf,
stops at the first rise of the validation error). MLlib rejects NaN features
at fit time, so there missing values get a sentinel (-1, below every real
feature value of this panel: counts, sums, shares, prices and sizes are >= 0;
cyclic columns are never missing).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig
from panelcast.functions.scalar import clamp_non_negative, log_transform
from panelcast.operators import panel as P
from panelcast.operators import prep as PR
from panelcast.operators.boosting import BoostedTrees, BoostParams, fit_boosted, name_of
from panelcast.session import cut_lineage

MISSING = -1.0


@dataclass
class ModelData:
    train: DataFrame
    test: DataFrame
    predict: DataFrame
    feature_cols: list[str]
    encoder: DataFrame | None


def create_datasets(matrix: DataFrame, cfg: ForecastConfig, fb: DataFrame | None = None) -> ModelData:
    """Split, weight, target-encode. Train columns are fixed before the trend
    feature is attached (it only enters the model with use_trend_feature)."""
    cols = PR.train_columns(matrix.columns, cfg.except_cols)
    if fb is not None:
        matrix = matrix.join(fb.select("date", *cfg.keys, "fb_feature"), ["date", *cfg.keys], "left")
        if cfg.use_trend_feature:
            cols = cols + ["fb_feature"]
    train = P.filter_date_range(matrix, cfg.train_start, cfg.train_end) \
        .withColumn("weight", PR.sample_weight(cfg.weight_cutoff_year, cfg.prediction_month))
    test = P.filter_date_range(matrix, cfg.test_start, cfg.test_end)
    pred = P.filter_date_range(matrix, cfg.prediction_start, cfg.prediction_end)
    if cfg.target not in pred.columns:
        pred = pred.withColumn(cfg.target, F.lit(0.0))
    cat = PR.string_columns(train, cols)
    enc = None
    if cat:
        # one frame for both: they are encoded alike
        rest = P.filter_date_range(matrix, cfg.test_start, cfg.prediction_end)
        if cfg.target not in rest.columns:
            rest = rest.withColumn(cfg.target, F.lit(0.0))
        train, others, enc = PR.target_encode_oof(train, {"rest": rest}, cat, cfg.target, cfg.n_folds, cfg.keys)
        train, rest = cut_lineage(train), cut_lineage(others["rest"])
        test = P.filter_date_range(rest, cfg.test_start, cfg.test_end)
        pred = P.filter_date_range(rest, cfg.prediction_start, cfg.prediction_end)
        cols = [c + "_tenc" if c in cat else c for c in cols]
    return ModelData(train, test, pred, cols, enc)


def feature_vector(feature_cols):
    """One projection: array of doubles (sentinel for missing) -> ML vector.
    Written as one SQL expression: a single parse on the JVM instead of a
    hundred Python-built column objects (and far cheaper than a
    VectorAssembler over a hundred input columns)."""
    items = ", ".join(f"coalesce(cast({name_of(c)} AS DOUBLE), {MISSING!r}D)" for c in feature_cols)
    return array_to_vector(F.expr(f"array({items})"))


def with_features(df: DataFrame, feature_cols) -> DataFrame:
    return df.withColumn("features", feature_vector(feature_cols))


def boost_params(cfg: ForecastConfig) -> BoostParams:
    return BoostParams(rounds=cfg.gbt_max_iter, rate=cfg.gbt_step_size, patience=cfg.gbt_patience, depth=cfg.gbt_max_depth,
                       leaves=cfg.gbt_leaves, bins=cfg.gbt_max_bins, min_rows=cfg.gbt_min_instances, l1=cfg.gbt_l1, l2=cfg.gbt_l2)


def train_boosted(md: ModelData, cfg: ForecastConfig, fit_col: str | None = None) -> BoostedTrees:
    """Histogram trees on log1p(target), weighted; the test split decides when to stop."""
    keep = [name_of(c) for c in dict.fromkeys([cfg.target, "weight", "__val", *([fit_col] if fit_col else []), *md.feature_cols])]
    both = md.train.withColumn("__val", F.lit(False)).select(*keep).unionByName(
        md.test.withColumns({"__val": F.lit(True), "weight": F.lit(1.0)}).select(*keep))
    return fit_boosted(both, md.feature_cols, cfg.target, "weight", "__val", boost_params(cfg), fit_col)


def train_gbt(md: ModelData, cfg: ForecastConfig) -> GBTRegressionModel:
    """O41 with MLlib: fit on log1p(target), weighted, validated on the test split."""
    t = cfg.target
    tr = md.train.withColumn("__val", F.lit(False))
    te = md.test.withColumn("__val", F.lit(True)).withColumn("weight", F.lit(1.0))
    cols = [name_of(c) for c in ["date", *cfg.keys, t, "weight", "__val", *md.feature_cols]]
    both = tr.select(*cols).unionByName(te.select(*cols)).where(F.col(t).isNotNull())
    both = with_features(both, md.feature_cols).withColumn("label", log_transform(t))
    # MLlib reads its input several times (split sampling, binning, validation):
    # start it from a checkpoint, not from the encoding joins.
    both = cut_lineage(both.select("features", "label", "weight", "__val"))
    gbt = GBTRegressor(featuresCol="features", labelCol="label", weightCol="weight",
                       validationIndicatorCol="__val", maxIter=cfg.gbt_max_iter, stepSize=cfg.gbt_step_size,
                       maxDepth=cfg.gbt_max_depth, maxBins=cfg.gbt_max_bins,
                       minInstancesPerNode=cfg.gbt_min_instances, validationTol=cfg.gbt_validation_tol,
                       seed=cfg.seed)
    return gbt.fit(both)


def feature_importance(model: GBTRegressionModel, feature_cols, top: int = 25):
    """Ranked importances (top 25) as a small DataFrame; the list has one
    entry per feature column, so it is bounded by the schema, not the data."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    rows = sorted(zip(feature_cols, imp), key=lambda x: (-x[1], x[0]))[:top]
    return spark.createDataFrame([(i + 1, c, float(v)) for i, (c, v) in enumerate(rows)],
                                 "rank int, feature string, importance double")


def combine_results(lgb: DataFrame, baseline: DataFrame, keys) -> DataFrame:
    """O13 + O49: inner join on (date, K); lgb_predicted = 0.5 GBT + 0.5 trend."""
    r = lgb.withColumnRenamed("predicted", "lgb_predicted").join(baseline, ["date", *keys], "inner")
    return r.withColumn("lgb_predicted", 0.5 * F.col("lgb_predicted") + 0.5 * F.col("predicted_fbprophet"))


def back_transform(col: str = "predicted"):
    return clamp_non_negative(log_transform(col, "back"))
