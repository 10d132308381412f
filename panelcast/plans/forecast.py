"""End-to-end plans: E1 forecast run (O50), baseline report (entry)."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig, FIXTURE_CONFIG
from panelcast.operators import backtest as BT
from panelcast.operators import panel as P
from panelcast.operators import features as FE
from panelcast.operators import baselines as BL
from panelcast.operators import metrics as M
from panelcast.operators import models as MD
from panelcast.operators import prep as PR
from panelcast.operators.recursive import recursive_forecast, recursive_states
from panelcast.sources.tables import joined_sales
from panelcast.sources.sinks import write_predictions
from panelcast.session import cut_lineage


@dataclass
class ForecastResult:
    panel: DataFrame
    matrix: DataFrame
    model: object
    feature_cols: list
    lgb: DataFrame
    baseline: DataFrame
    merged: DataFrame
    datasets: object = None


def run_forecast(data: DataFrame, cfg: ForecastConfig, output_path: str | None = None,
                 check: bool = True) -> ForecastResult:
    """Features -> trend feature -> datasets -> GBT -> recursive forecast
    -> baselines -> blend -> optional write. `data` is the star-joined sales."""
    cfg.validate()
    data = P.prepare_data(data, cfg)
    # the only reads of the fact rows; panel and monthly features start from these
    facts = cut_lineage(FE.fact_aggregates(data, cfg))
    panel = cut_lineage(P.build_panel(data, cfg, FE.daily_from(facts, cfg)))
    # The feature table is panel-sized and read by every later stage: write it
    # to the checkpoint folder so later plans start from it, not from the scan.
    matrix = cut_lineage(FE.build_feature_matrix(data, panel, cfg, facts))
    # The trend feature only matters when the model uses it (reference quirk
    # Q10: it is computed but left out of the model's columns).
    fb = BL.trend_forecast(panel, panel, cfg, cfg.train_start, cfg.train_end, out_col="fb_feature") \
        if cfg.use_trend_feature else None
    md = MD.create_datasets(matrix, cfg, fb)
    groups = P.distinct_groups(md.predict, cfg.keys)
    if cfg.gbt_engine == "mllib":
        model = MD.train_gbt(md, cfg)
        lgb = recursive_forecast(model, md.predict, panel, md.feature_cols, cfg)
    else:
        model = MD.train_boosted(md, cfg)
        lgb = recursive_states(model, md.predict, panel, md.feature_cols, cfg)
    actual = md.predict.select("date", *cfg.keys, cfg.target)
    # groups x horizon rows each: materialise once, so the completeness checks
    # and the blend do not run the recursion / baselines a second time
    lgb = cut_lineage(lgb.join(actual, ["date", *cfg.keys], "left")
                         .select("date", *cfg.keys, cfg.target, "predicted"))
    if check:
        P.assert_complete(lgb, cfg.horizon, "recursive predictions", groups, cfg.keys)
    base = cut_lineage(BL.baseline_models(panel, cfg))
    if check:
        P.assert_complete(base, cfg.horizon, "baseline predictions", groups, cfg.keys)
    merged = cut_lineage(MD.combine_results(lgb, base, cfg.keys))
    if check:
        P.assert_complete(merged, cfg.horizon, "blended predictions", groups, cfg.keys)
    if output_path:
        write_predictions(merged, output_path)
    return ForecastResult(panel, matrix, model, md.feature_cols, lgb, base, merged, md)


def forecast_tables(spark: SparkSession, sf_dir: str, cfg: ForecastConfig = FIXTURE_CONFIG,
                    output_path: str | None = None) -> ForecastResult:
    return run_forecast(joined_sales(spark, sf_dir, cfg.train_start, cfg.prediction_end), cfg, output_path)


def forecast_from_csv(spark: SparkSession, sales_path: str, taxonomy_path: str, stores_path: str, cfg: ForecastConfig,
                      output_path: str | None = None, narrow: bool = True) -> tuple[ForecastResult, DataFrame]:
    """E1 from the three CSV inputs: typed reads, narrowing (O02), star join,
    forecast run. Returns the run and the rejected lines (input, file, record)."""
    from panelcast.sources.files import SCHEMAS, ingest_csv
    got = {name: ingest_csv(spark, path, SCHEMAS[name], narrow)
           for name, path in (("sales", sales_path), ("taxonomy", taxonomy_path), ("stores", stores_path))}
    data = P.star_join(*(got[name].rows for name in ("sales", "taxonomy", "stores")))
    rejected = P.concat_frames(*(g.rejected.select(F.lit(name).alias("input"), "file", "record") for name, g in got.items()))
    return run_forecast(P.filter_date_range(data, cfg.train_start, cfg.prediction_end), cfg, output_path), rejected


def baseline_report(spark: SparkSession, sf_dir: str, cfg: ForecastConfig = FIXTURE_CONFIG) -> DataFrame:
    """Seasonal-average and trend forecasts for the prediction window, scored
    against the (zero-filled) actuals: MAPE per group and model."""
    data = P.prepare_data(joined_sales(spark, sf_dir, cfg.train_start, cfg.prediction_end), cfg)
    panel = P.build_panel(data, cfg)
    base = BL.baseline_models(panel, cfg)
    actual = P.filter_date_range(panel, cfg.prediction_start, cfg.prediction_end) \
        .select("date", *cfg.keys, cfg.target)
    res = actual.join(base, ["date", *cfg.keys], "inner")
    models = {"seasonal_average": "predicted_seasonal_average", "fbprophet": "predicted_fbprophet"}
    return M.mape_by_group(res, models, cfg.target, cfg.keys)


def boosted_backtest(data: DataFrame, folds: DataFrame, base: ForecastConfig) -> DataFrame:
    """O52 with all three models: every fold of the fold table at once.

    ``data`` is the star-joined sales with calendar columns. One feature table
    carries the fold in every key (each fold's own panel, zero-filled window
    included); encoders, boosted models and the recursion then work on all
    folds in the same jobs. Monthly statistics are shared: a month's features
    come from the month before, which every fold that uses them has seen.
    Returns (date, K, target, three forecasts, prediction_period).
    """
    fold, k = "prediction_period", list(base.keys)
    cfg = replace(base, keys=(fold, *k))
    f = F.broadcast(folds)                              # one row per fold
    whole = base.with_dates(test_end=folds.agg(F.max("test_end")).first()[0])
    facts = cut_lineage(FE.fact_aggregates(data, whole))        # the only read of the fact rows
    panels = cut_lineage(BT.fold_panels(FE.daily_from(facts, whole), folds, base.target, k))
    matrix = FE.assemble_features(FE.panel_features(panels, cfg), FE.wide_shares(FE.shares_from(facts, whole), k),
                                  FE.product_features_from(facts, whole), k)
    matrix = cut_lineage(matrix.join(f, fold))
    in_range = {n: F.col("date").between(F.col(f"{n}_start"), F.col(f"{n}_end")) for n in ("train", "test", "prediction")}
    drop = [c for c in folds.columns if c != fold]
    train = matrix.where(in_range["train"]).withColumn(
        "weight", PR.sample_weight(base.weight_cutoff_year, F.month("prediction_start"))).drop(*drop)
    rest = matrix.where(in_range["test"] | in_range["prediction"]).withColumn("__test", in_range["test"]).drop(*drop)
    cols = PR.train_columns([c for c in matrix.columns if c not in folds.columns], base.except_cols)
    cat = PR.string_columns(train, cols)
    train, others, encoder = PR.target_encode_oof(train, {"rest": rest}, cat, base.target, base.n_folds, cfg.keys, by=[fold])
    cols = [c + "_tenc" if c in cat else c for c in cols]
    rest = cut_lineage(others["rest"])
    test, pred = (rest.where(c).drop("__test") for c in ("__test", "not __test"))
    model = MD.train_boosted(MD.ModelData(cut_lineage(train), test, pred, cols, encoder), cfg, fit_col=fold)
    lgb = recursive_states(model, pred, panels, cols, cfg, fit_col=fold)
    res = cut_lineage(MD.combine_results(lgb, BT.backtest_baselines(panels, folds, base.target, k), cfg.keys))
    if res.count() != pred.count():
        raise RuntimeError("backtest: forecasts and prediction windows differ in their rows")
    return res.select("date", *k, base.target, *M.MODEL_COLUMNS.values(), fold)


def rolling_backtest(data: DataFrame, first_end, last_end, base: ForecastConfig,
                     results_path: str | None = None) -> DataFrame:
    """E2 / O52 with the boosted model: a forecast for every month end in
    [first_end, last_end], tagged with `prediction_period`, optionally appended
    to a results table (O06). Histogram trees take all folds at once; with
    MLlib trees the folds (a handful of rows, read by the driver) run one
    after another."""
    from panelcast.sources.sinks import append_results
    spark = data.sparkSession
    folds = BT.backtest_folds(spark, first_end, last_end, base.train_start)
    bad = BT.validate_folds(folds).count()
    if bad:
        raise ValueError(f"{bad} backtest folds violate the date order")
    if base.gbt_engine == "mllib":
        out = None
        for period, cfg in BT.fold_configs(folds.orderBy("prediction_period").collect(), base):
            r = run_forecast(P.filter_date_range(data, cfg.train_start, cfg.prediction_end), cfg)
            part = cut_lineage(r.merged.withColumn("prediction_period", F.lit(period).cast("date")))
            out = part if out is None else out.unionByName(part)
    else:
        whole = base.with_dates(prediction_end=last_end)
        out = boosted_backtest(P.prepare_data(data, whole), folds, base)
    if results_path:
        append_results(out, results_path)
    return out


def score_results(results: DataFrame, cfg: ForecastConfig = FIXTURE_CONFIG) -> dict:
    """Day-share filter, APE columns for the three models, then the
    report tables (by period, by group rounded, MAPE by group, totals)."""
    models = M.MODEL_COLUMNS
    filt = M.day_share_weight(results, cfg.target)
    scored = M.ape_columns(M.ape_columns(filt, models, cfg.target), models, cfg.target, weighted=True)
    cols = [f"mape_{n}" for n in models]
    return {
        "by_period": M.score_by(scored, ["prediction_period"], cols),
        "by_group": M.score_by(scored, list(cfg.keys), cols, round_to=1),
        "mape_by_group": M.mape_by_group(filt, models, cfg.target, cfg.keys),
        "totals": M.column_totals(results, [cfg.target, *models.values()]),
    }
