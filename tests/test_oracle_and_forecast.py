"""Registry checks on the smallest supplied tables: Spark vs the DuckDB oracle,
and end-to-end forecast invariants."""

import datetime as dt
import hashlib
import os
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF0001

TABLES = ["region", "nation", "supplier", "part", "lineitem"]
# cheap, representative subset; scripts/oracle_check.py runs all of them
CHECK = ["o07_star_join", "o20_daily_panel", "o10_zero_fill", "o26_gap_aware_lag", "o27_rolling_totals",
         "o22b_prior_year_week", "o28_period_to_date", "o24_categorical_features", "o21_product_features",
         "o33_cyclic_encoding", "o40_target_encode_oof", "o47_seasonal_average", "o46a_linear_trend",
         "o44_advance_state", "o52_backtest_baselines", "o57_score_by_group", "o02_narrow_schema",
         "o19_check_completeness", "o13_combine_results", "o06_results_roundtrip", "o03_column_profile"]


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: None if v is None else (repr(float(v)) if isinstance(v, float) else str(v)[:10]
                                             if isinstance(v, dt.date) else str(v))
    lines = sorted("|".join(str(norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHECK)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_every_sql_operator_has_an_oracle():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60 and len(o) >= 45


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["hierarchy1_id", "storetype_id", "mape_seasonal_average", "mape_fbprophet"]
    assert df.count() > 0


def _small_model(spark, cfg):
    from pyspark.ml.regression import GBTRegressor
    from panelcast.operators import panel as P, features as FE, models as MD
    from panelcast.session import cut_lineage
    from panelcast.sources.tables import joined_sales
    data = P.prepare_data(joined_sales(spark, SF0001, cfg.train_start, cfg.prediction_end), cfg)
    panel = P.build_panel(data, cfg).persist()
    matrix = cut_lineage(FE.build_feature_matrix(data, panel, cfg))
    md = MD.create_datasets(matrix, cfg)
    tr = MD.with_features(md.train, md.feature_cols).withColumn("label", F.log1p("sales"))
    m = GBTRegressor(maxIter=3, maxDepth=3, minInstancesPerNode=20, seed=1).fit(tr)
    return m, md, panel


@pytest.mark.parametrize("engine,compat,mode", [("mllib", False, "positional"), ("histogram", False, "positional"),
                                                ("histogram", True, "positional"), ("histogram", False, "calendar")])
def test_recursive_engines_agree(spark, engine, compat, mode):
    from panelcast.config import FIXTURE_CONFIG
    from panelcast.operators import models as MD
    from panelcast.operators import recursive as R
    from recursion_reference import recursive_forecast_grouped
    cfg = replace(FIXTURE_CONFIG, compat=compat, lag_mode=mode, gbt_max_iter=3, gbt_min_instances=20)
    m, md, panel = _small_model(spark, cfg)
    if engine == "mllib":
        a = R.recursive_forecast(m, md.predict, panel, md.feature_cols, cfg).toPandas()
    else:
        m = MD.train_boosted(md, cfg)
        a = R.recursive_states(m, md.predict, panel, md.feature_cols, cfg).toPandas()
    b = recursive_forecast_grouped(m, md.predict, panel, md.feature_cols, cfg).toPandas()
    groups = md.predict.select("hierarchy1_id", "storetype_id").distinct().count()
    assert len(a) == len(b) == groups * cfg.horizon
    j = a.merge(b, on=["date", "hierarchy1_id", "storetype_id"])
    assert len(j) == len(a)
    assert (j.predicted_x - j.predicted_y).abs().max() < 1e-9
    assert (a.predicted >= 0).all()


def test_forecast_run_blend_is_mean(spark, tmp_path):
    from panelcast.config import FIXTURE_CONFIG
    from panelcast.plans.forecast import forecast_tables
    cfg = replace(FIXTURE_CONFIG, gbt_max_iter=3)       # histogram trees
    r = forecast_tables(spark, SF0001, cfg, output_path=str(tmp_path / "out"))
    merged = r.merged.join(r.lgb.select("date", "hierarchy1_id", "storetype_id",
                                        F.col("predicted").alias("gbt")), ["date", "hierarchy1_id", "storetype_id"])
    bad = merged.where(F.abs(F.col("lgb_predicted") - (0.5 * F.col("gbt") + 0.5 * F.col("predicted_fbprophet")))
                       > 1e-9).count()
    assert bad == 0
    groups = r.lgb.select("hierarchy1_id", "storetype_id").distinct().count()
    assert r.merged.count() == groups * cfg.horizon
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["date", "hierarchy1_id", "storetype_id", "sales", "lgb_predicted"]
    assert back.count() == r.merged.count()


def test_rolling_backtest_with_model(spark, tmp_path):
    from panelcast.config import FIXTURE_CONFIG
    from panelcast.plans.forecast import rolling_backtest, score_results
    from panelcast.sources.tables import joined_sales
    cfg = replace(FIXTURE_CONFIG, gbt_max_iter=2)
    data = joined_sales(spark, SF0001)
    res = rolling_backtest(data, dt.date(2001, 5, 31), dt.date(2001, 6, 30), cfg, str(tmp_path / "res"))
    periods = sorted(r[0] for r in res.select("prediction_period").distinct().collect())
    assert periods == [dt.date(2001, 5, 31), dt.date(2001, 6, 30)]
    per = res.groupBy("prediction_period").agg(F.countDistinct("hierarchy1_id", "storetype_id").alias("g"),
                                               F.count(F.lit(1)).alias("n")).collect()
    for r in per:
        assert r["n"] == r["g"] * 31  # 05-01..05-31 and 05-31..06-30 (month-end clipping)
    sc = score_results(res, cfg)
    assert sc["by_period"].count() == 2
    assert set(sc["by_group"].columns) >= {"mape_lgb", "mape_fbprophet", "mape_seasonal_average"}
    assert spark.read.parquet(str(tmp_path / "res")).count() == res.count()


def test_backtest_of_all_folds_equals_single_runs(spark):
    from panelcast.config import FIXTURE_CONFIG
    from panelcast.plans.forecast import rolling_backtest, run_forecast
    from panelcast.sources.tables import joined_sales
    cfg = replace(FIXTURE_CONFIG, gbt_max_iter=2)
    data = joined_sales(spark, SF0001)
    both = rolling_backtest(data, dt.date(2001, 5, 31), dt.date(2001, 7, 31), cfg).toPandas()
    # prediction window 2001-07-01 .. 07-31 is the last fold's
    one = run_forecast(data, cfg).merged.toPandas()
    on = ["date", "hierarchy1_id", "storetype_id"]
    j = both[both.prediction_period == dt.date(2001, 7, 31)].merge(one, on=on, suffixes=("", "_one"))
    assert len(j) == len(one) > 0
    for c in ("sales", "lgb_predicted", "predicted_seasonal_average", "predicted_fbprophet"):
        assert (j[c] - j[c + "_one"]).abs().max() < 1e-9
