"""Registry of checkable queries: one Spark callable and (where SQL can say
it) one independent DuckDB statement per operator of the inventory.

Every query reads the whole supplied tables. Double columns are rounded to
4 decimals on both sides so that summation order cannot flip a hash.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.config import FIXTURE_CONFIG as C, KEYS, SHARE_FEATURES
from panelcast.functions import calendar as CAL
from panelcast.functions.scalar import clamp_non_negative, log_transform
from panelcast.operators import panel as P
from panelcast.operators import features as FE
from panelcast.operators import baselines as BL
from panelcast.operators import metrics as M
from panelcast.operators import backtest as BT
from panelcast.plans import oracle as O
from panelcast.plans.context import context
from panelcast.session import cut_lineage
from panelcast.sources.tables import sales_df

DIGITS = 4
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
K = list(KEYS)


SCALE = float(10 ** DIGITS)
# Not one half: means of prices in cents often lie exactly between two rounded
# values, where the last bit of a sum would decide. Hardly any value lies here.
HALF = 0.50137


def rounded(df: DataFrame, cols) -> DataFrame:
    """floor(x * 1e4 + HALF) / 1e4: the same IEEE steps as the SQL side, so
    equal inputs give equal outputs (engine ROUND functions break ties
    differently). Applied only to results whose low bits depend on
    summation order or on the math library (regressions, sin/cos, logs)."""
    def r(c):
        x = F.col(f"`{c}`")
        return F.when(F.isnan(x) | (F.abs(x) == float("inf")), x) \
                .otherwise(F.floor(x * F.lit(SCALE) + F.lit(HALF)).cast("double") / F.lit(SCALE))
    ex = {c: r(c) for c in cols}
    return df.withColumns(ex) if ex else df


class OracleSQL(str):
    """SQL text that remembers which columns it rounds (Spark rounds the same)."""
    round_cols: tuple = ()


def sql(ctes: str, select: str, doubles=()) -> str:
    """WITH <ctes>, result AS (<select>) SELECT * REPLACE (rounded doubles) FROM result."""
    rep = ""
    if doubles:
        rep = " REPLACE (" + ", ".join(
            f"CASE WHEN isnan({c}) OR isinf({c}) THEN {c} ELSE FLOOR({c} * {SCALE!r} + {HALF!r}) / {SCALE!r} END AS {c}"
            for c in doubles) + ")"
    out = OracleSQL(f"WITH {ctes.strip().rstrip(',')},\nresult AS ({select})\nSELECT *{rep} FROM result")
    out.round_cols = tuple(c.strip('"') for c in doubles)
    return out


def register(name: str, oracle: str | None = None, round_cols=()):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir), round_cols or getattr(oracle, "round_cols", ()))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, oracle)
        return run
    return deco


def ctx(spark, sf_dir):
    return context(spark, sf_dir)


B = O.base()
FEATS = B + "," + O.features_ctes()
LAG_NAMES = [f"total_sales_last_{n}_days" for n in C.lags]
PRED_RANGE = f"date BETWEEN {O.d(C.prediction_start)} AND {O.d(C.prediction_end)}"
HIST_RANGE = f"date BETWEEN {O.d(C.train_start)} AND {O.d(C.test_end)}"
TRAIN_RANGE = f"date BETWEEN {O.d(C.train_start)} AND {O.d(C.train_end)}"


# ---------------------------------------------------------------- sources / joins
@register("o01_scan_sales", sql(B, "SELECT * FROM sales", ["sales", "price"]))
def q_scan(spark, sf):
    """The sales fact scanned with a fixed schema."""
    return sales_df(spark, sf)


@register("o01_ingest_csv", sql(B, """SELECT 'sales' AS input, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_rejected, SUM(sales) AS total FROM sales
    UNION ALL SELECT 'taxonomy', COUNT(*), 0, SUM(product_length) FROM taxonomy
    UNION ALL SELECT 'stores', COUNT(*), 0, SUM(store_size) FROM stores""", ["total"]))
def q_ingest(spark, sf):
    """The three inputs written as CSV and ingested again: typed, narrowed, bad rows counted."""
    from panelcast.sources.files import SCHEMAS, ingest_csv
    parts = []
    for (t, df), c in zip(_inputs(spark, sf).items(), ("sales", "product_length", "store_size")):
        path = _scratch(spark, f"csv-{t}")
        df.write.option("header", True).csv(path)
        got = ingest_csv(spark, path, SCHEMAS[t])
        bad = got.rejected.agg(F.count(F.lit(1)).alias("n_rejected"))
        parts.append(got.rows.agg(F.lit(t).alias("input"), F.count(F.lit(1)).alias("n_rows"), F.sum(c).alias("total"))
                     .crossJoin(F.broadcast(bad)).select("input", "n_rows", "n_rejected", "total"))     # one row each
    return P.concat_frames(*parts)


@register("o07_star_join", sql(B, "SELECT * FROM joined",
                               ["sales", "price", "product_length", "product_depth", "product_width", "store_size"]))
def q_star(spark, sf):
    return ctx(spark, sf).joined


@register("o14_filter_date_range", sql(B, f"""SELECT date, {O.K}, product_id, store_id, sales FROM joined
  WHERE date BETWEEN {O.d(C.test_start)} AND {O.d(C.test_end)}""", ["sales"]))
def q_filter(spark, sf):
    j = ctx(spark, sf).joined
    return P.filter_date_range(j, C.test_start, C.test_end).select("date", *K, "product_id", "store_id", "sales")


@register("o08_date_spine", sql(B, "SELECT * FROM spine"))
def q_spine(spark, sf):
    c = ctx(spark, sf)
    test = P.daily_sums(c.data, C.test_start, C.test_end)
    return P.date_spine(P.distinct_groups(test), C.prediction_start, C.prediction_end).select("date", *K)


@register("o09_attach_actuals", sql(B, "SELECT * FROM actuals", ["sales"]))
def q_actuals(spark, sf):
    c = ctx(spark, sf)
    test = P.daily_sums(c.data, C.test_start, C.test_end)
    spine = P.date_spine(P.distinct_groups(test), C.prediction_start, C.prediction_end)
    act = P.daily_sums(c.data, C.prediction_start, C.prediction_end)
    return P.attach_actuals(spine, act).select("date", *K, "sales")


@register("o10_zero_fill", sql(B, "SELECT * FROM pred", ["sales"]))
def q_zero_fill(spark, sf):
    c = ctx(spark, sf)
    test = P.daily_sums(c.data, C.test_start, C.test_end)
    return P.prediction_frame(c.data, test, C).select("date", *K, "sales")


@register("o17_distinct_groups", sql(B, "SELECT * FROM grp"))
def q_groups(spark, sf):
    return P.distinct_groups(P.daily_sums(ctx(spark, sf).data, C.test_start, C.test_end))


@register("o20_daily_panel", sql(B, "SELECT * FROM panel", ["sales"]))
def q_panel(spark, sf):
    return ctx(spark, sf).panel


@register("o15_split_label", sql(B, f"""SELECT date, {O.K}, CASE
    WHEN date BETWEEN {O.d(C.train_start)} AND {O.d(C.train_end)} THEN 'train'
    WHEN date BETWEEN {O.d(C.test_start)} AND {O.d(C.test_end)} THEN 'test'
    WHEN {PRED_RANGE} THEN 'predict' END AS split FROM panel"""))
def q_split(spark, sf):
    return ctx(spark, sf).panel.select("date", *K, P.split_label(C).alias("split"))


@register("o37_concat_panel", sql(B, f"""SELECT split, COUNT(*) AS n_rows, COUNT(DISTINCT ({O.K})) AS n_groups,
    SUM(sales) AS total_sales FROM (SELECT *, CASE
    WHEN date BETWEEN {O.d(C.train_start)} AND {O.d(C.train_end)} THEN 'train'
    WHEN date BETWEEN {O.d(C.test_start)} AND {O.d(C.test_end)} THEN 'test'
    ELSE 'predict' END AS split FROM panel) GROUP BY split""", ["total_sales"]))
def q_concat(spark, sf):
    """The three parts of the unioned panel, summarised per part."""
    p = ctx(spark, sf).panel.withColumn("split", P.split_label(C))
    return p.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.count_distinct(*K).alias("n_groups"),
                                  F.sum("sales").alias("total_sales"))


@register("o19_check_completeness", sql(B, f"""SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, COUNT(n) AS n_groups,
    COUNT(g) AS expected_groups, COUNT(*) - COUNT(n) AS missing_groups, COUNT(g) * {C.horizon} AS expected_rows,
    COALESCE(BOOL_AND(g IS NOT NULL AND n IS NOT DISTINCT FROM {C.horizon}), TRUE) AS complete
    FROM (SELECT {O.K}, COUNT(*) AS n FROM pred GROUP BY {O.K})
    FULL JOIN (SELECT {O.K}, TRUE AS g FROM grp) USING ({O.K})"""))
def q_complete(spark, sf):
    c = ctx(spark, sf)
    pred = P.filter_date_range(c.panel, C.prediction_start, C.prediction_end)
    test = P.filter_date_range(c.panel, C.test_start, C.test_end)
    return P.completeness_report(pred, C.horizon, P.distinct_groups(test))


# ---------------------------------------------------------------- calendar / scalar
@register("o32_calendar_columns", sql(B, f"SELECT DISTINCT date, {O.CAL_COLS} FROM data"))
def q_calendar(spark, sf):
    return ctx(spark, sf).data.select("date", *CAL.CALENDAR_COLUMNS).distinct()


@register("o31_shift_year_month", sql(B, f"SELECT DISTINCT year_month, {O.shift_ym('year_month')} AS next_year_month FROM data"))
def q_shift(spark, sf):
    return ctx(spark, sf).data.select("year_month").distinct() \
        .withColumn("next_year_month", CAL.shift_year_month("year_month"))


@register("o36_parse_date", sql(B, "SELECT DISTINCT year_month, CAST(strptime(year_month || '-01', '%Y-%m-%d') AS DATE) AS month_start FROM data"))
def q_parse(spark, sf):
    return ctx(spark, sf).data.select("year_month").distinct() \
        .withColumn("month_start", CAL.parse_date(F.concat(F.col("year_month"), F.lit("-01"))))


@register("o33_cyclic_encoding", sql(FEATS, f"""SELECT date, {O.K}, weekday_sin, weekday_cos, week_sin, week_cos,
    month_sin, month_cos, quarter_sin, quarter_cos FROM feats""",
    ["weekday_sin", "weekday_cos", "week_sin", "week_cos", "month_sin", "month_cos", "quarter_sin", "quarter_cos"]))
def q_cyclic(spark, sf):
    cyc = CAL.cyclic_encoding(ctx(spark, sf).panel, "auto")
    return cyc.select("date", *K, *[f"{c}_{f}" for c in CAL.CYCLIC_ORDER for f in ("sin", "cos")])


@register("o34_log_transform", sql(B, f"""SELECT date, {O.K}, ln(sales + 1) AS log_sales,
    exp(ln(sales + 1)) - 1 AS back_sales FROM panel WHERE sales IS NOT NULL""", ["log_sales", "back_sales"]))
def q_log(spark, sf):
    p = ctx(spark, sf).panel.where(F.col("sales").isNotNull())
    return p.select("date", *K, log_transform("sales").alias("log_sales"),
                    log_transform(log_transform("sales"), "back").alias("back_sales"))


@register("o35_clamp_non_negative", sql(B, f"""SELECT date, {O.K}, CASE WHEN dev < 0 THEN 0.0 ELSE dev END AS clamped
    FROM (SELECT date, {O.K}, sales - AVG(sales) OVER (PARTITION BY {O.K}) AS dev FROM panel)""", ["clamped"]))
def q_clamp(spark, sf):
    """O35 on the deviation of each day from its group mean."""
    p = ctx(spark, sf).panel
    dev = F.col("sales") - F.avg("sales").over(Window.partitionBy(*K))
    return p.select("date", *K, clamp_non_negative(dev).alias("clamped"))


# ---------------------------------------------------------------- features
@register("o26_gap_aware_lag", sql(B + "," + O.lag_ctes(),
    f"SELECT date, {O.K}, " + ", ".join(f"sales_last_{k}_days" for k in C.lags) + " FROM lagged",
    [f"sales_last_{k}_days" for k in C.lags]))
def q_lag(spark, sf):
    p = ctx(spark, sf).panel
    return p.select("date", *K, *[v.alias(n) for n, v in FE.lag_columns("sales", C.lags).items()])


@register("o27_rolling_totals", sql(B + "," + O.lag_ctes(), f"SELECT date, {O.K}, {', '.join(LAG_NAMES)} FROM totals", LAG_NAMES))
def q_totals(spark, sf):
    return FE.add_lag_features(ctx(spark, sf).panel, "sales", C.lags).select("date", *K, *LAG_NAMES)


for _name, _col in (("o22a_prior_year_month", "avg_same_month_sales"),
                    ("o22b_prior_year_week", "avg_same_week_sales"),
                    ("o22c_prior_year_weekday_week", "avg_same_day_sales")):
    def _mk(col):
        def q(spark, sf):
            p = ctx(spark, sf).panel
            return p.select("date", *K, FE.prior_year_columns("sales")[col].alias(col))
        q.__name__ = f"q_{col}"
        return q
    register(_name, sql(FEATS, f"SELECT date, {O.K}, {_col} FROM withprior", [_col]))(_mk(_col))


@register("o28_period_to_date", sql(FEATS, f"SELECT date, {O.K}, month_sales_to_date, week_sales_to_date FROM todate",
                                    ["month_sales_to_date", "week_sales_to_date"]))
def q_todate(spark, sf):
    p = ctx(spark, sf).panel
    return p.select("date", *K, *[v.alias(n) for n, v in FE.to_date_columns("sales").items()])


@register("o29_relative_progress", sql(FEATS, f"SELECT date, {O.K}, percentage_sold_of_month, percentage_sold_of_week FROM ratios",
                                       ["percentage_sold_of_month", "percentage_sold_of_week"]))
def q_ratio(spark, sf):
    f = ctx(spark, sf).features
    return f.select("date", *K, "percentage_sold_of_month", "percentage_sold_of_week")


@register("o30_first_row_per_group", sql(B, f"""SELECT date, {O.K}, sales FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {O.K} ORDER BY date) AS rn FROM panel WHERE {PRED_RANGE}) WHERE rn = 1""", ["sales"]))
def q_first(spark, sf):
    p = P.filter_date_range(ctx(spark, sf).panel, C.prediction_start, C.prediction_end)
    return FE.first_row_per_group(p).select("date", *K, "sales")


PROD_COLS = ["number_of_products"] + [f"{c}_{s}" for c in ("product_length", "product_depth", "product_width")
                                      for s in ("min", "mean", "max")] + ["number_of_stores"] + \
            [f"{c}_{s}" for c in ("store_size", "price") for s in ("min", "mean", "max")]
PROD_DBL = [c for c in PROD_COLS if not c.startswith("number_")]


@register("o21_product_features", sql(B + "," + O.product_cte(), "SELECT * FROM prod", PROD_DBL))
def q_prod(spark, sf):
    return FE.product_features(ctx(spark, sf).data)


@register("o24_categorical_features", sql(B + "," + O.share_cte(), "SELECT * FROM shares", ["share"]))
def q_shares(spark, sf):
    return FE.share_long(ctx(spark, sf).data, SHARE_FEATURES)


# months whose source rows end at test_end
KNOWN = f"year_month <= '{C.prediction_start:%Y-%m}'"


@register("o24_shares_of_shared_read", sql(B + "," + O.share_cte(), f"SELECT * FROM shares WHERE {KNOWN}", ["share"]))
def q_shares_shared(spark, sf):
    """O24 out of the one fact read that also feeds O20 and O21."""
    return FE.shares_from(ctx(spark, sf).facts, C)


@register("o21_products_of_shared_read", sql(B + "," + O.product_cte(), f"SELECT * FROM prod WHERE {KNOWN}", PROD_DBL))
def q_prod_shared(spark, sf):
    """O21 out of the shared fact read."""
    return FE.product_features_from(ctx(spark, sf).facts, C)


@register("o23_pivot_shares", sql(B, f"""SELECT year_month, {O.K},
    a / NULLIF(a + n + r, 0) AS "A", n / NULLIF(a + n + r, 0) AS "N", r / NULLIF(a + n + r, 0) AS "R"
    FROM (SELECT year_month, {O.K},
            COALESCE(SUM(CASE WHEN promo_type_1 = 'A' THEN sales END), 0.0) AS a,
            COALESCE(SUM(CASE WHEN promo_type_1 = 'N' THEN sales END), 0.0) AS n,
            COALESCE(SUM(CASE WHEN promo_type_1 = 'R' THEN sales END), 0.0) AS r
          FROM data WHERE year_month IS NOT NULL GROUP BY year_month, {O.K})""", ['"A"', '"N"', '"R"']))
def q_pivot(spark, sf):
    """O23 for one column (promo_type_1), not shifted."""
    return FE.pivot_shares(ctx(spark, sf).data, "promo_type_1")


@register("o25_group_aggregates", sql(B, f"""SELECT {O.K}, MAX(sales) AS max_sales, SUM(sales) AS sum_sales,
    AVG(sales) AS mean_sales FROM panel GROUP BY {O.K}""", ["max_sales", "sum_sales", "mean_sales"]))
def q_group_agg(spark, sf):
    return FE.group_aggs(ctx(spark, sf).panel, K, "sales", ("max", "sum", "mean"))


# ---------------------------------------------------------------- baselines
SA_SQL = O.seasonal_ctes(f"(SELECT * FROM panel WHERE {HIST_RANGE})", f"(SELECT * FROM panel WHERE {PRED_RANGE})")
TREND_SQL = O.trend_ctes("tr", HIST_RANGE, C.train_start, f"(SELECT * FROM panel WHERE {PRED_RANGE})")


@register("o47_seasonal_average", sql(B + "," + SA_SQL, "SELECT * FROM sa", ["predicted_seasonal_average"]))
def q_seasonal(spark, sf):
    p = ctx(spark, sf).panel
    return BL.seasonal_average_baseline(P.filter_date_range(p, C.train_start, C.test_end),
                                        P.filter_date_range(p, C.prediction_start, C.prediction_end))


@register("o46a_linear_trend", sql(B + "," + TREND_SQL, "SELECT * FROM tr", ["predicted_fbprophet"]))
def q_trend(spark, sf):
    p = ctx(spark, sf).panel
    return BL.linear_trend_forecast(P.filter_date_range(p, C.train_start, C.test_end),
                                    P.filter_date_range(p, C.prediction_start, C.prediction_end), C.train_start)


@register("o48_baseline_models", sql(B + "," + SA_SQL + "," + TREND_SQL, f"""SELECT sa.date, sa.hierarchy1_id, sa.storetype_id,
    sa.predicted_seasonal_average, tr.predicted_fbprophet FROM sa JOIN tr
    ON sa.date = tr.date AND sa.hierarchy1_id = tr.hierarchy1_id AND sa.storetype_id = tr.storetype_id""",
    ["predicted_seasonal_average", "predicted_fbprophet"]))
def q_baselines(spark, sf):
    return BL.baseline_models(ctx(spark, sf).panel, C)


SUMMARY_SQL = f"""
sm_pr AS (SELECT DISTINCT year, {O.K} FROM panel WHERE {PRED_RANGE}),
sm_y AS (SELECT {O.K}, MAX(year) AS yy FROM sm_pr GROUP BY {O.K}),
sm_h AS (SELECT h.*, y.yy FROM (SELECT * FROM panel WHERE {HIST_RANGE}) h JOIN sm_y y USING ({O.K})),
sm_f AS (SELECT {O.K}, MAX(CASE WHEN year < yy THEN 1 ELSE 0 END) AS has_prev FROM sm_h GROUP BY {O.K}),
sm_a AS (SELECT {O.K}, 'weekday_week' AS by_, AVG(sales) AS a FROM sm_h GROUP BY {O.K}, weekday_week
         UNION ALL SELECT {O.K}, 'weekday' AS by_, AVG(sales) AS a FROM sm_h WHERE year = yy GROUP BY {O.K}, weekday)"""


@register("o62_seasonal_average_summary", sql(B + "," + SUMMARY_SQL, f"""SELECT a.hierarchy1_id, a.storetype_id,
    MIN(a.a) AS avg_min, AVG(a.a) AS avg_mean, MAX(a.a) AS avg_max
    FROM sm_a a JOIN sm_f f USING ({O.K})
    WHERE (f.has_prev = 1 AND a.by_ = 'weekday_week') OR (f.has_prev = 0 AND a.by_ = 'weekday')
    GROUP BY a.hierarchy1_id, a.storetype_id""", ["avg_min", "avg_mean", "avg_max"]))
def q_summary(spark, sf):
    p = ctx(spark, sf).panel
    return BL.seasonal_average_summary(P.filter_date_range(p, C.train_start, C.test_end),
                                       P.filter_date_range(p, C.prediction_start, C.prediction_end))


FB_SQL = O.trend_ctes("fb", TRAIN_RANGE, C.train_start, "panel")


@register("o12_attach_feature_by_key", sql(B + "," + FB_SQL, f"""SELECT p.date, p.hierarchy1_id, p.storetype_id, p.sales,
    fb.predicted_fbprophet AS fb_feature FROM panel p LEFT JOIN fb
    ON p.date = fb.date AND p.hierarchy1_id = fb.hierarchy1_id AND p.storetype_id = fb.storetype_id""", ["sales", "fb_feature"]))
def q_fb(spark, sf):
    """Trend-model value looked up by (date, K) for every panel row."""
    p = ctx(spark, sf).panel
    fb = BL.trend_forecast(p, p, C, C.train_start, C.train_end, out_col="fb_feature")
    return FE.attach_feature_by_key(p.select("date", *K, "sales"), fb, "fb_feature")


@register("o38_concat_forecasts", sql(B + "," + FB_SQL, f"""SELECT date, {O.K}, predicted_fbprophet AS predicted, 'fit' AS part
    FROM fb WHERE {TRAIN_RANGE} UNION ALL SELECT date, {O.K}, predicted_fbprophet, 'future' FROM fb
    WHERE date BETWEEN {O.d(C.test_start)} AND {O.d(C.prediction_end)}""", ["predicted"]))
def q_concat_fc(spark, sf):
    """Fitted values over the training range plus forecasts over test and
    prediction ranges, as one keyed table (the reference's lookup dict)."""
    p = ctx(spark, sf).panel
    fit = BL.trend_forecast(p, P.filter_date_range(p, C.train_start, C.train_end), C, C.train_start,
                            C.train_end, out_col="predicted").withColumn("part", F.lit("fit"))
    fut = BL.trend_forecast(p, P.filter_date_range(p, C.test_start, C.prediction_end), C, C.train_start,
                            C.train_end, out_col="predicted").withColumn("part", F.lit("future"))
    return P.concat_frames(fit, fut)


# ---------------------------------------------------------------- O02-O04
from panelcast.sources import narrow as NR  # noqa: E402

INPUT_NUMERIC = {
    "sales": [("product_id", False), ("store_id", False), ("sales", True), ("price", True)],
    "taxonomy": [("product_id", False), ("product_length", True), ("product_depth", True), ("product_width", True)],
    "stores": [("store_id", False), ("store_size", True)]}
NARROW_COLS = ["column_name", "n_rows", "n_null", "n_distinct", "min_value", "max_value", "int_max_loss",
               "int_avg_loss", "f16_max_loss", "f16_avg_loss", "f32_max_loss", "f32_avg_loss", "chosen_type"]
NARROW_DBL = ["min_value", "max_value", "int_max_loss", "int_avg_loss", "f16_max_loss", "f16_avg_loss",
              "f32_max_loss", "f32_avg_loss"]


def _inputs(spark, sf):
    from panelcast.sources.tables import stores_df, taxonomy_df
    return {"sales": sales_df(spark, sf), "taxonomy": taxonomy_df(spark, sf), "stores": stores_df(spark, sf)}


@register("o02_narrow_schema", sql(B + "," + O.narrow_stats_sql(INPUT_NUMERIC),
                                   f"SELECT table_name, {', '.join(NARROW_COLS[:-1])}, {O.narrow_choice_sql()} AS chosen_type FROM nstats",
                                   NARROW_DBL))
def q_narrow(spark, sf):
    """Loss statistics and the chosen narrow type of every numeric column of the three inputs."""
    parts = [NR.choose_types(NR.narrowing_stats(df)).select(F.lit(t).alias("table_name"), *NARROW_COLS)
             for t, df in _inputs(spark, sf).items()]
    return P.concat_frames(*parts)


@register("o02_narrowed_totals", sql(B, """SELECT 'sales' AS table_name, COUNT(*) AS n_rows, SUM(CAST(CAST(sales AS FLOAT) AS DOUBLE)) AS total FROM sales
    UNION ALL SELECT 'taxonomy', COUNT(*), SUM(product_length) FROM taxonomy
    UNION ALL SELECT 'stores', COUNT(*), SUM(CAST(CAST(store_size AS FLOAT) AS DOUBLE)) FROM stores""", ["total"]))
def q_narrowed(spark, sf):
    """O02 applied: each input cast to its narrow types, then totalled."""
    total = {"sales": "sales", "taxonomy": "product_length", "stores": "store_size"}
    parts = []
    for t, df in _inputs(spark, sf).items():
        narrowed, _ = NR.narrow_schema(df)
        parts.append(narrowed.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                  F.sum(F.col(total[t]).cast("double")).alias("total")))
    return P.concat_frames(*parts)


@register("o04_encoded_sales", sql(B, """SELECT j.hierarchy1_id, c.code AS hierarchy1_id_code, COUNT(*) AS n_rows FROM joined j
    JOIN (SELECT value, CAST(DENSE_RANK() OVER (ORDER BY value) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT hierarchy1_id AS value FROM taxonomy)) c ON c.value = j.hierarchy1_id GROUP BY ALL"""))
def q_encoded(spark, sf):
    """O04 applied: the joined sales with category codes, counted by code."""
    return NR.encode_category(ctx(spark, sf).joined, "hierarchy1_id") \
        .groupBy("hierarchy1_id", "hierarchy1_id_code").agg(F.count(F.lit(1)).alias("n_rows"))


SALES_COLS = ["date", "product_id", "store_id", "sales", "price", "promo_type_1", "promo_bin_1", "promo_type_2",
              "promo_bin_2", "promo_discount_2", "promo_discount_type_2"]


DIM_COLS = ["hierarchy1_id", "cluster_id", "product_length", "product_depth", "product_width", "storetype_id",
            "city_id", "store_size"]


@register("o03_column_profile", sql(B, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, SUM(CAST({c} IS NULL AS BIGINT)) AS n_null, "
    f"COUNT(DISTINCT {c}) + MAX(CAST({c} IS NULL AS BIGINT)) AS n_distinct FROM joined" for c in
    SALES_COLS + DIM_COLS)))
def q_profile(spark, sf):
    return NR.column_profile(ctx(spark, sf).joined.select(*SALES_COLS, *DIM_COLS))


@register("o04_encode_category", sql(B, """SELECT 'hierarchy1_id' AS column_name, value,
    CAST(DENSE_RANK() OVER (ORDER BY value) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT hierarchy1_id AS value FROM taxonomy WHERE hierarchy1_id IS NOT NULL)
    UNION ALL SELECT 'city_id', value, CAST(DENSE_RANK() OVER (ORDER BY value) - 1 AS INTEGER)
    FROM (SELECT DISTINCT city_id AS value FROM stores WHERE city_id IS NOT NULL)"""))
def q_codes(spark, sf):
    from panelcast.sources.tables import taxonomy_df, stores_df
    return NR.category_codes(taxonomy_df(spark, sf), "hierarchy1_id") \
        .unionByName(NR.category_codes(stores_df(spark, sf), "city_id"))


# ---------------------------------------------------------------- O39 / O40 / O16
from panelcast.operators import prep as PR  # noqa: E402


@register("o39_sample_weights", sql(B, f"""SELECT date, {O.K}, COALESCE(
    (CASE WHEN year < {C.weight_cutoff_year} THEN 0.25 ELSE 1.0 END)
    + (CASE WHEN month IS NULL THEN NULL WHEN month >= {C.prediction_month - 1} THEN 0.25 ELSE 0.0 END), 1.0) AS weight
    FROM panel WHERE {TRAIN_RANGE}"""))
def q_weights(spark, sf):
    p = P.filter_date_range(ctx(spark, sf).panel, C.train_start, C.train_end)
    return p.select("date", *K, PR.sample_weight(C.weight_cutoff_year, C.prediction_month).alias("weight"))


def _te_sql(hashed: bool = False) -> str:
    enc = []
    for c in K:
        enc.append(f"""
lv_{c} AS (SELECT {c}, fold, SUM(sales) AS svf, COUNT(sales) AS nvf FROM folded GROUP BY {c}, fold),
tv_{c} AS (SELECT {c}, SUM(svf) AS sv, SUM(nvf) AS nv FROM lv_{c} GROUP BY {c}),
enc_{c} AS (SELECT t.{c}, p.fold,
    CASE WHEN t.nv - COALESCE(l.nvf, 0) > 1
         THEN (t.sv - COALESCE(l.svf, 0.0) + p.prior) / (t.nv - COALESCE(l.nvf, 0) + 1)
         ELSE p.prior END AS e
  FROM tv_{c} t CROSS JOIN pri p LEFT JOIN lv_{c} l ON l.{c} = t.{c} AND l.fold = p.fold),
mean_{c} AS (SELECT {c}, AVG(e) AS e FROM enc_{c} GROUP BY {c})""")
    if hashed:
        rows = f"""
folded AS (SELECT date, {O.K}, sales, CAST(CAST('0x' || substr(md5(concat_ws('|', {O.K}, CAST(date AS VARCHAR))), 1, 8) AS BIGINT) % 3
           AS INTEGER) AS fold FROM panel WHERE {TRAIN_RANGE}),"""
    else:
        rows = f"""
tr AS (SELECT date, {O.K}, sales FROM panel WHERE {TRAIN_RANGE}),
sizes AS (SELECT {O.K}, COUNT(*) AS n FROM tr GROUP BY {O.K}),
offs AS (SELECT {O.K}, COALESCE(SUM(n) OVER (ORDER BY {O.K} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM sizes),
tot AS (SELECT SUM(n) AS total FROM sizes),
pos AS (SELECT t.*, o.off + ROW_NUMBER() OVER (PARTITION BY t.hierarchy1_id, t.storetype_id ORDER BY t.date) - 1 AS pos
        FROM tr t JOIN offs o ON t.hierarchy1_id = o.hierarchy1_id AND t.storetype_id = o.storetype_id),
folded AS (SELECT p.*, CAST(CASE WHEN pos < (total % 3) * (total // 3 + 1) THEN pos // (total // 3 + 1)
                 ELSE (total % 3) + (pos - (total % 3) * (total // 3 + 1)) // (total // 3) END AS INTEGER) AS fold
           FROM pos p, tot),"""
    return f"""{rows}
fstats AS (SELECT fold, SUM(sales) AS sf, COUNT(sales) AS nf FROM folded GROUP BY fold),
allst AS (SELECT SUM(sf) AS sa, SUM(nf) AS na FROM fstats),
pri AS (SELECT f.fold, (a.sa - f.sf) / (a.na - f.nf) AS prior FROM fstats f, allst a),
mp AS (SELECT AVG(prior) AS mp FROM pri),""" + ",".join(enc)


TE_SQL = f"""
    SELECT 'train' AS split, f.date, f.hierarchy1_id, f.storetype_id, f.fold,
           eh.e AS hierarchy1_id_tenc, es.e AS storetype_id_tenc
    FROM folded f JOIN enc_hierarchy1_id eh ON f.hierarchy1_id = eh.hierarchy1_id AND f.fold = eh.fold
                  JOIN enc_storetype_id es ON f.storetype_id = es.storetype_id AND f.fold = es.fold
    UNION ALL
    SELECT CASE WHEN p.date <= {O.d(C.test_end)} THEN 'test' ELSE 'predict' END, p.date, p.hierarchy1_id, p.storetype_id,
           CAST(NULL AS INTEGER), COALESCE(mh.e, mp.mp), COALESCE(ms.e, mp.mp)
    FROM panel p CROSS JOIN mp LEFT JOIN mean_hierarchy1_id mh ON p.hierarchy1_id = mh.hierarchy1_id
         LEFT JOIN mean_storetype_id ms ON p.storetype_id = ms.storetype_id
    WHERE p.date BETWEEN {O.d(C.test_start)} AND {O.d(C.prediction_end)}"""
TE_COLS = ["hierarchy1_id_tenc", "storetype_id_tenc"]


def _encoded(spark, sf, folds):
    p = ctx(spark, sf).panel
    train = P.filter_date_range(p, C.train_start, C.train_end)
    rest = P.filter_date_range(p, C.test_start, C.prediction_end)
    tr, others, _ = PR.target_encode_oof(train, {"rest": rest}, K, "sales", 3, KEYS, folds=folds)
    a = tr.select(F.lit("train").alias("split"), "date", *K, "fold", *TE_COLS)
    b = others["rest"].select(
        F.when(F.col("date") <= F.lit(C.test_end).cast("date"), "test").otherwise("predict").alias("split"),
        "date", *K, F.lit(None).cast("int").alias("fold"), *TE_COLS)
    return a.unionByName(b)


@register("o40_target_encode_oof", sql(B + "," + _te_sql(), TE_SQL, TE_COLS))
def q_te(spark, sf):
    return _encoded(spark, sf, "contiguous")


@register("o40_target_encode_hash_folds", sql(B + "," + _te_sql(hashed=True), TE_SQL, TE_COLS))
def q_te_hash(spark, sf):
    """O40 with folds by value instead of by position."""
    return _encoded(spark, sf, "hash")


# ---------------------------------------------------------------- O51 / O18 / backtest
BT = B + "," + O.backtest_ctes()
FOLD_COLS = ["prediction_period", "train_start", "train_end", "test_start", "test_end", "prediction_start",
             "prediction_end"]
FIRST_END, LAST_END = dt.date(2001, 2, 28), dt.date(2001, 7, 31)


def _folds(spark, sf):
    return BT_.sales_folds(sales_df(spark, sf, FIRST_END.replace(day=1), LAST_END), FIRST_END, LAST_END, C.train_start)


from panelcast.operators import backtest as BT_  # noqa: E402


@register("o51_backtest_folds", sql(B + "," + O.folds_cte(), f"SELECT {', '.join(FOLD_COLS)} FROM folds"))
def q_folds(spark, sf):
    """Fold dates of the months with sales."""
    return _folds(spark, sf)


@register("o18_validate_folds", sql(B + "," + O.folds_cte(), f"""SELECT prediction_period,
    COALESCE(prediction_end >= prediction_start AND prediction_start > test_end AND test_end >= test_start
             AND test_start > train_end AND train_end >= train_start
             AND datediff('day', test_end, prediction_start) >= 1, FALSE) AS valid FROM folds"""))
def q_validate(spark, sf):
    f = _folds(spark, sf)
    bad = BT_.validate_folds(f).select("prediction_period", F.lit(False).alias("valid"))
    good = f.select("prediction_period").join(bad.select("prediction_period"), "prediction_period", "left_anti") \
            .withColumn("valid", F.lit(True))
    return good.unionByName(bad)


def _bt_results(spark, sf):
    c = ctx(spark, sf)
    if not hasattr(c, "_bt"):
        folds = _folds(spark, sf)
        sums = P.daily_sums(c.data, C.train_start, LAST_END)
        panels = BT_.fold_panels(sums, folds)
        c._bt = cut_lineage(BT_.backtest_baselines(panels, folds))
    return c._bt


RES_DBL = ["sales", "predicted_seasonal_average", "predicted_fbprophet"]


@register("o52_backtest_baselines", sql(BT, "SELECT * FROM res", RES_DBL))
def q_bt(spark, sf):
    """O52 for the two baselines: all six folds in one job."""
    return _bt_results(spark, sf)


def _boosted(spark, sf):
    """The backtest with the boosted model, once per session and table folder."""
    c = ctx(spark, sf)
    if not hasattr(c, "_boosted"):
        from panelcast.plans.forecast import boosted_backtest
        c._boosted = boosted_backtest(c.data, _folds(spark, sf), C)
    return c._boosted


@register("o52_backtest_boosted")
def q_bt_boosted(spark, sf):
    """Three models for all six folds, the boosted ones fitted at once."""
    return _boosted(spark, sf)


@register("o53_mape_three_models")
def q_mape3(spark, sf):
    return M.mape_by_group(_boosted(spark, sf), keys=["prediction_period"])


def _scores3(spark, sf):
    from panelcast.plans.forecast import score_results
    return score_results(_boosted(spark, sf), C)


@register("o56_score_by_period_three_models")
def q_by_period3(spark, sf):
    return _scores3(spark, sf)["by_period"]


@register("o57_score_by_group_three_models")
def q_by_group3(spark, sf):
    return _scores3(spark, sf)["by_group"]


@register("o58_mape_by_group_three_models")
def q_mape_group3(spark, sf):
    return _scores3(spark, sf)["mape_by_group"]


@register("o59_column_totals_three_models")
def q_totals3(spark, sf):
    return _scores3(spark, sf)["totals"]


BT_MODELS = {"seasonal_average": "predicted_seasonal_average", "fbprophet": "predicted_fbprophet"}


def _ape(col, divide_first=True):
    return (f"abs((sales - {col}) / NULLIF(sales + 1, 0))" if divide_first
            else f"abs({col} - sales) / NULLIF(sales + 1, 0)")


@register("o53_mape", sql(BT, "SELECT prediction_period, " + ", ".join(
    f"AVG({_ape(c)}) * 100 AS mape_{n}" for n, c in BT_MODELS.items()) + " FROM res GROUP BY prediction_period",
    [f"mape_{n}" for n in BT_MODELS]))
def q_mape(spark, sf):
    return M.mape_by_group(_bt_results(spark, sf), BT_MODELS, keys=["prediction_period"])


WEIGHTED = """wres AS (SELECT r.*, r.sales / NULLIF(t.tot + 1, 0) AS weight FROM res r
    JOIN (SELECT date, SUM(sales) AS tot FROM res GROUP BY date) t ON r.date = t.date),
fres AS (SELECT * FROM wres WHERE weight > 0.01)"""


@register("o54_day_share_weight", sql(BT + "," + WEIGHTED, f"SELECT date, {O.K}, prediction_period, weight FROM fres",
                                      ["weight"]))
def q_weight(spark, sf):
    r = M.day_share_weight(_bt_results(spark, sf))
    return r.select("date", *K, "prediction_period", "weight")


APE_COLS = [f"mape_{n}" for n in BT_MODELS] + [f"weighted_mape_{n}" for n in BT_MODELS]
APE_SQL = ", ".join([f"100 * {_ape(c, False)} AS mape_{n}" for n, c in BT_MODELS.items()]
                    + [f"weight * 100 * {_ape(c, False)} AS weighted_mape_{n}" for n, c in BT_MODELS.items()])


def _scored(spark, sf):
    r = M.day_share_weight(_bt_results(spark, sf))
    return M.ape_columns(M.ape_columns(r, BT_MODELS), BT_MODELS, weighted=True)


@register("o55_ape_columns", sql(BT + "," + WEIGHTED, f"SELECT date, {O.K}, prediction_period, {APE_SQL} FROM fres",
                                 APE_COLS))
def q_ape(spark, sf):
    return _scored(spark, sf).select("date", *K, "prediction_period", *APE_COLS)


SCORED = BT + "," + WEIGHTED + f", scored AS (SELECT *, {APE_SQL} FROM fres)"


@register("o56_score_by_period", sql(SCORED, "SELECT prediction_period, " + ", ".join(
    f"AVG({c}) AS {c}" for c in APE_COLS) + " FROM scored GROUP BY prediction_period", APE_COLS))
def q_by_period(spark, sf):
    return M.score_by(_scored(spark, sf), ["prediction_period"], APE_COLS)


@register("o57_score_by_group", sql(SCORED, f"SELECT {O.K}, " + ", ".join(
    f"round_even(AVG({c}) * 10, 0) / 10 AS {c}" for c in APE_COLS) + f" FROM scored GROUP BY {O.K}"))
def q_by_group(spark, sf):
    return M.score_by(_scored(spark, sf), K, APE_COLS, round_to=1)


@register("o58_mape_by_group", sql(BT + "," + WEIGHTED, f"SELECT {O.K}, " + ", ".join(
    f"AVG({_ape(c)}) * 100 AS mape_{n}" for n, c in BT_MODELS.items()) + f" FROM fres GROUP BY {O.K}",
    [f"mape_{n}" for n in BT_MODELS]))
def q_mape_group(spark, sf):
    return M.mape_by_group(M.day_share_weight(_bt_results(spark, sf)), BT_MODELS)


@register("o59_column_totals", sql(BT, "SELECT " + ", ".join(f"SUM({c}) AS total_{c}" for c in RES_DBL) + " FROM res",
                                   [f"total_{c}" for c in RES_DBL]))
def q_totals_cols(spark, sf):
    return M.column_totals(_bt_results(spark, sf), RES_DBL)


@register("o42_asymmetric_mse", sql(BT, f"""SELECT prediction_period, AVG(power(CASE WHEN predicted_seasonal_average < sales
    THEN 1.1 ELSE 0.9 END * (predicted_seasonal_average - sales), 2)) AS asymmetric_mse FROM res GROUP BY prediction_period""",
    ["asymmetric_mse"]))
def q_amse(spark, sf):
    return M.asymmetric_mse(_bt_results(spark, sf), "sales", "predicted_seasonal_average", by=["prediction_period"])


# ---------------------------------------------------------------- O11 wide matrix
CYC_COLS = [f"{c}_{f}" for c in ("weekday", "week", "month", "quarter") for f in ("sin", "cos")]


# Value domains of the fixture mapping (TPC-H generator): the oracle pivots
# with an explicit list, Spark discovers the same values from the data.
SHARE_DOMAINS = {
    "promo_type_1": ["A", "N", "R"], "promo_bin_1": ["F", "O"],
    "promo_type_2": [str(i) for i in range(1, 8)], "promo_bin_2": ["high", "low", "mid"],
    "promo_discount_2": [str(i) for i in range(0, 11)], "promo_discount_type_2": ["A", "B"],
    "city_id": [f"NATION_{i}" for i in range(25)], "cluster_id": [f"Brand#{i}" for i in range(1, 26)],
}
CATW = ", ".join("COALESCE(MAX(CASE WHEN feature = '%s' AND value = '%s' THEN share END), 0.0) AS \"%s_%s\""
                 % (f, v, v, f) for f, vals in SHARE_DOMAINS.items() for v in vals)


@register("o11_assemble_features", sql(FEATS + "," + O.product_cte() + "," + O.share_cte() + f""",
catf AS (SELECT year_month, {O.K}, {CATW} FROM shares GROUP BY year_month, {O.K})""",
    f"""SELECT * FROM feats LEFT JOIN catf USING (year_month, {O.K}) LEFT JOIN prod USING (year_month, {O.K})""",
    CYC_COLS + ["store_size_mean", "price_mean"]))
def q_matrix(spark, sf):
    """The full feature matrix (panel features + previous-month shares
    and product statistics)."""
    return ctx(spark, sf).matrix


# ---------------------------------------------------------------- O44 one step (compat)
from panelcast.operators import recursive as RC  # noqa: E402

STEP_DAY = C.prediction_start + dt.timedelta(days=1)
STEP_COLS = ["date", *K, *LAG_NAMES, "week_sales_to_date", "month_sales_to_date", "percentage_sold_of_month", "percentage_sold_of_week",
             "weekday", "week", "month", "year", *CYC_COLS]
STEP_DBL = [*LAG_NAMES, "week_sales_to_date", "month_sales_to_date", "percentage_sold_of_month", "percentage_sold_of_week", *CYC_COLS]


def _step_sql() -> str:
    dd = O.d(STEP_DAY)
    p = "(CASE WHEN exp(predicted) - 1 < 0 THEN 0.0 ELSE exp(predicted) - 1 END)"
    cyc = []
    for c, m in (("weekday", 7.0), ("week", 52.0), ("month", 12.0), ("quarter", 4.0)):
        v = {"weekday": f"isodow({dd}) - 1", "week": f"weekofyear({dd})", "month": f"month({dd})",
             "quarter": f"quarter({dd})"}[c]
        cyc.append(f"sin(2.0 * pi() * CAST({v} AS DOUBLE) / {m}) AS {c}_sin, "
                   f"cos(2.0 * pi() * CAST({v} AS DOUBLE) / {m}) AS {c}_cos")
    totals = ", ".join(f"{p} AS {c}" if c == "total_sales_last_1_days" else f"{c} - {p} + {p} AS {c}" for c in LAG_NAMES)
    return f"""SELECT {dd} AS date, {O.K}, {totals},
      CASE WHEN weekofyear({dd}) > week THEN 0.0 ELSE {p} END AS week_sales_to_date,
      CASE WHEN month({dd}) > month THEN 0.0 ELSE {p} END AS month_sales_to_date,
      (CASE WHEN month({dd}) > month THEN 0.0 ELSE {p} END) / NULLIF(avg_same_month_sales, 0) AS percentage_sold_of_month,
      (CASE WHEN weekofyear({dd}) > week THEN 0.0 ELSE {p} END) / NULLIF(avg_same_week_sales, 0) AS percentage_sold_of_week,
      CAST(isodow({dd}) - 1 AS INTEGER) AS weekday, CAST(weekofyear({dd}) AS INTEGER) AS week,
      CAST(month({dd}) AS INTEGER) AS month, CAST(year({dd}) AS INTEGER) AS year, {", ".join(cyc)}
    FROM (SELECT *, ln(sales + 1) AS predicted FROM feats WHERE date = {O.d(C.prediction_start)}) s"""


@register("o44_advance_state", sql(FEATS, _step_sql(), STEP_DBL))
def q_step(spark, sf):
    """O44 (reference mode), one step from the first prediction day with the
    forecast replaced by the actual (teacher forcing), so SQL can check it."""
    f = ctx(spark, sf).features.where(F.col("date") == F.lit(C.prediction_start).cast("date")) \
        .withColumn("predicted", F.log1p("sales"))
    return RC.advance_state_compat(f, STEP_DAY, C.lags).select(*STEP_COLS)


# ---------------------------------------------------------------- model-backed (rows-only)
def _forecast(spark, sf):
    """One boosted-model run per session and table folder, shared by the
    model-backed queries below."""
    c = ctx(spark, sf)
    if not hasattr(c, "_fc"):
        from panelcast.plans.forecast import run_forecast
        fc = run_forecast(c.joined.where(F.col("date").between(
            F.lit(C.train_start).cast("date"), F.lit(C.prediction_end).cast("date"))), C)
        fc.merged = cut_lineage(fc.merged)
        c._fc = fc
    return c._fc


@register("o41_train_gbt")
def q_gbt(spark, sf):
    """Validation-split predictions of the fitted boosted model."""
    from panelcast.operators import boosting as GB
    from panelcast.operators import models as MD
    fc = _forecast(spark, sf)
    return GB.score_frame(fc.model, fc.datasets.test, ["date", *K, "sales"]) \
        .select("date", *K, "sales", MD.back_transform("prediction").alias("predicted"))


@register("o41_metric_curve")
def q_curve(spark, sf):
    """Training and validation error of every round; the rounds kept."""
    return _forecast(spark, sf).model.history_table(spark)


@register("o41_node_table")
def q_nodes(spark, sf):
    """The fitted trees, one row per node."""
    return _forecast(spark, sf).model.node_table(spark)


@register("o43_row_contributions")
def q_contributions(spark, sf):
    """Contributions of all features to each forecast row of the validation month."""
    from panelcast.operators import boosting as GB
    fc = _forecast(spark, sf)
    return GB.contributions(fc.model, fc.datasets.test, ["date", *K])


@register("o43_feature_importance")
def q_importance(spark, sf):
    """The 25 features of largest mean absolute contribution."""
    from panelcast.operators import boosting as GB
    fc = _forecast(spark, sf)
    return GB.mean_contributions(GB.contributions(fc.model, fc.datasets.test, ["date", *K]), fc.feature_cols)


@register("o45_recursive_forecast")
def q_recursive(spark, sf):
    return _forecast(spark, sf).lgb


BLEND_SQL = f"""SELECT p.date, p.hierarchy1_id, p.storetype_id, p.sales,
    0.5 * sa.predicted_seasonal_average + 0.5 * tr.predicted_fbprophet AS lgb_predicted,
    sa.predicted_seasonal_average, tr.predicted_fbprophet FROM pred p
    JOIN sa ON p.date = sa.date AND p.hierarchy1_id = sa.hierarchy1_id AND p.storetype_id = sa.storetype_id
    JOIN tr ON p.date = tr.date AND p.hierarchy1_id = tr.hierarchy1_id AND p.storetype_id = tr.storetype_id"""
BLEND_DBL = ["lgb_predicted", "predicted_seasonal_average", "predicted_fbprophet"]


def _blend(spark, sf):
    """Join and blend with the seasonal average in the boosted model's place,
    so that SQL can check them; the boosted forecasts are in O45 and O50."""
    from panelcast.operators import models as MD
    panel = ctx(spark, sf).panel
    base = BL.baseline_models(panel, C)
    actual = P.filter_date_range(panel, C.prediction_start, C.prediction_end).select("date", *K, "sales")
    stand_in = actual.join(base.select("date", *K, F.col("predicted_seasonal_average").alias("predicted")), ["date", *K])
    return MD.combine_results(stand_in, base, K)


@register("o13_combine_results", sql(B + "," + SA_SQL + "," + TREND_SQL, BLEND_SQL, ["sales", *BLEND_DBL]))
def q_combine(spark, sf):
    return _blend(spark, sf)


@register("o49_blend_forecasts", sql(B + "," + SA_SQL + "," + TREND_SQL,
                                     f"SELECT date, {O.K}, lgb_predicted, predicted_fbprophet FROM ({BLEND_SQL})",
                                     ["lgb_predicted", "predicted_fbprophet"]))
def q_blend(spark, sf):
    return _blend(spark, sf).select("date", *K, "lgb_predicted", "predicted_fbprophet")


@register("o50_forecast_run")
def q_run(spark, sf):
    """The five output columns of a forecast run."""
    from panelcast.sources.sinks import PREDICTION_COLUMNS
    return _forecast(spark, sf).merged.select(*PREDICTION_COLUMNS)


@register("o16_train_columns")
def q_train_cols(spark, sf):
    cols = PR.train_columns(ctx(spark, sf).matrix.columns, C.except_cols)
    return spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "position int, column_name string")


@register("o63_sort_panel", sql(B, "SELECT * FROM panel", ["sales"]))
def q_sorted(spark, sf):
    return P.sort_panel(ctx(spark, sf).panel)


@register("o61_fill_missing", sql(FEATS, f"""SELECT date, {O.K}, {', '.join(f"COALESCE({c}, 0.0) AS {c}" for c in
    ('avg_same_month_sales', 'avg_same_week_sales', 'avg_same_day_sales'))} FROM withprior""",
    ["avg_same_month_sales", "avg_same_week_sales", "avg_same_day_sales"]))
def q_fill(spark, sf):
    """Prior-year totals of the panel, missing ones as 0."""
    cols = ["avg_same_month_sales", "avg_same_week_sales", "avg_same_day_sales"]
    p = ctx(spark, sf).panel
    return P.fill_missing(p.select("date", *K, *[FE.prior_year_columns("sales")[c].alias(c) for c in cols]), 0.0, cols)


@register("o46b_ridge_trend")
def q_ridge(spark, sf):
    p = ctx(spark, sf).panel
    return BL.ridge_trend_forecast(P.filter_date_range(p, C.train_start, C.test_end),
                                   P.filter_date_range(p, C.prediction_start, C.prediction_end),
                                   C.train_start, C.test_end)


@register("o46b_laplace_trend")
def q_laplace(spark, sf):
    """Additive trend with a Laplace prior on its changes, weekly and daily season."""
    from panelcast.operators.additive import laplace_trend_forecast
    p = ctx(spark, sf).panel
    return laplace_trend_forecast(P.filter_date_range(p, C.train_start, C.test_end),
                                  P.filter_date_range(p, C.prediction_start, C.prediction_end))


def _scratch(spark, name):
    from panelcast.session import ensure_checkpoint_dir
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


@register("o05_write_predictions")
def q_write(spark, sf):
    """Write the forecast output as CSV with a header, read it back."""
    from panelcast.sources.sinks import write_predictions
    from panelcast.sources.files import read_csv
    path = _scratch(spark, "predictions")
    write_predictions(_forecast(spark, sf).merged, path)
    return read_csv(spark, path, "date date, hierarchy1_id string, storetype_id string, sales double, "
                                 "lgb_predicted double")


@register("o06_results_roundtrip", sql(BT, "SELECT * FROM res", RES_DBL))
def q_results(spark, sf):
    """Backtest results appended per period, re-read with parsed dates."""
    from panelcast.sources.sinks import append_results, read_results
    path = _scratch(spark, "results")
    append_results(_bt_results(spark, sf), path)
    return read_results(spark, path)
