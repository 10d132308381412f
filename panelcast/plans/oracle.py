"""Independent SQL (DuckDB dialect) for every SQL-expressible operator.

Written from the operator definitions, not generated from the Spark plans.
All dates come from FIXTURE_CONFIG. Doubles are rounded by the caller-side
wrapper in the same way as the Spark results (see ``panelcast.plans.queries``).
"""

from __future__ import annotations

from panelcast.config import FIXTURE_CONFIG as C, DEFAULT_LAGS, SHARE_FEATURES

K = "hierarchy1_id, storetype_id"
KJ = "USING (hierarchy1_id, storetype_id)"


def d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def cal(c: str = "date") -> str:
    wd = f"CAST(isodow({c}) - 1 AS INTEGER)"
    wk = f"CAST(weekofyear({c}) AS INTEGER)"
    return (f"{wd} AS weekday, {wk} AS week, CAST(month({c}) AS INTEGER) AS month, "
            f"CAST(quarter({c}) AS INTEGER) AS quarter, CAST(year({c}) AS INTEGER) AS year, "
            f"strftime({c}, '%Y-%m') AS year_month, "
            f"CAST(year({c}) AS VARCHAR) || 'Q' || CAST(quarter({c}) AS VARCHAR) AS year_quarter, "
            f"strftime({c}, '%m-%d') AS date_month, "
            f"CAST({wk} AS VARCHAR) || '-' || CAST({wd} AS VARCHAR) AS weekday_week, "
            f"CAST(year({c}) AS VARCHAR) || '-' || CAST({wk} AS VARCHAR) AS year_week")


CAL_COLS = ("weekday, week, month, quarter, year, year_month, year_quarter, date_month, "
            "weekday_week, year_week")


def base(cfg=C) -> str:
    """Fixture views, joined data, daily sums and the panel."""
    return f"""
sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS product_id, l_suppkey AS store_id,
         l_quantity AS sales, l_extendedprice / l_quantity AS price,
         l_returnflag AS promo_type_1, l_linestatus AS promo_bin_1,
         CAST(l_linenumber AS VARCHAR) AS promo_type_2,
         CASE WHEN l_discount < 0.035 THEN 'low' WHEN l_discount < 0.075 THEN 'mid' ELSE 'high' END AS promo_bin_2,
         CAST(CAST(ROUND(l_discount * 100) AS INTEGER) AS VARCHAR) AS promo_discount_2,
         CASE WHEN l_tax < 0.045 THEN 'A' ELSE 'B' END AS promo_discount_type_2
  FROM lineitem),
taxonomy AS (
  SELECT p_partkey AS product_id, p_type AS hierarchy1_id, p_brand AS cluster_id,
         CAST(p_size AS DOUBLE) AS product_length, CAST(p_size % 7 + 1 AS DOUBLE) AS product_depth,
         CAST(p_size % 11 + 1 AS DOUBLE) AS product_width
  FROM part),
stores AS (
  SELECT s_suppkey AS store_id, r_name AS storetype_id, n_name AS city_id, s_acctbal AS store_size
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
joined AS (
  SELECT s.*, t.hierarchy1_id, t.cluster_id, t.product_length, t.product_depth, t.product_width,
         st.storetype_id, st.city_id, st.store_size
  FROM sales s JOIN taxonomy t ON s.product_id = t.product_id JOIN stores st ON s.store_id = st.store_id),
data AS (
  SELECT *, {cal()} FROM joined WHERE date BETWEEN {d(cfg.train_start)} AND {d(cfg.prediction_end)}),
sums AS (
  SELECT date, {K}, COALESCE(SUM(sales), 0.0) AS sales FROM data
  WHERE hierarchy1_id IS NOT NULL AND storetype_id IS NOT NULL GROUP BY date, {K}),
hist AS (
  SELECT * FROM sums WHERE date BETWEEN {d(cfg.train_start)} AND {d(cfg.train_end)}
                        OR date BETWEEN {d(cfg.test_start)} AND {d(cfg.test_end)}),
grp AS (SELECT DISTINCT {K} FROM sums WHERE date BETWEEN {d(cfg.test_start)} AND {d(cfg.test_end)}),
spine AS (
  SELECT CAST(t.d AS DATE) AS date, g.hierarchy1_id, g.storetype_id
  FROM grp g, generate_series(CAST({d(cfg.prediction_start)} AS TIMESTAMP), CAST({d(cfg.prediction_end)} AS TIMESTAMP), INTERVAL 1 DAY) t(d)),
actuals AS (
  SELECT sp.date, sp.hierarchy1_id, sp.storetype_id, s.sales
  FROM spine sp LEFT JOIN sums s ON sp.date = s.date AND sp.hierarchy1_id = s.hierarchy1_id AND sp.storetype_id = s.storetype_id),
flag AS (SELECT COUNT(sales) > 0 AS has FROM actuals),
pred AS (
  SELECT a.date, a.hierarchy1_id, a.storetype_id,
         CASE WHEN f.has THEN COALESCE(a.sales, 0.0) ELSE a.sales END AS sales
  FROM (SELECT *, MAX(sales) OVER (PARTITION BY {K}) AS mx FROM actuals) a, flag f
  WHERE (NOT f.has) OR a.mx >= 0),
panel AS (
  SELECT date, {K}, {cal()}, sales FROM (SELECT * FROM hist UNION ALL SELECT * FROM pred) u)
"""


def lag_ctes(lags=DEFAULT_LAGS) -> str:
    parts = []
    for k in lags:
        parts.append(
            f"CASE WHEN LAG(sales, {k}) OVER w IS NULL THEN NULL "
            f"WHEN datediff('day', LAG(date, {k}) OVER w, date) = {k} THEN LAG(sales, {k}) OVER w "
            f"ELSE 0.0 END AS sales_last_{k}_days")
    lagsql = ",\n  ".join(parts)
    tots = []
    names = [f"sales_last_{k}_days" for k in lags]
    for n in lags:
        tots.append(" + ".join(f"COALESCE({c}, 0.0)" for c in names[:n]) + f" AS total_sales_last_{n}_days")
    return f"""
lagged AS (
  SELECT *,
  {lagsql}
  FROM panel WINDOW w AS (PARTITION BY {K} ORDER BY date)),
totals AS (
  SELECT * EXCLUDE ({", ".join(names)}), {", ".join(tots)} FROM lagged)
"""


def prior_ctes() -> str:
    out = []
    for name, period in (("avg_same_month_sales", "month"), ("avg_same_week_sales", "week"),
                         ("avg_same_day_sales", "weekday_week")):
        out.append(f"""py_{period} AS (
  SELECT year + 1 AS year, {period}, {K}, COALESCE(SUM(sales), 0.0) AS {name}
  FROM panel GROUP BY year, {period}, {K})""")
    return ",\n".join(out)


def features_ctes(lags=DEFAULT_LAGS) -> str:
    """Panel features: lags, prior-year, to-date, ratios, auto cyclic."""
    return lag_ctes(lags) + "," + prior_ctes() + f""",
withprior AS (
  SELECT t.*, m.avg_same_month_sales, wk.avg_same_week_sales, wd.avg_same_day_sales
  FROM totals t
  LEFT JOIN py_month m ON t.year = m.year AND t.month = m.month AND t.hierarchy1_id = m.hierarchy1_id AND t.storetype_id = m.storetype_id
  LEFT JOIN py_week wk ON t.year = wk.year AND t.week = wk.week AND t.hierarchy1_id = wk.hierarchy1_id AND t.storetype_id = wk.storetype_id
  LEFT JOIN py_weekday_week wd ON t.year = wd.year AND t.weekday_week = wd.weekday_week AND t.hierarchy1_id = wd.hierarchy1_id AND t.storetype_id = wd.storetype_id),
todate AS (
  SELECT *,
    CASE WHEN sales IS NULL THEN NULL ELSE COALESCE(SUM(sales) OVER (PARTITION BY {K}, year_month ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) END AS month_sales_to_date,
    CASE WHEN sales IS NULL THEN NULL ELSE COALESCE(SUM(sales) OVER (PARTITION BY {K}, year_week ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) END AS week_sales_to_date
  FROM withprior),
ratios AS (
  SELECT *, month_sales_to_date / NULLIF(avg_same_month_sales, 0) AS percentage_sold_of_month,
            week_sales_to_date / NULLIF(avg_same_week_sales, 0) AS percentage_sold_of_week
  FROM todate),
cmax AS (SELECT CAST(MAX(weekday) AS DOUBLE) AS mwd, CAST(MAX(week) AS DOUBLE) AS mwk,
                CAST(MAX(month) AS DOUBLE) AS mm, CAST(MAX(quarter) AS DOUBLE) AS mq FROM ratios),
feats AS (
  SELECT r.* EXCLUDE (quarter),
    sin(2 * pi() * CAST(r.weekday AS DOUBLE) / c.mwd) AS weekday_sin, cos(2 * pi() * CAST(r.weekday AS DOUBLE) / c.mwd) AS weekday_cos,
    sin(2 * pi() * CAST(r.week AS DOUBLE) / c.mwk) AS week_sin, cos(2 * pi() * CAST(r.week AS DOUBLE) / c.mwk) AS week_cos,
    sin(2 * pi() * CAST(r.month AS DOUBLE) / c.mm) AS month_sin, cos(2 * pi() * CAST(r.month AS DOUBLE) / c.mm) AS month_cos,
    sin(2 * pi() * CAST(r.quarter AS DOUBLE) / c.mq) AS quarter_sin, cos(2 * pi() * CAST(r.quarter AS DOUBLE) / c.mq) AS quarter_cos
  FROM ratios r, cmax c)
"""


def shift_ym(c: str, n: int = 1) -> str:
    return f"strftime(CAST(strptime({c} || '-01', '%Y-%m-%d') AS DATE) + INTERVAL {n} MONTH, '%Y-%m')"


def product_cte() -> str:
    stats = []
    for c in ("product_length", "product_depth", "product_width"):
        stats.append(f"MIN({c}) AS {c}_min, AVG({c}) AS {c}_mean, MAX({c}) AS {c}_max")
    stats2 = [f"MIN({c}) AS {c}_min, AVG({c}) AS {c}_mean, MAX({c}) AS {c}_max" for c in ("store_size", "price")]
    return f"""
prod AS (
  SELECT {K}, {shift_ym('year_month')} AS year_month,
    COUNT(DISTINCT product_id) AS number_of_products, {", ".join(stats)},
    COUNT(DISTINCT store_id) AS number_of_stores, {", ".join(stats2)}
  FROM data WHERE hierarchy1_id IS NOT NULL AND storetype_id IS NOT NULL AND year_month IS NOT NULL
  GROUP BY {K}, year_month)
"""


def share_cte(features=SHARE_FEATURES) -> str:
    unions = " UNION ALL ".join(
        f"SELECT year_month, {K}, sales, '{f}' AS feature, COALESCE(CAST({f} AS VARCHAR), 'nan') AS value FROM data "
        f"WHERE year_month IS NOT NULL AND hierarchy1_id IS NOT NULL AND storetype_id IS NOT NULL"
        for f in features)
    return f"""
share_agg AS (
  SELECT year_month, {K}, feature, value, COALESCE(SUM(sales), 0.0) AS x
  FROM ({unions}) u GROUP BY year_month, {K}, feature, value),
shares AS (
  SELECT {shift_ym('year_month')} AS year_month, {K}, feature, value,
         COALESCE(x / NULLIF(SUM(x) OVER (PARTITION BY year_month, {K}, feature), 0), 0.0) AS share
  FROM share_agg)
"""


def trend_ctes(name: str, hist_where: str, origin, apply_from: str) -> str:
    """Linear trend + weekday residual per group."""
    return f"""
{name}_h AS (SELECT date, {K}, sales, CAST(datediff('day', {d(origin)}, date) AS DOUBLE) AS x FROM panel WHERE {hist_where}),
{name}_c AS (SELECT {K}, regr_intercept(sales, x) AS a, regr_slope(sales, x) AS b FROM {name}_h GROUP BY {K}),
{name}_e AS (SELECT h.hierarchy1_id, h.storetype_id, CAST(isodow(h.date) - 1 AS INTEGER) AS wd, AVG(h.sales - c.a - c.b * h.x) AS e
             FROM {name}_h h JOIN {name}_c c ON h.hierarchy1_id = c.hierarchy1_id AND h.storetype_id = c.storetype_id GROUP BY ALL),
{name} AS (
  SELECT p.date, p.hierarchy1_id, p.storetype_id,
         CASE WHEN c.a + c.b * CAST(datediff('day', {d(origin)}, p.date) AS DOUBLE) + COALESCE(e.e, 0.0) < 0 THEN 0.0
              ELSE c.a + c.b * CAST(datediff('day', {d(origin)}, p.date) AS DOUBLE) + COALESCE(e.e, 0.0) END AS predicted_fbprophet
  FROM (SELECT DISTINCT date, {K} FROM {apply_from}) p
  LEFT JOIN {name}_c c ON p.hierarchy1_id = c.hierarchy1_id AND p.storetype_id = c.storetype_id
  LEFT JOIN {name}_e e ON p.hierarchy1_id = e.hierarchy1_id AND p.storetype_id = e.storetype_id AND CAST(isodow(p.date) - 1 AS INTEGER) = e.wd)
"""


def seasonal_ctes(hist: str, predq: str, keys: str = K) -> str:
    """O47 over a history relation and a prediction relation (both with keys)."""
    kk = [k.strip() for k in keys.split(",")]
    on = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in kk)
    return f"""
sa_pr AS (SELECT DISTINCT date, year, weekday_week, weekday, {keys} FROM {predq}),
sa_y AS (SELECT {keys}, MAX(year) AS yy FROM sa_pr GROUP BY {keys}),
sa_h AS (SELECT h.*, y.yy FROM {hist} h JOIN sa_y y ON {on('h', 'y')}),
sa_f AS (SELECT {keys}, MAX(CASE WHEN year < yy THEN 1 ELSE 0 END) AS has_prev,
                MAX(CASE WHEN year = yy - 1 THEN 1 ELSE 0 END) AS has_ym1,
                COALESCE(SUM(CASE WHEN year = yy THEN sales END), 0.0) AS sy,
                COALESCE(SUM(CASE WHEN year = yy - 1 THEN sales END), 0.0) AS sy1
         FROM sa_h GROUP BY {keys}),
sa_ww AS (SELECT {keys}, weekday_week, AVG(sales) AS aww FROM sa_h GROUP BY {keys}, weekday_week),
sa_wd AS (SELECT {keys}, weekday, AVG(sales) AS awd FROM sa_h WHERE year = yy GROUP BY {keys}, weekday),
sa AS (
  SELECT p.date, {", ".join("p." + k for k in kk)},
    CASE WHEN v < 0 THEN 0.0 ELSE v END AS predicted_seasonal_average
  FROM (
    SELECT p.*, CASE WHEN f.has_prev = 1
                     THEN ww.aww * (CASE WHEN f.has_ym1 = 1 THEN f.sy / NULLIF(f.sy1, 0) ELSE 1.0 END)
                     ELSE wd.awd END AS v
    FROM sa_pr p
    LEFT JOIN sa_f f ON {on('p', 'f')}
    LEFT JOIN sa_ww ww ON {on('p', 'ww')} AND p.weekday_week = ww.weekday_week
    LEFT JOIN sa_wd wd ON {on('p', 'wd')} AND p.weekday = wd.weekday) p)
"""


def folds_cte(first_end: str = "2001-02-01", last_end: str = "2001-07-01", train_start=None) -> str:
    ts = d(train_start or C.train_start)
    return f"""
folds AS (
  SELECT e AS prediction_period, {ts} AS train_start,
         CAST(CAST(e - INTERVAL 2 MONTH AS DATE) + 1 - 1 AS DATE) AS train_end,
         CAST(CAST(e - INTERVAL 2 MONTH AS DATE) + 1 AS DATE) AS test_start,
         CAST(CAST(e - INTERVAL 1 MONTH AS DATE) + 1 - 1 AS DATE) AS test_end,
         CAST(CAST(e - INTERVAL 1 MONTH AS DATE) + 1 AS DATE) AS prediction_start,
         e AS prediction_end
  FROM (SELECT DISTINCT CAST(last_day(date) AS DATE) AS e FROM sales
        WHERE date >= DATE '{first_end}' AND date <= last_day(DATE '{last_end}')) x)
"""


FK = "prediction_period, hierarchy1_id, storetype_id"


def backtest_ctes() -> str:
    """Fold panels and both baselines for every fold (O52 without GBT)."""
    return folds_cte() + f""",
fhist AS (SELECT f.prediction_period, s.date, s.hierarchy1_id, s.storetype_id, s.sales
          FROM sums s JOIN folds f ON s.date BETWEEN f.train_start AND f.test_end),
fgrp AS (SELECT DISTINCT f.prediction_period, s.hierarchy1_id, s.storetype_id, f.prediction_start, f.prediction_end
         FROM sums s JOIN folds f ON s.date BETWEEN f.test_start AND f.test_end),
fspine AS (SELECT prediction_period, hierarchy1_id, storetype_id,
                  CAST(unnest(generate_series(CAST(prediction_start AS TIMESTAMP), CAST(prediction_end AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
           FROM fgrp),
fact AS (SELECT sp.prediction_period, sp.date, sp.hierarchy1_id, sp.storetype_id, s.sales
         FROM fspine sp LEFT JOIN sums s ON sp.date = s.date AND sp.hierarchy1_id = s.hierarchy1_id AND sp.storetype_id = s.storetype_id),
fflag AS (SELECT prediction_period, COUNT(sales) > 0 AS has FROM fact GROUP BY prediction_period),
fpred AS (SELECT a.prediction_period, a.date, a.hierarchy1_id, a.storetype_id,
                 CASE WHEN g.has THEN COALESCE(a.sales, 0.0) ELSE a.sales END AS sales
          FROM (SELECT *, MAX(sales) OVER (PARTITION BY {FK}) AS mx FROM fact) a
          JOIN fflag g ON a.prediction_period = g.prediction_period
          WHERE (NOT g.has) OR a.mx >= 0),
fpanel AS (SELECT prediction_period, date, hierarchy1_id, storetype_id, {cal()}, sales
           FROM (SELECT * FROM fhist UNION ALL SELECT * FROM fpred) u),
fp AS (SELECT p.*, f.train_start, f.test_end, f.prediction_start, f.prediction_end
       FROM fpanel p JOIN folds f ON p.prediction_period = f.prediction_period),
fph AS (SELECT * FROM fp WHERE date BETWEEN train_start AND test_end),
fpp AS (SELECT * FROM fp WHERE date BETWEEN prediction_start AND prediction_end),
{seasonal_ctes("fph", "fpp", FK).strip().rstrip(",")},
bt_h AS (SELECT *, CAST(datediff('day', train_start, date) AS DOUBLE) AS x FROM fph),
bt_c AS (SELECT {FK}, regr_intercept(sales, x) AS a, regr_slope(sales, x) AS b FROM bt_h GROUP BY {FK}),
bt_e AS (SELECT h.prediction_period, h.hierarchy1_id, h.storetype_id, CAST(isodow(h.date) - 1 AS INTEGER) AS wd,
                AVG(h.sales - c.a - c.b * h.x) AS e
         FROM bt_h h JOIN bt_c c ON h.prediction_period = c.prediction_period AND h.hierarchy1_id = c.hierarchy1_id
              AND h.storetype_id = c.storetype_id GROUP BY ALL),
bt_tr AS (SELECT p.prediction_period, p.date, p.hierarchy1_id, p.storetype_id,
                 c.a + c.b * CAST(datediff('day', p.train_start, p.date) AS DOUBLE) + COALESCE(e.e, 0.0) AS v
          FROM fpp p
          LEFT JOIN bt_c c ON p.prediction_period = c.prediction_period AND p.hierarchy1_id = c.hierarchy1_id AND p.storetype_id = c.storetype_id
          LEFT JOIN bt_e e ON p.prediction_period = e.prediction_period AND p.hierarchy1_id = e.hierarchy1_id
               AND p.storetype_id = e.storetype_id AND CAST(isodow(p.date) - 1 AS INTEGER) = e.wd),
res AS (SELECT p.date, p.hierarchy1_id, p.storetype_id, p.sales, sa.predicted_seasonal_average,
               CASE WHEN t.v < 0 THEN 0.0 ELSE t.v END AS predicted_fbprophet, p.prediction_period
        FROM fpp p
        JOIN sa ON p.prediction_period = sa.prediction_period AND p.date = sa.date AND p.hierarchy1_id = sa.hierarchy1_id AND p.storetype_id = sa.storetype_id
        JOIN bt_tr t ON p.prediction_period = t.prediction_period AND p.date = t.date AND p.hierarchy1_id = t.hierarchy1_id AND p.storetype_id = t.storetype_id)
"""


def narrow_stats_sql(tables) -> str:
    """O02 statistics per column (tables: name -> list of (column, is_float))."""
    parts = []
    for table, c, is_float in ((t, *x) for t, columns in tables.items() for x in columns):
        x = f"CAST({c} AS DOUBLE)"
        xi = f"round(COALESCE({x}, 0.0))" if is_float else x
        a = f"abs({x})"
        e0 = f"floor(log2({a}))"
        e = f"(CASE WHEN power(2.0, {e0}) > {a} THEN {e0} - 1 WHEN power(2.0, {e0} + 1) <= {a} THEN {e0} + 1 ELSE {e0} END)"
        q = f"power(2.0, greatest({e}, -14) - 10)"
        v16 = (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {a} >= 65520 THEN sign({x}) * 'inf'::DOUBLE "
               f"WHEN {a} = 0 THEN 0.0 ELSE sign({x}) * round_even({a} / {q}, 0) * {q} END)")
        v32 = f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"
        isnull = f"CAST({c} IS NULL AS INTEGER)"
        parts.append(f"""SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS n_rows, SUM({isnull}) AS n_null,
  COUNT(DISTINCT {x}) + MAX({isnull}) AS n_distinct, MIN({x}) AS min_value, MAX({x}) AS max_value,
  MIN({xi}) AS int_min, MAX({xi}) AS int_max, MAX(abs({xi} - {x})) AS int_max_loss, AVG(abs({xi} - {x})) AS int_avg_loss,
  COUNT(DISTINCT {xi}) AS int_distinct,
  MAX(abs({v16} - {x})) AS f16_max_loss, AVG(abs({v16} - {x})) AS f16_avg_loss, COUNT(DISTINCT {v16}) + MAX({isnull}) AS f16_distinct,
  MAX(abs({v32} - {x})) AS f32_max_loss, AVG(abs({v32} - {x})) AS f32_avg_loss, COUNT(DISTINCT {v32}) + MAX({isnull}) AS f32_distinct
FROM {table}""")
    return "nstats AS (" + "\nUNION ALL\n".join(parts) + ")"


def narrow_choice_sql() -> str:
    def int_ok(lo, hi):
        return (f"(n_null <= 0 AND int_min >= {lo} AND int_max <= {hi} AND int_max_loss <= 0.001 "
                f"AND int_avg_loss <= 0.001 AND abs(n_distinct - int_distinct) <= 0)")

    def f_ok(p):
        return f"({p}_max_loss <= 0.001 AND {p}_avg_loss <= 0.001 AND abs(n_distinct - {p}_distinct) <= 0)"
    return (f"CASE WHEN {int_ok(-128, 127)} THEN 'int8' WHEN {int_ok(-32768, 32767)} THEN 'int16' "
            f"WHEN {f_ok('f16')} THEN 'float16' WHEN {int_ok(-2147483648, 2147483647)} THEN 'int32' "
            f"WHEN {f_ok('f32')} THEN 'float32' END")
