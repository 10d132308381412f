"""Plan-shape checks: the scale properties the design relies on."""

import contextlib
import datetime as dt
import io
import os

from conftest import SF001
from panelcast.config import FIXTURE_CONFIG as C
from panelcast.operators import panel as P
from panelcast.operators import features as FE
from panelcast.operators import baselines as BL
from panelcast.session import cut_lineage
from panelcast.sources.tables import joined_sales


def _plan(df) -> str:
    f = io.StringIO()
    with contextlib.redirect_stdout(f):
        df.explain("formatted")
    return f.getvalue()


def _tree(df) -> str:
    return _plan(df).split("\n\n")[0]


def test_date_filter_and_columns_reach_the_scan(spark):
    data = P.prepare_data(joined_sales(spark, SF001, C.train_start, C.prediction_end), C)
    plan = _plan(P.daily_sums(data, C.train_start, C.prediction_end))
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01" in plan
    assert "LessThan(l_shipdate,2001-08-01" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_panel_features_share_one_exchange(spark):
    data = P.prepare_data(joined_sales(spark, SF001, C.train_start, C.prediction_end), C)
    panel = cut_lineage(P.build_panel(data, C))
    from dataclasses import replace
    feats = FE.panel_features(panel, replace(C, cyclic_mode="manual"))
    tree = _tree(feats)
    assert tree.count("Exchange") == 1, tree
    assert "CartesianProduct" not in tree


def test_baselines_one_exchange_per_model(spark):
    data = P.prepare_data(joined_sales(spark, SF001, C.train_start, C.prediction_end), C)
    panel = cut_lineage(P.build_panel(data, C))
    hist = P.filter_date_range(panel, C.train_start, C.test_end)
    pred = P.filter_date_range(panel, C.prediction_start, C.prediction_end)
    sa = _tree(BL.seasonal_average_baseline(hist, pred))
    tr = _tree(BL.linear_trend_forecast(hist, pred, C.train_start))
    # one exchange for the K windows, one for de-duplicating prediction rows
    assert sa.count("Exchange") == 2, sa
    assert tr.count("Exchange") == 2, tr
    assert "Join" not in sa and "Join" not in tr


def test_product_stats_without_expand(spark):
    data = P.prepare_data(joined_sales(spark, SF001, C.train_start, C.prediction_end), C)
    got = FE.product_features(data)
    assert "Expand" not in _tree(got)
    assert got.count() == data.select("hierarchy1_id", "storetype_id", "year_month").distinct().count()


def test_monthly_features_end_before_the_prediction_window(spark):
    """A window that crosses a month: its own first days must not change its features."""
    import datetime as dt
    cfg = C.with_dates(test_start=dt.date(2001, 4, 30), test_end=dt.date(2001, 5, 30), train_end=dt.date(2001, 4, 29),
                       prediction_start=dt.date(2001, 5, 31), prediction_end=dt.date(2001, 6, 30))
    data = P.prepare_data(joined_sales(spark, SF001, cfg.train_start, cfg.prediction_end), cfg)
    panel = cut_lineage(P.build_panel(data, cfg))
    cols = ["number_of_products", "price_mean", "A_promo_type_1"]

    def june(rows):
        m = FE.build_feature_matrix(rows, panel, cfg)
        return m.where("date > DATE'2001-05-31'").select("date", "hierarchy1_id", "storetype_id", *cols)

    full, cut = june(data), june(data.where("date <> DATE'2001-05-31'"))
    assert data.where("date = DATE'2001-05-31'").count() > 0 and full.count() > 0
    assert full.exceptAll(cut).isEmpty()


def test_features_read_the_fact_once(spark):
    """One lineitem scan for daily sums, shares and product statistics; none after it."""
    from conftest import SF0001
    from panelcast.config import FIXTURE_CONFIG as C
    from panelcast.operators import features as FE, panel as P
    from panelcast.session import cut_lineage
    from panelcast.sources.tables import joined_sales

    def scans(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("l_shipdate")

    data = P.prepare_data(joined_sales(spark, SF0001, C.train_start, C.prediction_end), C)
    plan = FE.fact_aggregates(data, C)
    assert str(plan._jdf.queryExecution().sparkPlan()).count("FileScan") - 4 == 1      # four dimension scans
    facts = cut_lineage(plan)
    panel = P.build_panel(data, C, FE.daily_from(facts, C))
    assert scans(FE.build_feature_matrix(data, panel, C, facts)) == 0


def test_fact_aggregates_combine_before_they_are_dealt(spark):
    """Products and stores are not unpivoted with the sums, and the fact rows are read from one written table."""
    from conftest import SF0001
    from panelcast.config import FIXTURE_CONFIG as C
    from panelcast.operators import features as FE, panel as P
    from panelcast.sources.tables import joined_sales
    facts = FE.fact_aggregates(P.prepare_data(joined_sales(spark, SF0001, C.train_start, C.prediction_end), C), C)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    unpivots = [x for x in plan.splitlines() if "Generate" in x]
    assert unpivots and not any("product_id" in x or "store_id" in x for x in unpivots)
    assert "l_shipdate" not in plan
    assert len({os.path.dirname(f) for f in facts.inputFiles()}) == 1


def test_fact_aggregates_of_rows_with_nulls_and_repeats(spark):
    from dataclasses import replace
    from panelcast.config import FIXTURE_CONFIG
    from panelcast.operators import features as FE
    cfg = replace(FIXTURE_CONFIG, share_features=("city_id",))
    names = ("date date, year_month string, hierarchy1_id string, storetype_id string, sales double, city_id string, product_id long, "
             "store_id long, product_length double, product_depth double, product_width double, store_size double, price double")
    d, late = dt.date(2001, 6, 1), dt.date(2001, 7, 2)
    a = (d, "2001-06", "A", "S", 2.0, "x", 1, 7, 1.0, None, 1.0, 5.0, 3.0)
    rows = [a, a, (d, "2001-06", "A", "S", None, None, 2, None, 4.0, None, 1.0, 5.0, 9.0), (d, "2001-06", None, "S", 9.0, *a[5:]),
            (late, "2001-07", "A", "S", 1.0, *a[5:]), (None, None, "A", "S", 4.0, *a[5:])]
    got = {(r["tag"], r["period"], r["name"], r["value"]): (r["total"], r["low"], r["high"], r["n"], r["kinds"])
           for r in FE.fact_aggregates(spark.createDataFrame(rows, names), cfg).collect()}
    assert got == {
        ("day", "2001-06-01", "", ""): (4.0, 2.0, 2.0, 2, 1), ("day", "2001-07-02", "", ""): (1.0, 1.0, 1.0, 1, 1),
        ("day", None, "", ""): (4.0, 4.0, 4.0, 1, 1),
        ("share", "2001-06", "city_id", "x"): (4.0, 2.0, 2.0, 2, 1), ("share", "2001-06", "city_id", "nan"): (None, None, None, 0, 1),
        ("stat", "2001-06", "product_length", ""): (6.0, 1.0, 4.0, 3, 1), ("stat", "2001-06", "product_depth", ""): (None, None, None, 0, 1),
        ("stat", "2001-06", "product_width", ""): (3.0, 1.0, 1.0, 3, 1), ("stat", "2001-06", "store_size", ""): (15.0, 5.0, 5.0, 3, 1),
        ("stat", "2001-06", "price", ""): (15.0, 3.0, 9.0, 3, 1),
        ("kind", "2001-06", "product_id", ""): (None, None, None, 0, 2), ("kind", "2001-06", "store_id", ""): (None, None, None, 0, 1)}


def test_kinds_of_months_with_nulls_repeats_and_far_months(spark):
    """Distinct values a month and group, months more than 64 apart and before the first included."""
    from panelcast.operators import features as FE
    rows = [("1996-12", "A", "S", 1), ("1997-01", "A", "S", 1), ("1997-01", "A", "S", 1), ("1997-01", "A", "S", 2),
            ("1997-01", "A", "T", 2), ("2002-04", "A", "S", 1), ("2002-05", "A", "S", 1), ("2002-05", "A", "S", None),
            ("2010-12", "B", "S", None), ("1985-01", "B", "S", 7)]
    known = spark.createDataFrame(rows, "__period string, hierarchy1_id string, storetype_id string, store_id long").repartition(3)
    keys = ["hierarchy1_id", "storetype_id"]
    expected = {("1996-12", "A", "S"): 1, ("1997-01", "A", "S"): 2, ("1997-01", "A", "T"): 1, ("2002-04", "A", "S"): 1,
                ("2002-05", "A", "S"): 1, ("2010-12", "B", "S"): 0, ("1985-01", "B", "S"): 1}
    for got in (FE.masked_kinds(known, keys, "store_id", dt.date(1997, 1, 1)), FE.dealt_kinds(known, keys, "store_id", len(rows), 4)):
        assert sorted((*r[:3], r[3]) for r in got.select("__period", *keys, "__kinds").collect()) == \
            sorted((*k, n) for k, n in expected.items())


def test_kinds_are_dealt_in_bounded_tasks(spark):
    """The tasks that tell products apart grow in number with the rows; stores are not dealt by month."""
    from panelcast.operators import features as FE
    known = spark.createDataFrame([("2001-06", "A", "S", 1)], "__period string, hierarchy1_id string, storetype_id string, c long")
    keys = ["hierarchy1_id", "storetype_id"]
    cores = spark.sparkContext.defaultParallelism
    plan = str(FE.dealt_kinds(known, keys, "c", 250_000 * 3 * cores)._jdf.queryExecution().sparkPlan())
    assert f", {3 * cores}" in plan
    plan = str(FE.masked_kinds(known, keys, "c", dt.date(1997, 1, 1))._jdf.queryExecution().optimizedPlan())
    deepest = [x for x in plan.splitlines() if "Aggregate [" in x][-1]
    assert "bit_or" in deepest and "c#" in deepest.split("]")[0] and "__period" not in deepest.split("]")[0]


def test_feature_matrix_takes_its_panel_from_the_fact_aggregates(spark, monkeypatch):
    from conftest import SF0001
    from panelcast.operators import panel as P
    from panelcast.plans.context import PanelContext

    def second_read(*args, **kw):
        raise AssertionError("fact rows read again for the panel")

    monkeypatch.setattr(P, "daily_sums", second_read)
    assert "sales" in PanelContext(spark, SF0001).matrix.columns
