import datetime as dt

from pyspark.sql import functions as F

from panelcast.config import FIXTURE_CONFIG, ForecastConfig
from panelcast.functions.calendar import calendar_columns, cyclic_encoding, shift_year_month
from panelcast.operators import panel as P
from panelcast.operators import features as FE

D = dt.date


def test_iso_week_with_calendar_year(spark):
    days = [D(2018, 12, 30), D(2018, 12, 31), D(2019, 1, 1), D(2016, 1, 1), D(2020, 12, 31)]
    df = calendar_columns(spark.createDataFrame([(d,) for d in days], "date date"))
    got = {r["date"]: (r["weekday"], r["week"], r["year_week"], r["weekday_week"], r["year_quarter"])
           for r in df.collect()}
    assert got[D(2018, 12, 30)] == (6, 52, "2018-52", "52-6", "2018Q4")
    assert got[D(2018, 12, 31)] == (0, 1, "2018-1", "1-0", "2018Q4")
    assert got[D(2019, 1, 1)] == (1, 1, "2019-1", "1-1", "2019Q1")
    assert got[D(2016, 1, 1)] == (4, 53, "2016-53", "53-4", "2016Q1")
    assert got[D(2020, 12, 31)] == (3, 53, "2020-53", "53-3", "2020Q4")
    iso = calendar_columns(spark.createDataFrame([(D(2018, 12, 31),)], "date date"), iso_year=True)
    assert iso.first()["year_week"] == "2019-1"


def test_shift_year_month_clips(spark):
    df = spark.createDataFrame([("2019-12",), ("2019-01",)], "ym string")
    got = sorted(r[0] for r in df.select(shift_year_month("ym")).collect())
    assert got == ["2019-02", "2020-01"]


def _panel(spark, rows):
    df = spark.createDataFrame(rows, "date date, hierarchy1_id string, storetype_id string, sales double")
    return calendar_columns(df)


def test_gap_aware_lag_is_zero_not_wrong_day(spark):
    rows = [(D(2019, 1, 1), "h", "s", 1.0), (D(2019, 1, 2), "h", "s", 2.0), (D(2019, 1, 4), "h", "s", 4.0)]
    out = FE.add_lag_features(_panel(spark, rows), lags=(1, 2, 3)).orderBy("date").collect()
    # 2019-01-04: 1 row back is 01-02 (2 days) -> lag1 = 0; 2 rows back is 01-01 (3 days) -> lag2 = 0
    assert out[2]["total_sales_last_1_days"] == 0.0
    assert out[2]["total_sales_last_2_days"] == 0.0
    assert out[1]["total_sales_last_1_days"] == 1.0
    assert out[0]["total_sales_last_1_days"] == 0.0  # no previous row: NULL lag, sum skips it


def test_positional_totals_14_equals_28(spark):
    rows = [(D(2019, 1, 1) + dt.timedelta(days=i), "h", "s", float(i + 1)) for i in range(40)]
    out = FE.add_lag_features(_panel(spark, rows)).orderBy("date").collect()[-1]
    assert out["total_sales_last_14_days"] == out["total_sales_last_28_days"]
    # lags 1..7, 14, 28 of day 40 -> values 39..33, 26, 12
    assert out["total_sales_last_28_days"] == sum(range(33, 40)) + 26 + 12
    cal = FE.add_lag_features(_panel(spark, rows), mode="calendar").orderBy("date").collect()[-1]
    assert cal["total_sales_last_28_days"] == sum(range(12, 40))


def test_null_key_dropped_and_all_null_sum_zero(spark):
    rows = [(D(2019, 1, 1), None, "s", 1.0), (D(2019, 1, 1), "h", "s", None), (D(2019, 1, 1), "h", "s", None)]
    df = spark.createDataFrame(rows, "date date, hierarchy1_id string, storetype_id string, sales double")
    out = P.daily_sums(df, D(2019, 1, 1), D(2019, 1, 1)).collect()
    assert len(out) == 1 and out[0]["sales"] == 0.0


def test_prior_year_zero_gives_null_ratio(spark):
    rows = [(D(2018, 3, 1), "h", "s", 0.0), (D(2019, 3, 1), "h", "s", 5.0), (D(2019, 3, 2), "h", "s", 5.0)]
    p = _panel(spark, rows)
    x = p.withColumns(FE.prior_year_columns()).withColumns(FE.to_date_columns()).withColumns(FE.ratio_columns())
    r = x.where("date = '2019-03-02'").first()
    assert r["avg_same_month_sales"] == 0.0
    assert r["month_sales_to_date"] == 5.0
    assert r["percentage_sold_of_month"] is None
    first = x.where("date = '2018-03-01'").first()
    assert first["avg_same_month_sales"] is None


def test_to_date_null_own_sales(spark):
    rows = [(D(2019, 3, 1), "h", "s", 2.0), (D(2019, 3, 2), "h", "s", None), (D(2019, 3, 3), "h", "s", 3.0)]
    x = _panel(spark, rows).withColumns(FE.to_date_columns()).orderBy("date").collect()
    assert [r["month_sales_to_date"] for r in x] == [0.0, None, 2.0]


def _cfg():
    return ForecastConfig(train_start="2019-01-01", train_end="2019-01-10", test_start="2019-01-11",
                          test_end="2019-01-12", prediction_start="2019-01-13", prediction_end="2019-01-14")


def test_zero_fill_both_branches(spark):
    cfg = _cfg()
    schema = "date date, hierarchy1_id string, storetype_id string, sales double"
    test = spark.createDataFrame([(D(2019, 1, 11), "a", "s", 1.0), (D(2019, 1, 11), "b", "s", 1.0)], schema)
    # actuals exist for group a only: b is dropped, a's gap filled with 0
    data = test.unionByName(spark.createDataFrame([(D(2019, 1, 13), "a", "s", 3.0)], schema))
    out = P.prediction_frame(data, test, cfg).orderBy("date").collect()
    assert [(r["hierarchy1_id"], r["sales"]) for r in out] == [("a", 3.0), ("a", 0.0)]
    # no actuals at all: every group kept, target NULL
    out2 = P.prediction_frame(test, test, cfg).collect()
    assert len(out2) == 4 and all(r["sales"] is None for r in out2)


def test_completeness_report(spark):
    cfg = _cfg()
    schema = "date date, hierarchy1_id string, storetype_id string, sales double"
    df = spark.createDataFrame([(D(2019, 1, 13), "a", "s", 1.0), (D(2019, 1, 14), "a", "s", 1.0),
                                (D(2019, 1, 13), "b", "s", 1.0)], schema)
    groups = P.distinct_groups(df)
    r = P.completeness_report(df, cfg.horizon, groups).first()
    assert (r["n_rows"], r["n_groups"], r["expected_rows"], r["complete"]) == (3, 2, 4, False)
    assert P.group_gap_report(df, cfg.horizon, groups).first()["hierarchy1_id"] == "b"


def test_shares_null_value_and_zero_total(spark):
    schema = "year_month string, hierarchy1_id string, storetype_id string, sales double, promo_bin_1 string"
    df = spark.createDataFrame([("2019-01", "h", "s", 2.0, None), ("2019-01", "h", "s", 6.0, "O"),
                                ("2019-02", "h", "s", 0.0, "O"), ("2019-02", "h", "s", 0.0, "F")], schema)
    wide = FE.categorical_features(df, ["promo_bin_1"]).orderBy("year_month").collect()
    assert wide[0]["year_month"] == "2019-02"
    assert wide[0]["nan_promo_bin_1"] == 0.25 and wide[0]["O_promo_bin_1"] == 0.75
    assert wide[1]["year_month"] == "2019-03"
    assert wide[1]["O_promo_bin_1"] == 0.0 and wide[1]["F_promo_bin_1"] == 0.0


def test_cyclic_manual_and_auto(spark):
    df = calendar_columns(spark.createDataFrame([(D(2019, 1, 7),), (D(2019, 1, 13),)], "date date"))
    auto = cyclic_encoding(df, "auto").orderBy("date").collect()
    assert "quarter" not in auto[0].asDict()
    # auto: max weekday observed is 6, so Sunday (6) and Monday (0) coincide (quirk Q6)
    assert abs(auto[0]["weekday_sin"] - auto[1]["weekday_sin"]) < 1e-12
    man = cyclic_encoding(df, "manual").orderBy("date").collect()
    assert abs(man[1]["weekday_cos"] - __import__("math").cos(2 * __import__("math").pi * 6 / 7)) < 1e-12


def test_config_validation():
    import pytest
    with pytest.raises(ValueError):
        FIXTURE_CONFIG.with_dates(test_start=FIXTURE_CONFIG.train_end).validate()


def test_lookup_by_key_raises_on_missing_key(spark):
    import pytest
    schema = "date date, hierarchy1_id string, storetype_id string"
    rows = spark.createDataFrame([(D(2019, 1, 1), "h", "s"), (D(2019, 1, 2), "h", "s")], schema)
    feat = spark.createDataFrame([(D(2019, 1, 1), "h", "s", 1.5)], schema + ", fb_feature double")
    out = FE.attach_feature_by_key(rows, feat, "fb_feature").orderBy("date").collect()
    assert [r["fb_feature"] for r in out] == [1.5, None]
    with pytest.raises(KeyError):
        FE.attach_feature_by_key(rows, feat, "fb_feature", check=True)


def test_assert_complete_raises(spark):
    import pytest
    schema = "date date, hierarchy1_id string, storetype_id string, sales double"
    df = spark.createDataFrame([(D(2019, 1, 13), "a", "s", 1.0), (D(2019, 1, 13), "b", "s", 1.0)], schema)
    groups = P.distinct_groups(df)
    with pytest.raises(RuntimeError, match="expected 4 rows of 2 groups, received 2 of 2"):
        P.assert_complete(df, 2, "recursive predictions", groups)
    P.assert_complete(df, 1, "recursive predictions", groups)
    # a group that is wholly missing, or one that nobody expects, is an error too
    with pytest.raises(RuntimeError, match="expected 2 rows of 2 groups, received 1 of 1"):
        P.assert_complete(df.where("hierarchy1_id = 'a'"), 1, "blended predictions", groups)
    with pytest.raises(RuntimeError):
        P.assert_complete(df, 1, "blended predictions", groups.where("hierarchy1_id = 'a'"))
    gap = P.group_gap_report(df.where("hierarchy1_id = 'a'"), 1, groups).collect()
    assert [(r["hierarchy1_id"], r["n_rows"]) for r in gap] == [("b", 0)]
