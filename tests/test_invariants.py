"""Invariants from the test strategy, on the smallest supplied tables."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from conftest import SF0001
from panelcast.config import FIXTURE_CONFIG as C
from panelcast.operators import panel as P
from panelcast.operators import features as FE
from panelcast.sources import narrow as NR
from panelcast.sources.tables import joined_sales

K = ["hierarchy1_id", "storetype_id"]


def _data(spark):
    return P.prepare_data(joined_sales(spark, SF0001, C.train_start, C.prediction_end), C)


def test_panel_sum_equals_raw_sum(spark):
    data = _data(spark)
    panel = P.build_panel(data, C)
    hist = P.filter_date_range(panel, C.train_start, C.test_end).agg(F.sum("sales")).first()[0]
    raw = P.filter_date_range(data, C.train_start, C.test_end).agg(F.sum("sales")).first()[0]
    assert hist == raw
    # one row per (date, K)
    assert panel.count() == panel.select("date", *K).distinct().count()


def test_shares_sum_to_one_or_zero(spark):
    long = FE.share_long(_data(spark))
    tot = long.groupBy("year_month", *K, "feature").agg(F.sum("share").alias("t"))
    assert tot.where((F.abs(F.col("t") - 1) > 1e-9) & (F.col("t") != 0)).count() == 0


def test_to_date_non_decreasing_within_period(spark):
    panel = P.build_panel(_data(spark), C)
    x = panel.withColumns(FE.to_date_columns())
    w = Window.partitionBy(*K, "year_month").orderBy("date")
    bad = x.withColumn("prev", F.lag("month_sales_to_date").over(w)) \
           .where(F.col("month_sales_to_date") < F.col("prev")).count()
    assert bad == 0


def test_monthly_features_use_previous_month_only(spark):
    data = _data(spark)
    prod = FE.product_features(data)
    months = data.select("year_month").distinct()
    first = months.agg(F.min("year_month")).first()[0]
    # the first month of data has no previous month, so nothing is attached to it
    assert prod.where(F.col("year_month") == first).count() == 0
    nxt = FE.categorical_features(data).agg(F.min("year_month")).first()[0]
    assert nxt > first


def test_narrowing_rules(spark):
    df = spark.createDataFrame(
        [(1, 300, 1.0, 1.5, 70000.0, None), (2, -5, 2.0, 2.25, 1.0, 1.0), (3, 7, 3.0, 3.125, 2.0, 2.0)],
        "a long, b long, c double, d double, e double, f double")
    dec = {r["column_name"]: r["chosen_type"] for r in NR.choose_types(NR.narrowing_stats(df)).collect()}
    assert dec["a"] == "int8"            # fits in int8
    assert dec["b"] == "int16"           # 300 does not fit int8 (no silent wrap)
    assert dec["c"] == "int8"            # integral floats round exactly
    assert dec["d"] == "float16"         # exactly representable in half precision
    assert dec["e"] == "int32"           # 70000 overflows float16 and int16
    assert dec["f"] == "float16"         # NULLs: only float candidates
    narrowed, _ = NR.narrow_schema(df)
    types = dict(narrowed.dtypes)
    assert types["a"] == "tinyint" and types["b"] == "smallint" and types["f"] == "float"


def test_category_codes_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "x string")
    codes = {r["value"]: r["code"] for r in NR.category_codes(df, "x").collect()}
    assert codes == {"a": 0, "b": 1, "c": 2}
    prof = {r["column_name"]: (r["n_null"], r["n_distinct"]) for r in NR.column_profile(df).collect()}
    assert prof["x"] == (1, 4)
