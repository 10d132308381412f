import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from panelcast.operators import prep as PR
from panelcast.operators import backtest as BT
from panelcast.operators import baselines as BL
from panelcast.operators import metrics as M
from panelcast.operators import models as MO

D = dt.date


def test_contiguous_folds_8_rows_3_folds(spark):
    rows = [("h", "s", D(2019, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(5)] + \
           [("h", "t", D(2019, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "hierarchy1_id string, storetype_id string, date date, sales double")
    f = PR.contiguous_folds(df, 3).orderBy("hierarchy1_id", "storetype_id", "date").collect()
    assert [r["fold"] for r in f] == [0, 0, 0, 1, 1, 1, 2, 2]


def test_group_offsets_many_buckets(spark):
    keys = spark.range(1000).select(F.format_string("k%04d", "id").alias("k"), F.lit(2).alias("__n"))
    offs = PR.group_offsets(keys, ["k"], buckets=7).orderBy("k").collect()
    assert [r["__offset"] for r in offs] == [2 * i for i in range(1000)]


def test_target_encoding_prior_fallbacks(spark):
    # category 'x' lies wholly in fold 0: its fold-0 encoder never saw it -> prior
    rows = [("x", "s", D(2019, 1, 1) + dt.timedelta(days=i), 10.0) for i in range(3)] + \
           [("y", "s", D(2019, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "hierarchy1_id string, storetype_id string, date date, sales double")
    other = spark.createDataFrame([("z", "s", D(2019, 2, 1), 0.0), ("x", "s", D(2019, 2, 1), 0.0)],
                                  "hierarchy1_id string, storetype_id string, date date, sales double")
    tr, oth, _ = PR.target_encode_oof(df, {"o": other}, ["hierarchy1_id"], "sales", 3)
    t = {(r["hierarchy1_id"], r["fold"]): r["hierarchy1_id_tenc"] for r in tr.collect()}
    assert t[("x", 0)] == 1.0                 # prior of rows outside fold 0: all 'y' = 1.0
    # fold 1 encoder: x seen 3 times (sum 30) and prior = mean of folds 0+2 = (30+3)/6
    assert abs(t[("y", 1)] - (3.0 + 5.5) / 4.0) < 1e-12
    o = {r["hierarchy1_id"]: r["hierarchy1_id_tenc"] for r in oth["o"].collect()}
    priors = [1.0, (30 + 3) / 6.0, (30 + 3) / 6.0]
    assert abs(o["z"] - sum(priors) / 3) < 1e-12   # unseen everywhere -> mean prior


def test_sample_weight(spark):
    df = spark.createDataFrame([(1999, 5), (2000, 6), (2001, 1), (None, 6), (2001, None)], "year int, month int")
    w = [r[0] for r in df.select(PR.sample_weight(2000, 7)).collect()]
    assert w == [0.25, 1.25, 1.0, 1.25, 1.0]


def test_backtest_fold_dates(spark):
    f = BT.backtest_folds(spark, D(2019, 6, 30), D(2019, 9, 30), D(2017, 1, 1)).orderBy("prediction_end").collect()
    ends = {r["prediction_end"]: r for r in f}
    assert ends[D(2019, 6, 30)]["prediction_start"] == D(2019, 5, 31)
    assert ends[D(2019, 9, 30)]["prediction_start"] == D(2019, 8, 31)
    assert ends[D(2019, 6, 30)]["test_start"] == D(2019, 5, 1)
    assert BT.validate_folds(BT.backtest_folds(spark, D(2019, 6, 30), D(2019, 9, 30), D(2017, 1, 1))).count() == 0


def test_scoring_rules(spark):
    df = spark.createDataFrame([(D(2019, 1, 1), "a", "s", 99.0, 100.0), (D(2019, 1, 1), "b", "s", 0.0, 5.0)],
                               "date date, hierarchy1_id string, storetype_id string, sales double, p double")
    w = {r["hierarchy1_id"]: r["weight"] for r in M.day_share_weight(df, min_share=None).collect()}
    assert w == {"a": 0.99, "b": 0.0}
    assert M.day_share_weight(df).count() == 1
    m = M.mape(df, "sales", "p").first()[0]
    assert abs(m - (1 / 100 + 5 / 1) / 2 * 100) < 1e-9
    amse = M.asymmetric_mse(df, "sales", "p").first()[0]
    assert abs(amse - ((0.9 * 1) ** 2 + (0.9 * 5) ** 2) / 2) < 1e-9
    r = M.score_by(spark.createDataFrame([("a", 0.25), ("a", 0.0)], "k string, x double"), ["k"], ["x"], 1).first()
    assert r["x"] == 0.1
    # 0.35 * 10 == 3.5 in doubles -> half-even -> 0.4 (numpy); bround would give 0.3
    r = M.score_by(spark.createDataFrame([("a", 0.35)], "k string, x double"), ["k"], ["x"], 1).first()
    assert r["x"] == 0.4


def test_tree_export_matches_mllib(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor
    import numpy as np
    from recursion_reference import export_ensemble, predict
    df = spark.range(400).select(
        array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") * 0.37 % 5).cast("double"),
                                F.lit(-1.0))).alias("features"),
        ((F.col("id") % 7) * 1.5 + F.rand(3)).alias("label"))
    m = GBTRegressor(maxIter=4, maxDepth=3, seed=1).fit(df)
    got = m.transform(df).select("features", "prediction").collect()
    X = np.array([r["features"].toArray() for r in got])
    ours = predict(export_ensemble(m), X)
    assert np.allclose(ours, [r["prediction"] for r in got], rtol=0, atol=1e-9)


def test_group_offsets_without_exchange_reuse(spark):
    """Both uses of the range partitions must see the same partitions."""
    from pyspark.sql import functions as F
    from panelcast.operators import prep as PR
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        keys = spark.range(150_000).select(F.xxhash64("id").alias("k"), F.lit(1).alias("__n"))
        offs = PR.group_offsets(keys, ["k"], buckets=7)
        rows = [r["__offset"] for r in offs.orderBy("k").select("__offset").collect()]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
    assert rows == list(range(150_000))


def test_pivot_names_with_any_signs(spark):
    import datetime as dt
    from panelcast.operators.features import pivot_shares
    rows = [(dt.date(2020, 1, 1), "a", "b", v, 1.0) for v in ("16.0", "x`y", "two words", "p,q")]
    df = spark.createDataFrame(rows, "year_month date, hierarchy1_id string, storetype_id string, promo string, sales double")
    out = pivot_shares(df, "promo").collect()
    assert len(out) == 1
    assert all(abs(out[0][v] - 0.25) < 1e-12 for v in ("16.0", "x`y", "two words", "p,q"))


def test_train_columns_keep_frame_order():
    assert PR.train_columns(["date", "b", "sales", "a"], ["sales", "date", "absent"]) == ["b", "a"]


def test_feature_importance_ranks_and_breaks_ties_by_name(spark):
    class Fitted:
        class featureImportances:
            @staticmethod
            def toArray():
                return np.array([0.25, 0.5, 0.25, 0.0])

    rows = MO.feature_importance(Fitted, ["z", "m", "a", "n"], top=3).orderBy("rank").collect()
    assert [tuple(r) for r in rows] == [(1, "m", 0.5), (2, "a", 0.25), (3, "z", 0.25)]


def test_ridge_trend_against_brute_force(spark):
    start, days = D(2019, 1, 1), 60
    end = start + dt.timedelta(days=days - 1)
    y = {"t": [5 + 0.3 * i + (i % 7) for i in range(days)], "u": [40 - 0.2 * i for i in range(days)],
         "bad": [float("nan")] * days, "zero": [0.0] * days}
    schema = "hierarchy1_id string, storetype_id string, date date, sales double"
    hist = spark.createDataFrame([("h", k, start + dt.timedelta(days=i), v) for k, vs in y.items()
                                  for i, v in enumerate(vs)], schema)
    ahead = [end + dt.timedelta(days=i) for i in range(1, 8)]
    target = spark.createDataFrame([("h", k, d, None) for k in [*y, "new"] for d in ahead], schema)
    got = {(r["storetype_id"], r["date"]): r["predicted_fbprophet"]
           for r in BL.ridge_trend_forecast(hist, target, start, end).collect()}
    assert len(got) == 5 * 7
    assert all(got[k, d] is None for k in ("bad", "new") for d in ahead)   # NULL, never NaN
    assert all(got["zero", d] == 0.0 for d in ahead)

    every = [start + dt.timedelta(days=i) for i in range(days)] + ahead
    frame = spark.createDataFrame([(d,) for d in every], "date date")
    X = np.array([list(r)[1:] for r in frame.select("date", *BL._design_exprs(start, float((end - start).days)))
                  .orderBy("date").collect()], float)
    penalty = np.full(X.shape[1], 1e-6)
    penalty[2:2 + BL.N_CHANGEPOINTS] = 10.0
    for k in ("t", "u"):
        fit = X[:days]
        # the same minimum as a least-squares problem with the penalty as extra rows
        rows = np.vstack([fit, np.diag(np.sqrt(penalty * days))])
        beta = np.linalg.lstsq(rows, np.concatenate([y[k], np.zeros(len(penalty))]), rcond=None)[0]
        for d, v in zip(ahead, X[days:] @ beta):
            assert abs(got[k, d] - max(v, 0.0)) < 1e-4 * max(1, abs(v))
