"""From three CSV folders to a forecast, with bad rows set aside."""

from dataclasses import replace

from pyspark.sql import functions as F

from conftest import SF0001


def _write(df, path, bad_lines):
    df.write.option("header", True).csv(path)
    with open(f"{path}/part-bad.csv", "w") as f:
        f.write(",".join(df.columns) + "\n" + "".join(line + "\n" for line in bad_lines))


def test_forecast_from_csv_equals_tables(spark, tmp_path):
    from panelcast.config import FIXTURE_CONFIG
    from panelcast.plans.forecast import forecast_from_csv, forecast_tables
    from panelcast.sources.tables import sales_df, stores_df, taxonomy_df
    cfg = replace(FIXTURE_CONFIG, gbt_max_iter=2)
    paths = {n: str(tmp_path / n) for n in ("sales", "taxonomy", "stores")}
    n = len(sales_df(spark, SF0001).columns)
    _write(sales_df(spark, SF0001), paths["sales"], ["not a date,1,1,5.0" + "," * (n - 4), "1997-02-03,1,1,many" + "," * (n - 4), "1997-02-03,1"])
    _write(taxonomy_df(spark, SF0001), paths["taxonomy"], ["x1,MEDIUM,Brand#1,1.0,1.0,1.0"])
    _write(stores_df(spark, SF0001), paths["stores"], [])
    run, rejected = forecast_from_csv(spark, *(paths[n] for n in ("sales", "taxonomy", "stores")), cfg, narrow=False)
    bad = {r["input"]: r["n"] for r in rejected.groupBy("input").agg(F.count("*").alias("n")).collect()}
    assert bad == {"sales": 3, "taxonomy": 1}
    assert all("part-bad" in r["file"] and r["record"] for r in rejected.collect())
    want = forecast_tables(spark, SF0001, cfg).merged.toPandas()
    got = run.merged.toPandas()
    j = got.merge(want, on=["date", "hierarchy1_id", "storetype_id"], suffixes=("", "_t"))
    assert len(j) == len(got) == len(want) > 0
    for c in ("sales", "lgb_predicted", "predicted_seasonal_average"):
        assert (j[c] - j[c + "_t"]).abs().max() < 1e-6


def test_narrowed_ingest(spark, tmp_path):
    from panelcast.sources.files import SCHEMAS, ingest_csv
    from panelcast.sources.tables import taxonomy_df
    path = str(tmp_path / "t")
    _write(taxonomy_df(spark, SF0001), path, [])
    got = ingest_csv(spark, path, SCHEMAS["taxonomy"], narrow=True)
    kinds = dict(got.rows.dtypes)
    assert kinds["product_length"] == "tinyint" and kinds["product_id"] in ("tinyint", "smallint", "float")
    assert got.rejected.count() == 0 and got.decisions.count() == 4
    assert got.rows.agg(F.sum("product_length")).first()[0] == taxonomy_df(spark, SF0001).agg(F.sum("product_length")).first()[0]


def test_profile_and_narrowing_expand_no_rows(spark):
    """Distinct counts come from the value-frequency table, not from Expand."""
    from panelcast.sources import narrow as NR
    from panelcast.sources.tables import sales_df
    df = sales_df(spark, SF0001)
    for out in (NR.column_profile(df), NR.narrowing_stats(df)):
        assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_narrowing_counts_the_rows_once(spark):
    """All statistics read one exchange of counted values, whose keys hold no column names."""
    from panelcast.sources import narrow as NR
    df = spark.createDataFrame([(1, 0.5), (1, None), (2, 0.25), (2, 1e-9)], "a long, b double")
    out = NR.narrowing_stats(df)
    got = {r["column_name"]: (r["n_rows"], r["n_null"], r["n_distinct"], r["int_distinct"], r["f16_distinct"], r["f32_distinct"]) for r in out.collect()}
    assert got == {"a": (4, 0, 2, 2, 2, 2), "b": (4, 1, 4, 2, 4, 4)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "posexplode" in plan
