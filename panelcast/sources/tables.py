"""Fact and dimension views built from the supplied TPC-H-style tables.

The mapping (FIXTURES.md section 2) turns `lineitem` into the `sales` fact,
`part` into the product `taxonomy` and `supplier`/`nation`/`region` into
`stores`. The same mapping is written as SQL in ``panelcast.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_df(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
             end: dt.date | None = None) -> DataFrame:
    """Sales fact. Optional date bounds are applied to the raw ship timestamp,
    so Parquet row groups outside the range are skipped (pushed filter)."""
    li = read_table(spark, sf_dir, "lineitem")
    if start is not None:
        li = li.where(F.col("l_shipdate") >= F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz"))
    if end is not None:
        nxt = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
        li = li.where(F.col("l_shipdate") < F.lit(nxt).cast("timestamp_ntz"))
    disc = F.col("l_discount")
    return li.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").alias("sales"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_returnflag").alias("promo_type_1"),
        F.col("l_linestatus").alias("promo_bin_1"),
        F.col("l_linenumber").cast("string").alias("promo_type_2"),
        F.when(disc < 0.035, "low").when(disc < 0.075, "mid").otherwise("high").alias("promo_bin_2"),
        F.round(disc * 100).cast("int").cast("string").alias("promo_discount_2"),
        F.when(F.col("l_tax") < 0.045, "A").otherwise("B").alias("promo_discount_type_2"),
    )


def taxonomy_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("hierarchy1_id"),
        F.col("p_brand").alias("cluster_id"),
        F.col("p_size").cast("double").alias("product_length"),
        (F.col("p_size") % 7 + 1).cast("double").alias("product_depth"),
        (F.col("p_size") % 11 + 1).cast("double").alias("product_width"),
    )


def stores_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey)
             .select(F.col("s_suppkey").alias("store_id"),
                     F.col("r_name").alias("storetype_id"),
                     F.col("n_name").alias("city_id"),
                     F.col("s_acctbal").alias("store_size")))


def joined_sales(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """O07 on the fixture tables: sales x taxonomy x stores (inner)."""
    from panelcast.operators.panel import star_join
    return star_join(sales_df(spark, sf_dir, start, end), taxonomy_df(spark, sf_dir),
                     stores_df(spark, sf_dir))
