"""Prediction and backtest-result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREDICTION_COLUMNS = ("date", "hierarchy1_id", "storetype_id", "sales", "lgb_predicted")


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Keep the five output columns; write a directory of part files."""
    out = df.select(*PREDICTION_COLUMNS)
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def append_results(df: DataFrame, path: str) -> None:
    """Append one fold's results; partitioned by period so re-runs of a fold
    replace only that fold (dynamic partition overwrite)."""
    (df.withColumn("prediction_period", F.col("prediction_period").cast("date"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("prediction_period").parquet(path))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("date", F.to_date("date"))
