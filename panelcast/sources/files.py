"""File scans with a declared schema and an optional row limit, and the
ingestion of typed CSV files with their unreadable rows set aside."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import ensure_checkpoint_dir

# Declared schemas of the reference's three input files (inferred from use).
SALES_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("store_id", T.LongType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("promo_type_1", T.StringType()),
    T.StructField("promo_bin_1", T.StringType()),
    T.StructField("promo_type_2", T.StringType()),
    T.StructField("promo_bin_2", T.StringType()),
    T.StructField("promo_discount_2", T.StringType()),
    T.StructField("promo_discount_type_2", T.StringType()),
])
TAXONOMY_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("hierarchy1_id", T.StringType()),
    T.StructField("cluster_id", T.StringType()),
    T.StructField("product_length", T.DoubleType()),
    T.StructField("product_depth", T.DoubleType()),
    T.StructField("product_width", T.DoubleType()),
])
STORES_SCHEMA = T.StructType([
    T.StructField("store_id", T.LongType()),
    T.StructField("storetype_id", T.StringType()),
    T.StructField("city_id", T.StringType()),
    T.StructField("store_size", T.DoubleType()),
])
SCHEMAS = {"sales": SALES_SCHEMA, "taxonomy": TAXONOMY_SCHEMA, "stores": STORES_SCHEMA}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             nrows: int | None = None) -> DataFrame:
    """CSV with header. A declared schema avoids the extra inference pass;
    without one Spark infers types (one extra scan), like the reference."""
    r = spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd")
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    return df.limit(nrows) if nrows is not None else df


def read_input(spark: SparkSession, path: str, schema=None, nrows: int | None = None) -> DataFrame:
    """Parquet or CSV by extension."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema, nrows)
    df = spark.read.parquet(path)
    return df.limit(nrows) if nrows is not None else df


@dataclass
class Ingested:
    rows: DataFrame         # readable rows, in the declared schema
    rejected: DataFrame     # file, record: rows with a field that is no value of its column
    decisions: DataFrame | None = None      # the narrow types chosen, if asked for


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType, narrow: bool = False,
               store: str | None = None) -> Ingested:
    """Parse a CSV folder once and keep it as Parquet, good and bad rows apart.

    A field that does not parse, or a row with too few or too many fields, puts
    the whole line into ``rejected``; nothing is dropped in silence. The text
    is read one time: both tables and the narrowing (O02) start from the
    Parquet written below ``store`` (default: the checkpoint folder).
    """
    names = [f.name for f in schema.fields]
    record, bad = "__record", "__bad"
    wide = T.StructType([*schema.fields, T.StructField(record, T.StringType())])
    read = (spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", record).schema(wide).csv(path))
    target = store or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    (read.select(*names, record, F.input_file_name().alias("__file"), F.col(record).isNotNull().alias(bad))
         .write.partitionBy(bad).parquet(target))
    stored = spark.read.schema(T.StructType([*wide.fields, T.StructField("__file", T.StringType()),
                                             T.StructField(bad, T.BooleanType())])).parquet(target)
    rows = stored.where(~F.col(bad)).select(*names)
    rejected = stored.where(F.col(bad)).select(F.col("__file").alias("file"), F.col(record).alias("record"))
    if not narrow:
        return Ingested(rows, rejected)
    from panelcast.sources.narrow import narrow_schema
    rows, decisions = narrow_schema(rows)
    return Ingested(rows, rejected, decisions)
