"""Schema narrowing, column profile, category codes.

Statistics come from a value-frequency table (column, value, n): the frame is
unpivoted and counted with map-side combine, once for all columns, and every
null count, distinct count, range and conversion loss is taken from that
table. Nothing is counted distinct on the frame itself, so its rows are never
expanded per distinct aggregate. The decision table has one row per column
(bounded by the schema), and only that table reaches the driver when the casts
are applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference's narrowing rule.
INT_RANGES = {"int8": (-128, 127), "int16": (-32768, 32767), "int32": (-2147483648, 2147483647)}
CANDIDATES_NO_NULL = ("int8", "int16", "float16", "int32", "float32")
CANDIDATES_WITH_NULL = ("float16", "float32")
SPARK_TYPE = {"int8": "tinyint", "int16": "smallint", "int32": "int", "float16": "float", "float32": "float"}

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def float16_round(x: Column) -> Column:
    """Value of x after a round trip through IEEE half precision (half-even
    rounding, subnormals below 2^-14, +/-inf from 65520 up)."""
    a = F.abs(x)
    e0 = F.floor(F.log2(a))
    e = (F.when(F.pow(F.lit(2.0), e0) > a, e0 - 1)
          .when(F.pow(F.lit(2.0), e0 + 1) <= a, e0 + 1).otherwise(e0))
    q = F.pow(F.lit(2.0), F.greatest(e, F.lit(-14)) - 10)
    r = F.bround(a / q, 0) * q
    r = F.when(a >= 65520, F.lit(float("inf"))).when(a == 0, F.lit(0.0)).otherwise(r)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.signum(x) * r)


def _numeric_columns(df: DataFrame, columns=None) -> list[tuple[str, bool]]:
    out = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        if isinstance(f.dataType, NUMERIC):
            out.append((f.name, isinstance(f.dataType, (T.FloatType, T.DoubleType))))
    return out


def value_frequencies(df: DataFrame, columns, kind: str) -> DataFrame:
    """(column_name, value, n): how often every value of every column occurs,
    NULL included. ``kind`` is the type all values are cast to. Columns are
    counted by their place, which makes shorter keys than their names."""
    columns = list(columns)
    values = F.array(*[F.col("`" + c.replace("`", "``") + "`").cast(kind) for c in columns])
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("pos") + 1)
    return (df.select(F.posexplode(values).alias("pos", "value"))
              .groupBy("pos", "value").agg(F.count(F.lit(1)).alias("n"))
              .select(name.alias("column_name"), "value", "n"))


def narrowing_stats(df: DataFrame, columns=None) -> DataFrame:
    """One row per numeric column: null count, distinct count (NULL counted as
    a value), min/max, and per candidate type the max/mean absolute loss and
    the distinct-count loss of the conversion."""
    cols = _numeric_columns(df, columns)
    if not cols:
        raise ValueError("no numeric columns")
    freq = value_frequencies(df, [c for c, _ in cols], "double")
    x, is_float = F.col("value"), F.col("column_name").isin([c for c, f in cols if f])
    freq = freq.withColumns({
        "is_float": is_float,
        "int": F.when(is_float, F.round(F.coalesce(x, F.lit(0.0)))).otherwise(x),
        "f16": float16_round(x), "f32": x.cast("float").cast("double")})
    kinds = ("int", "f16", "f32")
    losses = []
    for c in kinds:
        loss = F.abs(F.col(c) - x)
        losses += [F.max(loss).alias(f"{c}_max_loss"),
                   F.try_divide(F.sum(loss * F.col("n")), F.sum(F.when(x.isNotNull(), F.col("n")))).alias(f"{c}_avg_loss")]
    one = freq.groupBy("column_name", "is_float").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(x.isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count(F.lit(1)).alias("n_distinct"), F.min(x).alias("min_value"), F.max(x).alias("max_value"),
        F.min("int").alias("int_min"), F.max("int").alias("int_max"), *losses)
    # distinct values after each conversion, counted over the values, not over the rows
    # (``n`` keeps the frequencies the same rows here and above, so both read one exchange)
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("v")) for c in kinds])
    changed = (freq.select("column_name", "n", F.explode(pairs).alias("p")).select("column_name", "n", "p.*")
                   .groupBy("column_name", "kind", "v").agg(F.max("n").alias("n"))
                   .groupBy("column_name").agg(
                       F.count(F.when((F.col("kind") == "int") & F.col("v").isNotNull(), F.col("n"))).alias("int_distinct"),
                       *[F.count(F.when(F.col("kind") == c, F.col("n"))).alias(f"{c}_distinct") for c in ("f16", "f32")]))
    return one.join(changed, "column_name")


def choose_types(stats: DataFrame, max_loss: float = 0.001, avg_loss: float = 0.001,
                 na_loss: int = 0, n_uniq_loss: int = 0) -> DataFrame:
    """The first candidate within every loss limit; NULL keeps the type.
    Integer candidates need no NULLs and a value range that fits (checked
    from min/max instead of cast-and-compare, which would wrap silently)."""
    c = F.col
    no_null = c("n_null") <= na_loss

    def int_ok(t):
        lo, hi = INT_RANGES[t]
        return (no_null & (c("int_min") >= lo) & (c("int_max") <= hi)
                & (c("int_max_loss") <= max_loss) & (c("int_avg_loss") <= avg_loss)
                & (F.abs(c("n_distinct") - c("int_distinct")) <= n_uniq_loss))

    def float_ok(p):
        return ((c(f"{p}_max_loss") <= max_loss) & (c(f"{p}_avg_loss") <= avg_loss)
                & (F.abs(c("n_distinct") - c(f"{p}_distinct")) <= n_uniq_loss))

    chosen = (F.when(int_ok("int8"), "int8").when(int_ok("int16"), "int16")
               .when(float_ok("f16"), "float16").when(int_ok("int32"), "int32")
               .when(float_ok("f32"), "float32"))
    return stats.withColumn("chosen_type", chosen)


def narrow_schema(df: DataFrame, **limits) -> tuple[DataFrame, DataFrame]:
    """Apply the chosen casts; returns (narrowed frame, decision table)."""
    dec = choose_types(narrowing_stats(df), **limits)
    rows = dec.select("column_name", "chosen_type", "is_float").collect()  # one row per column
    casts = {}
    for r in rows:
        if r["chosen_type"]:
            x = F.col(f"`{r['column_name']}`")
            if r["is_float"] and r["chosen_type"].startswith("int"):
                x = F.round(F.coalesce(x, F.lit(0.0)))
            casts[r["column_name"]] = x.cast(SPARK_TYPE[r["chosen_type"]])
    return df.withColumns(casts), dec


def column_profile(df: DataFrame) -> DataFrame:
    """Per column, NULL count and distinct count with NULL as a value."""
    freq = value_frequencies(df, df.columns, "string")
    return freq.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count(F.lit(1)).alias("n_distinct"))


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Dictionary codes 0..n-1 in sorted value order (NULL excluded), with
    the global rank computed by range partitions, not one sorted task."""
    from panelcast.operators.prep import group_offsets
    vals = df.select(F.col(f"`{column}`").alias("value")).where(F.col("value").isNotNull()).distinct() \
             .withColumn("__n", F.lit(1))
    offs = group_offsets(vals, ["value"])
    return offs.select(F.lit(column).alias("column_name"), "value", F.col("__offset").cast("int").alias("code"))


def encode_category(df: DataFrame, column: str) -> DataFrame:
    codes = category_codes(df, column).select(F.col("value").alias(column), F.col("code").alias(f"{column}_code"))
    return df.join(codes, column, "left")
