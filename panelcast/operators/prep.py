"""Model preparation: train columns (O16), sample weights (O39), out-of-fold
target encoding (O40), ordered positions without a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.config import ForecastConfig, KEYS
from panelcast.session import cut_lineage


def train_columns(columns, except_cols) -> list[str]:
    """Every column except the excluded ones, in frame order. Must be
    taken before model-only columns are added (reference quirk Q10)."""
    ex = set(except_cols)
    return [c for c in columns if c not in ex]


def sample_weight(cutoff_year: int, prediction_month: int, year: str = "year", month: str = "month") -> Column:
    """0.25 before the cutoff year, else 1.0; plus 0.25 for months
    >= prediction month - 1; missing -> 1."""
    base = F.when(F.col(year) < cutoff_year, F.lit(0.25)).otherwise(F.lit(1.0))
    bonus = F.when(F.col(month).isNull(), F.lit(None).cast("double")) \
             .when(F.col(month) >= prediction_month - 1, F.lit(0.25)).otherwise(F.lit(0.0))
    return F.coalesce(base + bonus, F.lit(1.0))


# ---------------------------------------------------------------- ordered positions
def group_offsets(sizes: DataFrame, keys, n_col: str = "__n", buckets: int | None = None) -> DataFrame:
    """Exclusive prefix sum of `n_col` over rows ordered by `keys`, without
    moving the table into one task: range-partition by the keys, total each
    range partition (one row per partition, a bounded table), prefix-sum those
    totals, and add the running sum inside each range partition. The dealt
    table is written once before its partition numbers are read twice: two
    evaluations could sample different range bounds."""
    spark = sizes.sparkSession
    nb = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    b = cut_lineage(sizes.repartitionByRange(nb, *keys).withColumn("__b", F.spark_partition_id()))
    bt = b.groupBy("__b").agg(F.sum(n_col).alias("__bn"))
    bo = bt.withColumn("__boff", F.coalesce(F.sum("__bn").over(
        Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = F.coalesce(F.sum(n_col).over(
        Window.partitionBy("__b").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (b.withColumn("__ioff", inner)
             .join(F.broadcast(bo.select("__b", "__boff")), "__b")
             .select(*keys, n_col, (F.col("__boff") + F.col("__ioff")).alias("__offset")))


def contiguous_folds(df: DataFrame, n_folds: int = 3, keys=KEYS, order: str = "date",
                     fold_col: str = "fold", by=()) -> DataFrame:
    """K-fold without shuffling over rows ordered by (keys, order): the first
    n mod k folds get one extra row (scikit-learn KFold). Position = offset of
    the group + row number inside the group. With ``by`` (some of the leading
    keys) every value of it is folded for itself."""
    by = list(by)
    k = by + [c for c in keys if c not in by]
    sizes = df.groupBy(*k).agg(F.count(F.lit(1)).alias("__n"))
    offs = group_offsets(sizes, k)
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))     # one row per group
    offs = offs.withColumns({"__total": F.sum("__n").over(whole), "__first": F.min("__offset").over(whole)}).drop("__n")
    w = Window.partitionBy(*k).orderBy(order)
    x = df.join(offs, k).withColumn("__pos", F.col("__offset") - F.col("__first") + F.row_number().over(w) - 1)
    q = F.floor(F.col("__total") / n_folds)
    m = F.col("__total") % n_folds
    big = m * (q + 1)
    fold = F.when(F.col("__pos") < big, F.floor(F.col("__pos") / (q + 1))) \
            .otherwise(m + F.floor(F.try_divide(F.col("__pos") - big, q)))
    return x.withColumn(fold_col, fold.cast("int")).drop("__offset", "__first", "__pos", "__total")


def hash_folds(df: DataFrame, n_folds: int = 3, keys=KEYS, order: str = "date", fold_col: str = "fold") -> DataFrame:
    """Folds by value: the MD5 of (keys, order) modulo ``n_folds``. No row needs
    a position, so nothing is counted, ordered or shuffled."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in [*keys, order]])
    return df.withColumn(fold_col, (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % n_folds).cast("int"))


# ---------------------------------------------------------------- O40
def encoder_statistics(tr: DataFrame, cols, target: str, n_folds: int, prior_weight: float = 1.0,
                       singleton_to_prior: bool = True, by=()) -> DataFrame:
    """The whole encoder as one table: (by, column, level, fold, enc).

    One unpivot and one map-side combined aggregate give (column, level, fold)
    sums; a row of the pseudo-column '' stands for all rows, whose sums outside
    a fold are its prior. Windows over that small table do the rest. Fold -1 is
    the mean of the folds' encoders, level NULL the prior (for unseen levels).
    """
    by, y = list(by), F.col(target)
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in cols] + \
            [F.struct(F.lit("").alias("column"), F.lit("").alias("level"))]
    sums = (tr.select(*by, "fold", y.alias("__y"), F.explode(F.array(*pairs)).alias("__p"))
              .groupBy(*by, "__p.column", "__p.level", "fold").agg(F.sum("__y").alias("s"), F.count("__y").alias("n")))
    # every (column, level) once per fold, whether the fold holds it or not
    per = sums.where("level is not null").groupBy(*by, "column", "level").agg(
        F.sum("s").alias("sv"), F.sum("n").alias("nv"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("s", "n")))).alias("in_fold"))
    grid = per.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("fold"))
    own = F.try_element_at("in_fold", F.col("fold"))
    grid = grid.select(*by, "column", "level", "fold",
                       (F.coalesce("sv", F.lit(0.0)) - F.coalesce(own["s"], F.lit(0.0))).alias("s"),
                       (F.col("nv") - F.coalesce(own["n"], F.lit(0))).alias("n"))
    prior = F.max(F.when(F.col("column") == "", F.try_divide("s", "n"))).over(Window.partitionBy(*by, "fold"))
    seen = (F.col("n") > 1) if singleton_to_prior else (F.col("n") > 0)
    enc = F.when(F.col("column") == "", F.col("__prior")).otherwise(
        F.when(seen, (F.col("s") + F.col("__prior") * prior_weight) / (F.col("n") + prior_weight)).otherwise(F.col("__prior")))
    e = grid.withColumn("__prior", prior).select(
        *by, "column", F.when(F.col("column") != "", F.col("level")).alias("level"), "fold", enc.alias("enc"))
    mean = e.groupBy(*by, "column", "level").agg(F.lit(-1).alias("fold"), F.avg("enc").alias("enc"))
    return e.unionByName(mean)


def encode_levels(df: DataFrame, encoder: DataFrame, cols, suffix: str, fold_col: str | None = None, by=()) -> DataFrame:
    """Encoded columns by one join: the distinct combinations of levels (as few
    as there are groups) look their values up and are laid out in one row each.
    Unseen levels get the mean prior."""
    by, cols = list(by), list(cols)
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in [*by, *cols]])
    if fold_col:
        key = F.concat_ws("\x1f", key, F.col(fold_col).cast("string"))
    df = df.withColumn("__key", key)
    fold = F.col(fold_col) if fold_col else F.lit(-1)
    combos = df.select("__key", *by, fold.alias("fold"), *cols).dropDuplicates(["__key"])
    long = combos.select("__key", *by, "fold", F.explode(F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in cols])).alias("__p")) \
        .select("__key", *by, "fold", "__p.column", "__p.level")
    prior = encoder.where("column = '' and fold = -1").select(*by, F.col("enc").alias("__mp"))
    long = long.join(encoder.where("column <> ''"), [*by, "column", "level", "fold"], "left")
    long = long.join(prior, by, "left") if by else long.join(F.broadcast(prior))      # one row
    wide = long.groupBy("__key").agg(*[
        F.max(F.when(F.col("column") == c, F.coalesce("enc", "__mp"))).alias(c + suffix) for c in cols])
    return df.join(wide, "__key", "left").drop("__key")


def target_encode_oof(train: DataFrame, others: dict[str, DataFrame], cols, target: str,
                      n_folds: int = 3, keys=KEYS, prior_weight: float = 1.0,
                      singleton_to_prior: bool = True, suffix: str = "_tenc", folds: str = "contiguous", by=()):
    """Out-of-fold target means with a prior.

    Fold f's encoder is fitted on the train rows outside fold f; its level
    value is (S + prior_f * a) / (N + a), its prior the mean target of those
    rows; levels seen once (and unseen levels) get the prior. Train rows are
    encoded by their own fold's encoder, every other frame by the mean of the
    k encoders. ``folds`` is 'contiguous' (the reference's KFold) or 'hash';
    ``by`` fits one encoder per value of some leading keys.

    Returns (train_encoded, {name: frame_encoded}, encoder_table)."""
    if folds == "hash":
        tr = hash_folds(train, n_folds, keys)
    elif folds == "contiguous":
        tr = contiguous_folds(train, n_folds, keys, by=by)
    else:
        raise ValueError("folds must be 'contiguous' or 'hash'")
    tr = cut_lineage(tr)
    encoder = cut_lineage(encoder_statistics(tr, cols, target, n_folds, prior_weight, singleton_to_prior, by))
    return (encode_levels(tr, encoder, cols, suffix, "fold", by),
            {name: encode_levels(df, encoder, cols, suffix, None, by) for name, df in others.items()}, encoder)


def string_columns(df: DataFrame, columns) -> list[str]:
    """Columns of string type among `columns` (the reference's object dtype)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return [c for c in columns if isinstance(types.get(c), T.StringType)]
