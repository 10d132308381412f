"""Panel features: lags, rolling totals, prior-year totals, to-date sums,
ratios, monthly product statistics and promotion shares.

O11, O12, O21-O30, O62.

Every time-series feature is a window partitioned by the group key K (or by K
plus a period column), so a single hash partitioning on K serves them all:
Spark inserts one exchange for the first window and only sorts afterwards.
A partition holds one group's days (bounded by the calendar), never a share
of the raw fact table, so a hot group cannot blow up a task here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig, KEYS, DEFAULT_LAGS, SHARE_FEATURES
from panelcast.functions.calendar import shift_year_month, cyclic_encoding
from panelcast.session import cut_lineage, shared_table


def _w(keys=KEYS, *extra):
    return Window.partitionBy(*keys, *extra)


# ---------------------------------------------------------------- O26 / O27
def lag_columns(target: str = "sales", lags=DEFAULT_LAGS, keys=KEYS) -> dict[str, Column]:
    """Value k rows back if that row is exactly k days back, else 0;
    NULL when there is no k-th previous row or its value is NULL."""
    w = _w(keys).orderBy("date")
    out = {}
    for k in lags:
        v, d = F.lag(target, k).over(w), F.lag("date", k).over(w)
        out[f"sales_last_{k}_days"] = (
            F.when(v.isNull(), F.lit(None).cast("double"))
             .when(F.datediff(F.col("date"), d) == k, v)
             .otherwise(F.lit(0.0)))
    return out


def add_lag_features(panel: DataFrame, target: str = "sales", lags=DEFAULT_LAGS,
                     keys=KEYS, mode: str = "positional") -> DataFrame:
    """O27. `positional`: total_n is the NULL-skipping sum of the first n lag
    columns, so n=14 and n=28 both take all nine (reference behaviour).
    `calendar`: total_n sums the target over the n preceding calendar days."""
    if mode == "calendar":
        day = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date"))
        x = panel.withColumn("__day", day)
        tot = {}
        for n in lags:
            w = _w(keys).orderBy("__day").rangeBetween(-n, -1)
            tot[f"total_sales_last_{n}_days"] = F.coalesce(F.sum(target).over(w), F.lit(0.0))
        return x.withColumns(tot).drop("__day")
    if mode != "positional":
        raise ValueError("mode must be 'positional' or 'calendar'")
    lagged = panel.withColumns(lag_columns(target, lags, keys))
    names = [f"sales_last_{k}_days" for k in lags]
    tot = {}
    for n in lags:
        parts = [F.coalesce(F.col(c), F.lit(0.0)) for c in names[:n]]
        s = parts[0]
        for p in parts[1:]:
            s = s + p
        tot[f"total_sales_last_{n}_days"] = s
    return lagged.withColumns(tot).drop(*names)


# ---------------------------------------------------------------- O22
PRIOR_YEAR_SPECS = (("avg_same_month_sales", "month"),
                    ("avg_same_week_sales", "week"),
                    ("avg_same_day_sales", "weekday_week"))


def prior_year_columns(target: str = "sales", keys=KEYS, specs=PRIOR_YEAR_SPECS) -> dict[str, Column]:
    """O22a-c: total of the same period in the previous calendar year.

    Written as a range frame `year BETWEEN y-1 AND y-1` over rows of the same
    group and period, which equals the reference's group-by, year+1, left
    join, but needs no join and no extra shuffle (K-partitioning suffices).
    The columns are sums, despite their names."""
    out = {}
    for name, period in specs:
        w = _w(keys, period).orderBy("year").rangeBetween(-1, -1)
        n = F.count(F.lit(1)).over(w)
        out[name] = F.when(n > 0, F.coalesce(F.sum(target).over(w), F.lit(0.0)))
    return out


# ---------------------------------------------------------------- O28 / O29
def to_date_columns(target: str = "sales", keys=KEYS) -> dict[str, Column]:
    """Running sum within (K, period) excluding the row itself."""
    out = {}
    for name, period in (("month_sales_to_date", "year_month"), ("week_sales_to_date", "year_week")):
        w = _w(keys, period).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
        out[name] = F.when(F.col(target).isNull(), F.lit(None).cast("double")) \
                     .otherwise(F.coalesce(F.sum(target).over(w), F.lit(0.0)))
    return out


def ratio_columns() -> dict[str, Column]:
    """To-date / prior-year total; 0 denominator gives NULL."""
    return {
        "percentage_sold_of_month": F.try_divide(F.col("month_sales_to_date"), F.col("avg_same_month_sales")),
        "percentage_sold_of_week": F.try_divide(F.col("week_sales_to_date"), F.col("avg_same_week_sales")),
    }


# ---------------------------------------------------------------- O30
def first_row_per_group(df: DataFrame, keys=KEYS, order: str = "date") -> DataFrame:
    w = _w(keys).orderBy(order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


# ---------------------------------------------------------------- one fact read for O20, O21 and O24
def fact_aggregates(data: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """All that later stages need of the fact rows, from one read: tag, period, K, name, value, total, low, high, n, kinds.

    The columns in use are written once; every aggregate then reads only its
    own. The day's target ('day'), the month's promotion values ('share') and
    attributes ('stat') combine map-side to as many rows as there are groups
    and periods, stores ('kind') to one per group and store with its months as
    bits. Products ('kind') hardly combine, so their narrow keys are the only
    rows of fact size that are dealt. Months end at ``test_end``.
    """
    k, t = list(cfg.keys), F.col(cfg.target).cast("double")
    used = dict.fromkeys(["date", "year_month", *k, cfg.target, *cfg.share_features, *PRODUCT_STAT_COLUMNS, "product_id", "store_id"])
    rows = shared_table(data.dropna(subset=k).select(*used), "fact-rows")
    known = rows.where((F.col("date") <= F.lit(cfg.test_end).cast("date")) & F.col("year_month").isNotNull()) \
                .withColumn("__period", F.col("year_month"))
    none = F.lit(None).cast("double")
    sums = [F.sum("__x").alias("total"), F.min("__x").alias("low"), F.max("__x").alias("high"), F.count("__x").alias("n")]

    def tagged(df, tag, period, name, value, kinds):
        return df.select(F.lit(tag).alias("tag"), period.alias("period"), *k, name.alias("name"), value.alias("value"),
                         "total", "low", "high", "n", kinds.alias("kinds"))

    one, empty = F.lit(1).cast("long"), F.lit("")
    day = tagged(rows.select("date", *k, t.alias("__x")).groupBy("date", *k).agg(*sums),
                 "day", F.col("date").cast("string"), empty, empty, one)

    values = [F.struct(F.lit(f).alias("name"), F.coalesce(F.col(f).cast("string"), F.lit("nan")).alias("value")) for f in cfg.share_features]
    share = (known.select("__period", *k, t.alias("__x"), F.explode(F.array(*values)).alias("__e"))
             .groupBy("__period", *k, "__e.name", "__e.value").agg(*sums))
    share = tagged(share, "share", F.col("__period"), F.col("name"), F.col("value"), one)

    stats = []
    for i, c in enumerate(PRODUCT_STAT_COLUMNS):
        x = F.col(c).cast("double")
        stats += [F.sum(x).alias(f"__s{i}"), F.min(x).alias(f"__l{i}"), F.max(x).alias(f"__h{i}"), F.count(x).alias(f"__n{i}")]
    stat = known.groupBy("__period", *k).agg(*stats).select("__period", *k, F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"__s{i}").alias("total"), F.col(f"__l{i}").alias("low"),
                 F.col(f"__h{i}").alias("high"), F.col(f"__n{i}").alias("n")) for i, c in enumerate(PRODUCT_STAT_COLUMNS)])).alias("__e"))
    stat = tagged(stat.select("__period", *k, "__e.*"), "stat", F.col("__period"), F.col("name"), empty, one)

    out = day.unionByName(share).unionByName(stat)
    for c, kind in (("product_id", dealt_kinds(known, k, "product_id", rows.count())),
                    ("store_id", masked_kinds(known, k, "store_id", cfg.train_start))):
        kind = kind.select("*", none.alias("total"), none.alias("low"), none.alias("high"), F.lit(0).cast("long").alias("n"))
        out = out.unionByName(tagged(kind, "kind", F.col("__period"), F.lit(c), empty, F.col("__kinds")))
    return out


def dealt_kinds(known: DataFrame, keys, c: str, n_rows: int, task_rows: int = 250_000) -> DataFrame:
    """(__period, K, __kinds): exact number of distinct ``c``, for a column with nearly as many values as rows.

    Such keys do not combine map-side, so the narrow rows are dealt first and
    told apart behind the exchange. The month is in the key, and a task gets
    about ``task_rows`` rows whatever the input, which bounds its hash table."""
    parts = max(known.sparkSession.sparkContext.defaultParallelism, -(-n_rows // task_rows))
    key = ["__period", *keys, c]
    return known.select(*key).repartition(parts, *key).distinct().groupBy("__period", *keys).agg(F.count(c).alias("__kinds"))


def masked_kinds(known: DataFrame, keys, c: str, first: dt.date) -> DataFrame:
    """(__period, K, __kinds): exact number of distinct ``c``, for a column whose values come back month after month.

    A value's months are the bits of a number (64 months from ``first`` a row),
    so rows combine map-side to one per group and value, not per month."""
    month = (F.substring("__period", 1, 4).cast("int") * 12 + F.substring("__period", 6, 2).cast("int")
             - F.lit(first.year * 12 + first.month))
    masks = (known.select(*keys, c, F.shiftright(month, 6).alias("__word"), month.bitwiseAND(F.lit(63)).alias("__bit"))
             .groupBy(*keys, c, "__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__mask")))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(F.col("__mask"), b) == 1)
    at = F.col("__word") * 64 + F.col("__bit") + F.lit(first.year * 12 + first.month - 1)
    return (masks.select(*keys, c, "__word", F.explode(bits).alias("__bit"))
            .groupBy(*keys, "__word", "__bit").agg(F.count(c).alias("__kinds"))
            .select(F.format_string("%04d-%02d", F.floor(at / 12), at % 12 + 1).alias("__period"), *keys, "__kinds"))


def daily_from(facts: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Daily sums (as ``panel.daily_sums``) out of the fact aggregates."""
    return facts.where("tag = 'day' and period is not null").select(
        F.col("period").cast("date").alias("date"), *cfg.keys, F.coalesce("total", F.lit(0.0)).alias(cfg.target))


def shares_from(facts: DataFrame, cfg: ForecastConfig, shift: int = 1) -> DataFrame:
    """Long shares (as ``share_long``) out of the fact aggregates."""
    k = list(cfg.keys)
    x = facts.where("tag = 'share'").withColumn("__x", F.coalesce("total", F.lit(0.0)))
    whole = F.sum("__x").over(Window.partitionBy("period", *k, "name"))
    return x.select(shift_year_month("period", shift).alias("year_month"), *k, F.col("name").alias("feature"), "value",
                    F.coalesce(F.try_divide("__x", whole), F.lit(0.0)).alias("share"))


def product_features_from(facts: DataFrame, cfg: ForecastConfig, shift: int = 1) -> DataFrame:
    """Monthly statistics (as ``product_features``) out of the fact aggregates."""
    k = list(cfg.keys)

    def at(name, x):
        return F.max(F.when(F.col("name") == name, x))

    stats = []
    for c in PRODUCT_STAT_COLUMNS:
        stats += [at(c, F.col("low")).alias(f"{c}_min"), at(c, F.try_divide("total", "n")).alias(f"{c}_mean"),
                  at(c, F.col("high")).alias(f"{c}_max")]
    kinds = [at(c, F.col("kinds")).alias(n) for c, n in (("product_id", "number_of_products"), ("store_id", "number_of_stores"))]
    out = facts.where("tag in ('stat', 'kind')").groupBy(*k, "period").agg(*stats, *kinds)
    return out.select(*k, shift_year_month("period", shift).alias("year_month"), *out.columns[len(k) + 1:])


# ---------------------------------------------------------------- O21
PRODUCT_STAT_COLUMNS = ("product_length", "product_depth", "product_width", "store_size", "price")


def product_features(data: DataFrame, keys=KEYS, shift: int = 1) -> DataFrame:
    """Per (K, year_month): distinct products and stores, min/mean/max of
    size and price attributes over transaction rows; attached to the next month.

    The statistics are one aggregate that combines map-side to one row per
    group and month. The exact distinct counts run on two narrow ``distinct``
    tables, so no row is expanded and no wide buffer is shuffled per product."""
    idx = [*keys, "year_month"]
    data = data.dropna(subset=idx)

    def stats(c):
        return [F.min(c).alias(f"{c}_min"), F.avg(c).alias(f"{c}_mean"), F.max(c).alias(f"{c}_max")]

    def number(c, name):
        return data.select(*idx, c).distinct().groupBy(*idx).agg(F.count(c).alias(name))

    out = (data.groupBy(*idx).agg(*[a for c in PRODUCT_STAT_COLUMNS for a in stats(c)])
               .join(number("product_id", "number_of_products"), idx)
               .join(number("store_id", "number_of_stores"), idx))
    return out.withColumn("year_month", shift_year_month("year_month", shift))


# ---------------------------------------------------------------- O23 / O24
def share_long(data: DataFrame, features=SHARE_FEATURES, target: str = "sales",
               index=("year_month", *KEYS), shift: int = 1) -> DataFrame:
    """O24 in long form: (year_month + shift, K, feature, value, share).

    One unpivot of all feature columns, one aggregate by (index, feature,
    value) with map-side combine, and one window for the per-index total.
    Values are strings, NULL becomes 'nan' (pandas astype(str))."""
    idx = list(index)
    cols = [F.struct(F.lit(f).alias("feature"),
                     F.coalesce(F.col(f).cast("string"), F.lit("nan")).alias("value"))
            for f in features]
    long = (data.dropna(subset=idx)
                .select(*idx, target, F.explode(F.array(*cols)).alias("__fv"))
                .select(*idx, target, "__fv.feature", "__fv.value"))
    agg = long.groupBy(*idx, "feature", "value").agg(
        F.coalesce(F.sum(target), F.lit(0.0)).alias("__x"))
    w = Window.partitionBy(*idx, "feature")
    out = agg.withColumn("share", F.coalesce(F.try_divide(F.col("__x"), F.sum("__x").over(w)), F.lit(0.0))) \
             .drop("__x")
    if shift and "year_month" in idx:
        out = out.withColumn("year_month", shift_year_month("year_month", shift))
    return out


def _named(c: str) -> Column:
    """A column by its literal name, whatever signs (dots, backticks) are in it."""
    return F.col("`" + c.replace("`", "``") + "`")


def fill_columns(df: DataFrame, index, columns) -> DataFrame:
    """``index`` and ``columns``, NULL as 0 in the latter (names may hold any signs)."""
    return df.select(*index, *[F.coalesce(_named(c), F.lit(0.0)).alias(c) for c in columns])


def pivot_shares(data: DataFrame, column: str, index=("year_month", *KEYS), value: str = "sales",
                 agg: str = "sum", normalize: bool = True, values=None) -> DataFrame:
    """Pivot `column` over `index`, fill 0, divide by the row total
    (0 total -> NULL, pandas would give NaN)."""
    idx = list(index)
    g = data.dropna(subset=idx).withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit("nan")))
    p = g.groupBy(*idx).pivot(column, values).agg({value: agg})
    vcols = [c for c in p.columns if c not in idx]
    p = fill_columns(p, idx, vcols)
    if normalize and vcols:
        total = sum((_named(c) for c in vcols[1:]), _named(vcols[0]))
        p = p.select(*idx, *[F.try_divide(_named(c), total).alias(c) for c in vcols])
    return p


def wide_shares(long: DataFrame, keys=KEYS, names=None) -> DataFrame:
    """One column `<value>_<feature>` per value, 0 when absent. Without
    ``names`` the column list is the distinct value names (bounded by
    spark.sql.pivotMaxValues), which Spark finds with a job of its own."""
    idx = ["year_month", *keys]
    named = long.select(*idx, F.concat(F.col("value"), F.lit("_"), F.col("feature")).alias("__name"), "share")
    wide = named.groupBy(*idx).pivot("__name", names).agg(F.first("share"))
    return fill_columns(wide, idx, [c for c in wide.columns if c not in idx])


def categorical_features(data: DataFrame, features=SHARE_FEATURES, target: str = "sales",
                         keys=KEYS, shift: int = 1) -> DataFrame:
    """O24 wide, straight from the fact rows (read twice: value discovery, then the pivot)."""
    return wide_shares(share_long(data, features, target, ["year_month", *keys], shift), keys)


# ---------------------------------------------------------------- O11 / O12
def assemble_features(panel: DataFrame, cat_features: DataFrame, prod_features: DataFrame,
                      keys=KEYS) -> DataFrame:
    """Left joins on (year_month, K); both right sides are one row per
    (month, group), small enough for AQE to broadcast when stats say so."""
    on = ["year_month", *keys]
    return panel.join(cat_features, on, "left").join(prod_features, on, "left")


def attach_feature_by_key(df: DataFrame, feature: DataFrame, name: str, keys=KEYS,
                          check: bool = False) -> DataFrame:
    """Look up `name` by (date, K). With check=True, raise if any key is
    missing (the reference's dict lookup raises KeyError)."""
    on = ["date", *keys]
    f = feature.select(*on, F.col(name))
    if check:
        missing = df.select(*on).join(f, on, "left_anti").limit(1).count()
        if missing:
            raise KeyError(f"{name}: keys without a value")
    return df.join(f, on, "left")


# ---------------------------------------------------------------- all together
def panel_features(panel: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """O26-O29 + O33 on the panel: lags, prior-year, to-date, ratios, cyclic."""
    t, keys = cfg.target, cfg.keys
    x = add_lag_features(panel, t, cfg.lags, keys, cfg.lag_mode)
    x = x.withColumns(prior_year_columns(t, keys))
    x = x.withColumns(to_date_columns(t, keys))
    x = x.withColumns(ratio_columns())
    return cyclic_encoding(x, cfg.cyclic_mode)


def build_feature_matrix(data: DataFrame, panel: DataFrame, cfg: ForecastConfig, facts: DataFrame | None = None) -> DataFrame:
    """Panel features plus the monthly ones of the month before. ``facts`` are
    the written ``fact_aggregates``; without them they are made here."""
    if facts is None:
        facts = cut_lineage(fact_aggregates(data, cfg))
    # Monthly features are looked up by the next month, so a prediction window
    # that crosses a month must not see its own first days: rows end at test_end.
    return assemble_features(panel_features(panel, cfg), wide_shares(shares_from(facts, cfg), cfg.keys),
                             product_features_from(facts, cfg), cfg.keys)


# ---------------------------------------------------------------- O25 / O62
def group_aggs(df: DataFrame, keys, col: str, hows) -> DataFrame:
    """Several group helpers in one aggregate."""
    fn = {"max": F.max, "sum": F.sum, "mean": F.avg, "min": F.min}
    return df.groupBy(*keys).agg(*[fn[h](col).alias(f"{h}_{col}") for h in hows])


def group_agg(df: DataFrame, keys, col: str, how: str = "max", alias: str | None = None) -> DataFrame:
    """Group max / sum / mean helper."""
    fn = {"max": F.max, "sum": F.sum, "mean": F.avg, "min": F.min}[how]
    return df.groupBy(*keys).agg(fn(col).alias(alias or f"{how}_{col}"))
