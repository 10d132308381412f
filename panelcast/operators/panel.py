"""Panel construction: star join, date filters, daily panel, spine, zero fill.

O07-O10, O14, O15, O17, O19, O20, O37, O38, O61, O63.

Scale notes
-----------
* The fact table is aggregated once to (date, K) with a partial (map-side)
  HashAggregate; a hot key only sends one partial row per task.
* Dimension joins are plain equi-joins: Spark broadcasts a dimension when its
  estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
  re-plans on the runtime size; beyond that it falls back to a shuffle join.
* The prediction spine is generated per group with ``explode(sequence())``,
  not by a join against a date table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig, KEYS
from panelcast.functions.calendar import calendar_columns, CALENDAR_COLUMNS
from panelcast.session import cut_lineage


def _lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def star_join(sales: DataFrame, taxonomy: DataFrame, stores: DataFrame) -> DataFrame:
    """Inner joins on product_id then store_id."""
    return sales.join(taxonomy, "product_id", "inner").join(stores, "store_id", "inner")


def filter_date_range(df: DataFrame, start: dt.date, end: dt.date, col: str = "date") -> DataFrame:
    """Inclusive at both ends."""
    return df.where(F.col(col).between(_lit_date(start), _lit_date(end)))


def split_label(cfg: ForecastConfig, col: str = "date") -> Column:
    """O15: 'train' / 'test' / 'predict' label (NULL outside the three ranges)."""
    d = F.col(col)
    return (F.when(d.between(_lit_date(cfg.train_start), _lit_date(cfg.train_end)), "train")
             .when(d.between(_lit_date(cfg.test_start), _lit_date(cfg.test_end)), "test")
             .when(d.between(_lit_date(cfg.prediction_start), _lit_date(cfg.prediction_end)), "predict"))


def prepare_data(joined: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Date filter (train start .. prediction end) plus calendar columns."""
    return calendar_columns(filter_date_range(joined, cfg.train_start, cfg.prediction_end),
                            iso_year=cfg.iso_year)


def daily_sums(data: DataFrame, start: dt.date, end: dt.date, target: str = "sales",
               keys=KEYS) -> DataFrame:
    """Sum of the target by (date, K). NULL keys dropped (pandas drops them);
    a sum over only NULLs is 0 (pandas semantics)."""
    return (filter_date_range(data, start, end)
            .dropna(subset=list(keys))
            .groupBy("date", *keys)
            .agg(F.coalesce(F.sum(target), F.lit(0.0)).cast("double").alias(target)))


def daily_panel(data: DataFrame, start: dt.date, end: dt.date, target: str = "sales",
                keys=KEYS, iso_year: bool = False) -> DataFrame:
    """Daily target sums per group; calendar columns derived after the
    aggregate (they are functions of the date, so grouping by them is waste)."""
    s = daily_sums(data, start, end, target, keys)
    s = calendar_columns(s, iso_year=iso_year)
    return s.select("date", *keys, *CALENDAR_COLUMNS, target)


def distinct_groups(df: DataFrame, keys=KEYS) -> DataFrame:
    """O17."""
    return df.select(*keys).dropna().distinct()


def date_spine(groups: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Every day of [start, end] for each group, generated per group row."""
    return groups.select(
        F.explode(F.sequence(_lit_date(start), _lit_date(end), F.expr("INTERVAL 1 DAY"))).alias("date"),
        *groups.columns)


def attach_actuals(spine: DataFrame, actuals: DataFrame, keys=KEYS) -> DataFrame:
    """Left join of daily actual sums."""
    return spine.join(actuals, ["date", *keys], "left")


def zero_fill_active_groups(pred: DataFrame, target: str = "sales", keys=KEYS) -> DataFrame:
    """O10. If at least one actual exists in the window: keep groups whose max
    actual is >= 0 and fill gaps with 0. If none exists: keep all rows with a
    NULL target. The global flag is a one-row aggregate joined back (broadcast
    of a proven single row), so there is no driver round trip."""
    w = Window.partitionBy(*keys)
    flag = pred.agg((F.count(target) > 0).alias("__has_actuals")).withColumn("__one", F.lit(1))
    x = (pred.withColumn("__max", F.max(target).over(w))
             .withColumn("__one", F.lit(1))
             .join(F.broadcast(flag), "__one"))
    keep = (~F.col("__has_actuals")) | (F.col("__max") >= 0)
    filled = F.when(F.col("__has_actuals"), F.coalesce(F.col(target), F.lit(0.0))).otherwise(F.col(target))
    return (x.where(keep).withColumn(target, filled.cast("double"))
             .drop("__max", "__one", "__has_actuals"))


def prediction_frame(data: DataFrame, test_panel: DataFrame, cfg: ForecastConfig,
                     sums: DataFrame | None = None) -> DataFrame:
    """Spine of the prediction window for the groups seen in the test window,
    actuals attached and zero-filled (O08 + O09 + O10)."""
    keys = cfg.keys
    groups = distinct_groups(test_panel, keys)
    spine = date_spine(groups, cfg.prediction_start, cfg.prediction_end)
    if sums is None:
        sums = daily_sums(data, cfg.prediction_start, cfg.prediction_end, cfg.target, keys)
    else:
        sums = filter_date_range(sums, cfg.prediction_start, cfg.prediction_end)
    pred = zero_fill_active_groups(attach_actuals(spine, sums, keys), cfg.target, keys)
    pred = calendar_columns(pred, iso_year=cfg.iso_year)
    return pred.select("date", *keys, *CALENDAR_COLUMNS, cfg.target)


def build_panel(data: DataFrame, cfg: ForecastConfig, sums: DataFrame | None = None) -> DataFrame:
    """O20 + O37: train, test and prediction parts in one frame.

    One aggregate over [train_start, prediction_end] feeds all three parts,
    instead of three separate scans and group-bys; ``sums`` are its rows, if
    they are at hand.
    """
    keys = cfg.keys
    # (date, K) sums: days x groups rows, read by four branches below. Written
    # once instead of re-running the fact scan and joins per branch.
    if sums is None:
        sums = cut_lineage(daily_sums(data, cfg.train_start, cfg.prediction_end, cfg.target, keys))
    in_train = F.col("date").between(_lit_date(cfg.train_start), _lit_date(cfg.train_end))
    in_test = F.col("date").between(_lit_date(cfg.test_start), _lit_date(cfg.test_end))
    hist = calendar_columns(sums.where(in_train | in_test), iso_year=cfg.iso_year) \
        .select("date", *keys, *CALENDAR_COLUMNS, cfg.target)
    test = sums.where(in_test)
    pred = prediction_frame(data, test, cfg, sums=sums)
    return concat_frames(hist, pred)


def concat_frames(*frames: DataFrame) -> DataFrame:
    """Bag union by name, columns in the first frame's order."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f.select(*frames[0].columns))
    return out


def fill_missing(df: DataFrame, value, columns=None) -> DataFrame:
    """O61."""
    return df.fillna(value, subset=list(columns) if columns else None)


def sort_panel(df: DataFrame, keys=KEYS) -> DataFrame:
    """Order only at output time."""
    return df.orderBy(*keys, "date")


def completeness_report(df: DataFrame, horizon: int, groups: DataFrame, keys=KEYS) -> DataFrame:
    """One row with rows and groups found, the groups of ``groups`` (one
    row each) that are expected and that are missing, expected = groups x
    horizon, and whether all are there."""
    k = list(keys)
    found = df.groupBy(*k).agg(F.count(F.lit(1)).alias("__n"))
    both = found.join(groups.select(*k, F.lit(True).alias("__expected")), k, "full")
    rows = F.coalesce(F.col("__n"), F.lit(0))
    return (both.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("n_rows"), F.count("__n").alias("n_groups"),
                     F.count("__expected").alias("expected_groups"),
                     F.count_if(F.col("__n").isNull()).alias("missing_groups"),
                     F.count_if(F.col("__expected").isNull() | (rows != horizon)).alias("__bad"))
                .withColumn("expected_rows", F.col("expected_groups") * F.lit(horizon))
                .withColumn("complete", F.col("__bad") == 0).drop("__bad"))


def group_gap_report(df: DataFrame, horizon: int, groups: DataFrame, keys=KEYS) -> DataFrame:
    """O19 per expected group: those whose row count differs from the horizon."""
    k = list(keys)
    found = df.groupBy(*k).agg(F.count(F.lit(1)).alias("n_rows"))
    return (groups.select(*k).join(found, k, "left")
                  .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
                  .where(F.col("n_rows") != horizon)
                  .withColumn("expected_rows", F.lit(horizon).cast("bigint")))


def assert_complete(df: DataFrame, horizon: int, what: str, groups: DataFrame, keys=KEYS) -> None:
    """Raise unless ``df`` has ``horizon`` rows of every group of ``groups`` and no others (one tiny action)."""
    r = completeness_report(df, horizon, groups, keys).first()
    if not r["complete"]:
        raise RuntimeError(f"{what}: expected {r['expected_rows']} rows of {r['expected_groups']} groups, "
                           f"received {r['n_rows']} of {r['n_groups']}")
