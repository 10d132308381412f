"""Calendar keys and cyclic encodings as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.config import MANUAL_CYCLE_MAX

CALENDAR_COLUMNS = ("weekday", "week", "month", "quarter", "year", "year_month",
                    "year_quarter", "date_month", "weekday_week", "year_week")


def parse_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """String to date."""
    return F.to_date(c if isinstance(c, Column) else F.col(c), fmt)


def shift_year_month(ym: Column | str, offset: int = 1) -> Column:
    """O31: 'YYYY-MM' plus `offset` months."""
    c = ym if isinstance(ym, Column) else F.col(ym)
    return F.date_format(F.add_months(F.to_date(c, "yyyy-MM"), offset), "yyyy-MM")


def calendar_exprs(date_col: str = "date", iso_year: bool = False) -> dict[str, Column]:
    """O32. Weekday has Monday = 0; `week` is the ISO week. The reference pairs
    the ISO week with the *calendar* year; iso_year=True uses the ISO year."""
    d = F.col(date_col)
    weekday = F.weekday(d)
    week = F.weekofyear(d)
    year = F.year(d)
    wyear = F.expr(f"extract(YEAROFWEEK FROM `{date_col}`)") if iso_year else year
    return {
        "weekday": weekday,
        "week": week,
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": year,
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_quarter": F.concat(year.cast("string"), F.lit("Q"), F.quarter(d).cast("string")),
        "date_month": F.date_format(d, "MM-dd"),
        "weekday_week": F.concat(week.cast("string"), F.lit("-"), weekday.cast("string")),
        "year_week": F.concat(wyear.cast("string"), F.lit("-"), week.cast("string")),
    }


def calendar_columns(df: DataFrame, date_col: str = "date", iso_year: bool = False,
                     columns=CALENDAR_COLUMNS) -> DataFrame:
    ex = calendar_exprs(date_col, iso_year)
    return df.withColumns({c: ex[c] for c in columns})


CYCLIC_ORDER = ("weekday", "week", "month", "quarter")


def cyclic_encoding(df: DataFrame, mode: str = "auto", columns=CYCLIC_ORDER,
                    drop_quarter: bool = True) -> DataFrame:
    """sin/cos of 2*pi*x/M. `auto` takes M as the observed maximum over the
    whole frame (one global aggregate, joined back as a one-row broadcast);
    `manual` uses 7/52/12/4. `quarter` itself is dropped afterwards."""
    if mode == "manual":
        maxes = {c: F.lit(float(MANUAL_CYCLE_MAX[c])) for c in columns}
        out = df
    elif mode == "auto":
        stats = df.agg(*[F.max(c).cast("double").alias(f"__max_{c}") for c in columns]) \
                  .withColumn("__one", F.lit(1))
        out = df.withColumn("__one", F.lit(1)).join(F.broadcast(stats), "__one").drop("__one")
        maxes = {c: F.col(f"__max_{c}") for c in columns}
    else:
        raise ValueError("mode must be 'auto' or 'manual'")
    two_pi = 2 * math.pi
    new = {}
    for c in columns:
        x = F.col(c).cast("double")
        new[f"{c}_sin"] = F.sin(F.lit(two_pi) * x / maxes[c])
        new[f"{c}_cos"] = F.cos(F.lit(two_pi) * x / maxes[c])
    out = out.withColumns(new)
    if mode == "auto":
        out = out.drop(*[f"__max_{c}" for c in columns])
    if drop_quarter and "quarter" in columns:
        out = out.drop("quarter")
    return out
