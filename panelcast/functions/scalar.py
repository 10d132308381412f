"""O34, O35, O42, O53 building blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def log_transform(x, mode: str = "forward") -> Column:
    """log(x+1) forward, exp(x)-1 back."""
    if mode == "forward":
        return F.log1p(_c(x))
    if mode == "back":
        return F.expm1(_c(x))
    raise ValueError(f"unknown mode {mode!r}: use 'forward' or 'back'")


def clamp_non_negative(x) -> Column:
    """Negative -> 0, NULL stays NULL (greatest() would turn NULL into 0)."""
    c = _c(x)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def safe_div(a, b) -> Column:
    """x/0 -> NULL (pandas gives inf/NaN; ANSI Spark would raise)."""
    return F.try_divide(_c(a), _c(b))


def asymmetric_sq_error(actual, pred) -> Column:
    """O42 per row: (1.1 * (p - y))^2 when under-predicting, else (0.9 * (p - y))^2."""
    y, p = _c(actual), _c(pred)
    return F.pow(F.when(p < y, 1.1).otherwise(0.9) * (p - y), 2)


def abs_pct_error(actual, pred, divide_first: bool = True) -> Column:
    """|(y - p) / (y + 1)| (O53 form) or |p - y| / (y + 1) (O55 form)."""
    y, p = _c(actual), _c(pred)
    if divide_first:
        return F.abs(F.try_divide(y - p, y + 1))
    return F.try_divide(F.abs(p - y), y + 1)
