"""Column-expression builders (JVM-side, codegen-friendly)."""

from panelcast.functions.calendar import (
    calendar_columns, cyclic_encoding, parse_date, shift_year_month, CALENDAR_COLUMNS)
from panelcast.functions.scalar import (
    log_transform, clamp_non_negative, asymmetric_sq_error, abs_pct_error, safe_div)

__all__ = ["calendar_columns", "cyclic_encoding", "parse_date", "shift_year_month",
           "CALENDAR_COLUMNS", "log_transform", "clamp_non_negative",
           "asymmetric_sq_error", "abs_pct_error", "safe_div"]
