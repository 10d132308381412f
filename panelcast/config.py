"""Run parameters: one frozen dataclass replaces the YAML file of the reference."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# Panel key: product category x store type.
KEYS: tuple[str, str] = ("hierarchy1_id", "storetype_id")

# Fixed values that must equal the reference for the same results.
# Lag days of the rolling totals.
DEFAULT_LAGS: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7, 14, 28)
# Promotion and attribute columns turned into monthly share features.
SHARE_FEATURES: tuple[str, ...] = (
    "promo_type_1", "promo_bin_1", "promo_type_2", "promo_bin_2",
    "promo_discount_2", "promo_discount_type_2", "city_id", "cluster_id",
)
# Columns never fed to the boosted model.
EXCEPT_COLS: tuple[str, ...] = (
    "date", "year_month", "year_quarter", "date_month", "weekday_week",
    "year_week", "target", "sales", "week", "month",
)
# Divisors of the fixed ("manual") cyclic encoding.
MANUAL_CYCLE_MAX = {"weekday": 7, "week": 52, "month": 12, "quarter": 4}


def _d(x) -> dt.date:
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(str(x)[:10])


@dataclass(frozen=True)
class ForecastConfig:
    train_start: dt.date
    train_end: dt.date
    test_start: dt.date
    test_end: dt.date
    prediction_start: dt.date
    prediction_end: dt.date
    target: str = "sales"
    keys: tuple[str, ...] = KEYS
    lags: tuple[int, ...] = DEFAULT_LAGS
    # 'positional' keeps the reference's column-slice totals (14 == 28);
    # 'calendar' sums true day ranges.
    lag_mode: str = "positional"
    # 'auto' divides by the observed maximum, 'manual' by 7/52/12/4.
    cyclic_mode: str = "auto"
    # ISO week number paired with calendar year (reference) or ISO year.
    iso_year: bool = False
    # Sample weights: 0.25 before this year, else 1.0.
    weight_cutoff_year: int = 2000
    # Recursive forecast: True replays the reference's state update.
    compat: bool = False
    share_features: tuple[str, ...] = SHARE_FEATURES
    except_cols: tuple[str, ...] = EXCEPT_COLS
    n_folds: int = 3
    # Boosted-tree settings, the reference's values. Engine: 'histogram' or 'mllib'.
    gbt_engine: str = "histogram"
    gbt_max_iter: int = 100_000
    gbt_step_size: float = 0.01
    gbt_patience: int = 50
    gbt_leaves: int = 50
    gbt_l1: float = 0.5
    gbt_l2: float = 0.5
    gbt_max_depth: int = 5
    gbt_max_bins: int = 128
    gbt_min_instances: int = 50
    gbt_validation_tol: float = 1e-4
    seed: int = 42
    # Trend model behind 'predicted_fbprophet': 'linear', 'ridge' or 'laplace'.
    trend_model: str = "linear"
    use_trend_feature: bool = False

    def __post_init__(self):
        for name in ("train_start", "train_end", "test_start", "test_end",
                     "prediction_start", "prediction_end"):
            object.__setattr__(self, name, _d(getattr(self, name)))

    @property
    def horizon(self) -> int:
        return (self.prediction_end - self.prediction_start).days + 1

    @property
    def prediction_month(self) -> int:
        return self.prediction_start.month

    def with_dates(self, **kw) -> "ForecastConfig":
        return replace(self, **kw)

    def validate(self) -> None:
        """Date order check of the reference (raises on violation)."""
        if not (self.prediction_end >= self.prediction_start > self.test_end
                >= self.test_start > self.train_end >= self.train_start):
            raise ValueError("dates must satisfy train <= test < prediction, in order")
        if (self.prediction_start - self.test_end).days < 1:
            raise ValueError("prediction_start must be later than test_end")


# Standard date parameters for the supplied test tables (FIXTURES.md section 3).
FIXTURE_CONFIG = ForecastConfig(
    train_start="1997-01-01", train_end="2001-05-31",
    test_start="2001-06-01", test_end="2001-06-30",
    prediction_start="2001-07-01", prediction_end="2001-07-31",
    # larger steps than the reference's 0.01 (patience 50), so a run takes some ten rounds
    gbt_max_iter=200, gbt_step_size=0.2, gbt_patience=5,
)
