"""Frozen configuration objects.

Defaults follow the reference application: lags 1/7/14/30, rolling windows 7/30,
warm-up 30 rows, test window 28 days, step 28, embargo 0 (the phase-1 orchestrator
uses 1), horizon 30, encoder 30..90, quantiles 0.1/0.5/0.9, three cross-fitting folds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values from the reference --------------------------------------------
# SNAP flag column of each state in the wide calendar.
DEFAULT_STATE_FLAGS = {"CA": "snap_CA", "TX": "snap_TX", "WI": "snap_WI"}
# Event columns filled with 'NoEvent'.
EVENT_COLUMNS = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")
NO_EVENT = "NoEvent"
UNKNOWN = "Unknown"
# Series identity columns of the wide sales matrix.
ID_COLUMNS = ("item_id", "store_id", "dept_id", "cat_id", "state_id")
DAY_PREFIX = "d_"
# Candidate sales files, first existing wins.
SALES_FILE_CANDIDATES = ("sales_train_validation.csv", "sales_train_evaluation.csv")
COVERAGE_TARGET = 0.80
COVERAGE_OK_ERROR = 0.05
MASE_SEASONALITY = 7
MASE_ZERO_DENOMINATOR = 1e-6
STOCKOUT_HIGH_BELOW = 10.0
STOCKOUT_MEDIUM_BELOW = 30.0
ELASTIC_BELOW = -1.5
WHATIF_PCT_RANGE = (-30, 30)
# ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class PanelKeys:
    item: str = "item_id"
    store: str = "store_id"
    date: str = "date"
    target: str = "sales"

    @property
    def series(self) -> list[str]:
        return [self.item, self.store]


@dataclass(frozen=True)
class FeatureConfig:
    lag_days: tuple[int, ...] = (1, 7, 14, 30)
    rolling_windows: tuple[int, ...] = (7, 30)
    warmup_days: int = 30
    momentum_days: int = 7
    state_flags: dict = field(default_factory=lambda: dict(DEFAULT_STATE_FLAGS))
    categorical_columns: tuple[str, ...] = ID_COLUMNS + ("weekday",) + EVENT_COLUMNS
    keys: PanelKeys = PanelKeys()


@dataclass(frozen=True)
class SplitConfig:
    test_days: int = 28
    n_folds: int = 1
    step_days: int = 28
    min_train_days: int = 365
    embargo_days: int = 0
    include_last_day: bool = False
    date_col: str = "date"


@dataclass(frozen=True)
class ColumnTaxonomy:
    """Column roles of the forecast dataset (D8); names missing from a table are skipped
    (P6).  Fixed values from the reference's configuration."""
    static_categoricals: tuple[str, ...] = ("item_id", "store_id", "dept_id", "cat_id", "state_id")
    known_categoricals: tuple[str, ...] = ("event_type_1", "event_type_2")
    known_reals: tuple[str, ...] = (
        "sell_price", "price_change_abs", "price_change_pct", "price_momentum_7d", "price_rel_to_dept",
        "day_of_week", "day_of_month", "week_of_year", "month", "year", "is_weekend", "is_month_start",
        "is_month_end", "has_event", "snap_eligible")
    unknown_reals: tuple[str, ...] = (
        "sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_30",
        "sales_rmean_7", "sales_rstd_7", "sales_rmin_7", "sales_rmax_7",
        "sales_rmean_30", "sales_rstd_30", "sales_rmin_30", "sales_rmax_30")

    @property
    def known(self) -> tuple[str, ...]:
        return self.known_categoricals + self.known_reals

    @property
    def unknown(self) -> tuple[str, ...]:
        """Unknown in the future: the target plus the lag / rolling features."""
        return ("sales",) + self.unknown_reals


@dataclass(frozen=True)
class ForecastConfig:
    horizon: int = 30
    max_encoder_length: int = 90
    min_encoder_length: int = 30
    quantiles: tuple[float, ...] = (0.1, 0.5, 0.9)
    season: int = 7
    min_series_residuals: int = 14
    gbt_iterations: int = 20
    gbt_depth: int = 5
    seed: int = 42
    keys: PanelKeys = PanelKeys()


@dataclass(frozen=True)
class CausalConfig:
    n_folds: int = 3
    outcome: str = "sales"
    treatment: str = "sell_price"
    confounders: tuple[str, ...] = ("day_of_week", "has_event")
    segment: tuple[str, ...] = ("cat_id",)
    fold_keys: tuple[str, ...] = ("item_id", "store_id")
    z: float = 1.959963984540054
    min_abs_rt: float = 1e-3
    n_trees: int = 20
    max_depth: int = 5
    n_half_samples: int = 4
    seed: int = 42
