"""Feature engineering over the long panel.

Every series operator states its order explicitly:
``w = Window.partitionBy(item, store).orderBy(date)``.  All series windows share that
one spec, so the feature pipeline needs a single hash exchange + sort of the panel on
(item, store); the window operators are stacked on it.  The only other shuffles are
narrow: the department-day price mean (five columns re-partitioned, then aggregated and
broadcast back after a size check).  A window partition is one
series, and a series has at most one row per calendar day, so its size is bounded by
the calendar length however skewed the data is (a hot series cannot hold a third of
all rows of a multi-year panel).  Rolling frames are at most 30 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EVENT_COLUMNS, FeatureConfig, PanelKeys, UNKNOWN
from ..functions import expressions as X
from .common import MAX_BROADCAST_ROWS, checked_broadcast, key_bound


def series_window(keys: PanelKeys = PanelKeys()):
    return Window.partitionBy(*keys.series).orderBy(keys.date)


# ---- calendar normalisation (S1 part, F1, F2) ----------------------------------------

def normalize_calendar(cal: DataFrame) -> DataFrame:
    """Fill missing event fields with 'NoEvent' and add ``has_event``."""
    present = [c for c in EVENT_COLUMNS if c in cal.columns]
    out = cal.withColumns({c: X.event_or_none(c) for c in present})
    if "event_name_1" in out.columns and "event_name_2" in out.columns:
        out = out.withColumn("has_event", X.has_event("event_name_1", "event_name_2"))
    return out


# ---- per-row calendar features (F3-F7) ------------------------------------------------

def add_calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    return df.withColumns({
        "day_of_week": X.day_of_week(d),
        "day_of_month": F.dayofmonth(d),
        "week_of_year": X.week_of_year(d),
        "month": F.month(d),
        "year": F.year(d),
        "is_weekend": X.is_weekend(d),
        "is_month_start": X.is_month_start(d),
        "is_month_end": X.is_month_end(d),
    })


def add_snap_features(df: DataFrame, state_flags: dict | None = None,
                      state: str = "state_id") -> DataFrame:
    """``snap_eligible`` = flag column of the row's own state, else 0 (F8)."""
    flags = FeatureConfig().state_flags if state_flags is None else state_flags
    if state not in df.columns:
        return df.withColumn("snap_eligible", F.lit(0))
    return df.withColumn("snap_eligible", X.state_flag(state, flags, df.columns))


# ---- price features (W6-W10, J7) -------------------------------------------------------

def forward_fill(df: DataFrame, columns, keys: PanelKeys = PanelKeys()) -> DataFrame:
    """Carry the last non-null value forward within each series; leading NULLs stay."""
    w = series_window(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def dept_mean_price(df: DataFrame, price: str = "sell_price", dept: str = "dept_id",
                    date: str = "date") -> DataFrame:
    """Mean price per (department, day) (A3).  Partial aggregation before the shuffle."""
    return df.groupBy(dept, date).agg(F.avg(price).alias("_dept_mean_price"))


def add_price_features(df: DataFrame, keys: PanelKeys = PanelKeys(), momentum_days: int = 7,
                       price: str = "sell_price", max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                       store_means: bool = False) -> DataFrame:
    """sell_price forward-filled; absolute and relative change vs previous row; mean over
    the current and previous ``momentum_days - 1`` rows; price / department-day mean.

    The department-day mean table has one row per distinct (department, day).  That
    count is checked first (a distinct count over the two key columns of the input);
    when it fits, the table is broadcast so the panel keeps its (item, store)
    partitioning and order for the remaining windows (BroadcastHashJoin preserves both)
    and the aggregate has an exchange of its own (two panel exchanges in all).  Above the limit
    the join is a shuffle join.  ``store_means`` writes the means first, so their exchange's files
    are gone before the panel's are there."""
    w = series_window(keys)
    base = forward_fill(df, [price], keys)
    prev = F.lag(price, 1).over(w)
    out = base.withColumns({
        "price_change_abs": F.col(price) - prev,
        "price_change_pct": X.safe_div(F.col(price) - prev, prev),
        "price_momentum_7d": F.avg(price).over(w.rowsBetween(-(momentum_days - 1), 0)),
    })
    if "dept_id" not in df.columns:
        return out
    means = dept_mean_price(base, price)
    if store_means:
        from ..session import cut_lineage
        means = cut_lineage(means)
    means = checked_broadcast(means, key_bound(df, ["dept_id", keys.date]), max_broadcast_rows)
    return (out.join(means, ["dept_id", keys.date], "left")
               .withColumn("price_rel_to_dept", X.safe_div(price, "_dept_mean_price"))
               .drop("_dept_mean_price"))


# ---- target lags and rolling statistics (W1-W5) -----------------------------------------

def add_lag_features(df: DataFrame, lags=(1, 7, 14, 30), keys: PanelKeys = PanelKeys()) -> DataFrame:
    """``{target}_lag_L`` = target L rows earlier in the series (row based)."""
    w = series_window(keys)
    t = keys.target
    return df.withColumns({f"{t}_lag_{L}": F.lag(t, L).over(w) for L in lags})


def add_rolling_features(df: DataFrame, windows=(7, 30), keys: PanelKeys = PanelKeys()) -> DataFrame:
    """Mean / sample std / min / max of the previous W rows (current row excluded, so no
    leakage); partial windows allowed, a single value has NULL std."""
    w = series_window(keys)
    t = keys.target
    cols = {}
    for W in windows:
        frame = w.rowsBetween(-W, -1)
        cols[f"{t}_rmean_{W}"] = F.avg(t).over(frame)
        cols[f"{t}_rstd_{W}"] = F.stddev_samp(t).over(frame)
        cols[f"{t}_rmin_{W}"] = F.min(t).over(frame)
        cols[f"{t}_rmax_{W}"] = F.max(t).over(frame)
    return df.withColumns(cols)


# ---- null policy and warm-up (G3: W11, F9, F10, P5/W12) -----------------------------------

def price_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "price" in c.lower()]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double")
            or f.dataType.typeName().startswith("decimal")]


def drop_warmup(df: DataFrame, warmup_days: int, keys: PanelKeys = PanelKeys()) -> DataFrame:
    """Drop the first ``warmup_days`` rows of every series (0 disables)."""
    if warmup_days <= 0:
        return df
    rn = F.row_number().over(series_window(keys)) - 1
    return df.withColumn("_row_num", rn).filter(F.col("_row_num") >= warmup_days).drop("_row_num")


def handle_missing_values(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """(1) forward-fill every column whose name contains 'price', within the series;
    (2) zero-fill numeric NULL/NaN; (3) drop the warm-up rows; (4) 'Unknown' for listed
    categorical columns.  The 'Unknown' fill comes after the last series window: the
    series keys are among the categoricals, and rewriting them earlier would make Spark
    re-shuffle the panel for the warm-up window (NULL keys group together either way)."""
    keys = cfg.keys
    out = forward_fill(df, price_columns(df), keys)
    nums = numeric_columns(out)
    out = out.withColumns({c: F.coalesce(X.nan_to_null(c) if _is_fractional(out, c) else F.col(c),
                                         F.lit(0).cast(out.schema[c].dataType)) for c in nums})
    out = drop_warmup(out, cfg.warmup_days, keys)
    cats = [c for c in cfg.categorical_columns if c in out.columns]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in cats})


def _is_fractional(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("float", "double")


def engineer_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Fixed order (G1): calendar -> SNAP -> price -> lags -> rolling -> null policy."""
    keys = cfg.keys
    return (df.transform(add_calendar_features, keys.date)
              .transform(add_snap_features, cfg.state_flags)
              .transform(add_price_features, keys, cfg.momentum_days)
              .transform(add_lag_features, cfg.lag_days, keys)
              .transform(add_rolling_features, cfg.rolling_windows, keys)
              .transform(handle_missing_values, cfg))


def feature_inventory(df: DataFrame) -> DataFrame:
    """Count columns by family from the schema alone (A13): 5 rows."""
    cols = df.columns
    fam = {
        "lag": [c for c in cols if "_lag_" in c],
        "rolling": [c for c in cols if any(s in c for s in ("_rmean_", "_rstd_", "_rmin_", "_rmax_"))],
        "price": [c for c in cols if "price" in c],
        "calendar": [c for c in cols if c in ("day_of_week", "day_of_month", "week_of_year", "month",
                                              "year", "is_weekend", "is_month_start", "is_month_end")],
        "event_snap": [c for c in cols if c.startswith("snap") or c.startswith("event") or c == "has_event"],
    }
    rows = [(k, len(v), ",".join(v)) for k, v in fam.items()]
    return df.sparkSession.createDataFrame(rows, "family string, n_columns int, columns string")
