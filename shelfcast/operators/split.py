"""Temporal splits without leakage.

A split is one pass that labels rows; train and test are filtered views of the labelled
frame, so the panel is never copied.  Cutoffs come from one scalar aggregate
(max date), computed by Spark as a scalar subquery.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from ..config import SplitConfig


def validate_dates(df: DataFrame, date_col: str = "date") -> None:
    """The date column must exist and be a date/timestamp (T4)."""
    if date_col not in df.columns:
        raise ValueError(f"Date column '{date_col}' not found")
    t = df.schema[date_col].dataType
    if not isinstance(t, (DateType, TimestampType, TimestampNTZType)):
        raise TypeError(f"Column '{date_col}' must be a date or timestamp, got {t.simpleString()}")


def _cutoff(df: DataFrame, cfg: SplitConfig, cutoff_date, extra_days: int = 0) -> Column:
    if cutoff_date is not None:
        c = cutoff_date if isinstance(cutoff_date, _dt.date) else _dt.date.fromisoformat(str(cutoff_date))
        return F.lit(c)
    last = df.select(F.max(cfg.date_col)).scalar()
    back = cfg.test_days + extra_days - (1 if cfg.include_last_day else 0)
    return F.date_sub(last, back)


def split_labels(df: DataFrame, cfg: SplitConfig = SplitConfig(), cutoff_date=None) -> DataFrame:
    """Add ``split`` = train | test | NULL (embargo gap or after the test window).

    train: date < cutoff - embargo; test: cutoff <= date < cutoff + test_days.  With the
    automatic cutoff (max - test_days) the test window ends the day before the last day,
    as in the reference; ``include_last_day=True`` shifts it by one day."""
    validate_dates(df, cfg.date_col)
    d = F.to_date(F.col(cfg.date_col))
    cut = _cutoff(df, cfg, cutoff_date)
    lab = (F.when(d < F.date_sub(cut, cfg.embargo_days), F.lit("train"))
            .when((d >= cut) & (d < F.date_add(cut, cfg.test_days)), F.lit("test")))
    return df.withColumn("split", lab)


def single_split(df: DataFrame, cfg: SplitConfig = SplitConfig(), cutoff_date=None):
    lab = split_labels(df, cfg, cutoff_date)
    return (lab.filter(F.col("split") == "train").drop("split"),
            lab.filter(F.col("split") == "test").drop("split"))


def rolling_folds(df: DataFrame, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """Rows labelled per fold (T2): fold i (1-based) has cutoff
    max - test_days - (n_folds - i) * step_days.  Each row is emitted once per fold in
    which it is train or test (``explode`` of an n_folds-long array, n_folds is a small
    parameter), so folds may overlap as in the reference.  Folds with an empty test side
    are dropped by a grouped count (no driver loop)."""
    validate_dates(df, cfg.date_col)
    d = F.to_date(F.col(cfg.date_col))
    last = df.select(F.max(cfg.date_col)).scalar()
    labels = []
    for i in range(1, cfg.n_folds + 1):
        cut = F.date_sub(last, cfg.test_days + (cfg.n_folds - i) * cfg.step_days
                         - (1 if cfg.include_last_day else 0))
        lab = (F.when(d < F.date_sub(cut, cfg.embargo_days), F.lit("train"))
                .when((d >= cut) & (d < F.date_add(cut, cfg.test_days)), F.lit("test")))
        labels.append(F.struct(F.lit(i).alias("fold"), lab.alias("split")))
    out = (df.withColumn("_f", F.explode(F.array(*labels)))
             .select("*", "_f.fold", "_f.split").drop("_f")
             .filter(F.col("split").isNotNull()))
    nonempty = (out.filter(F.col("split") == "test").groupBy("fold").count()
                   .select("fold"))
    return out.join(nonempty, "fold", "left_semi")


def split_summary(df: DataFrame, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """One-row summary of the split configuration over the data."""
    validate_dates(df, cfg.date_col)
    d = F.to_date(F.col(cfg.date_col))
    agg = df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))
    total = F.datediff("max_date", "min_date")
    return agg.select(
        F.concat_ws(" to ", F.col("min_date").cast("string"), F.col("max_date").cast("string")).alias("date_range"),
        total.alias("total_days"),
        F.lit(cfg.test_days).alias("test_days"), F.lit(cfg.n_folds).alias("n_folds"),
        F.lit(cfg.step_days).alias("step_days"), F.lit(cfg.embargo_days).alias("embargo_days"),
        F.lit(cfg.min_train_days).alias("min_train_days"),
        (total - cfg.test_days - cfg.embargo_days).alias("estimated_train_days"))


def leakage_check(folds: DataFrame, date_col: str = "date") -> DataFrame:
    """Per fold: last train day, first test day, and ``leak_free`` = last train < first
    test (T5).  Works on the output of ``rolling_folds`` or a labelled single split."""
    if "fold" not in folds.columns:
        folds = folds.withColumn("fold", F.lit(1))
    d = F.to_date(F.col(date_col))
    return (folds.groupBy("fold")
                 .agg(F.max(F.when(F.col("split") == "train", d)).alias("train_max"),
                      F.min(F.when(F.col("split") == "test", d)).alias("test_min"),
                      F.count_if(F.col("split") == "train").alias("n_train"),
                      F.count_if(F.col("split") == "test").alias("n_test"))
                 .withColumn("leak_free", F.col("train_max") < F.col("test_min")))


def train_span_days(train: DataFrame, date_col: str = "date") -> DataFrame:
    """Training window length in days (the min_train_days warning input)."""
    d = F.to_date(F.col(date_col))
    return train.agg(F.datediff(F.max(d), F.min(d)).alias("train_days"))
