"""Backtests over rolling folds and the choice of a forecaster per series.

* ``fold_forecasts`` -- seasonal quantile forecasts of every fold from one scan: the fold cutoffs
  become conditions inside one window and one aggregate by series, so neither the exchange nor
  the sort repeats per fold.
* ``fold_report`` -- accuracy by fold (and by step or slice) from one grouped aggregate.
* ``best_per_series`` -- candidates are fitted before the validation block, scored on it and the
  best one is chosen by ``min_by`` per series; with the naive forecast among them no series is
  worse than naive on that block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ForecastConfig, SplitConfig
from ..functions import expressions as X
from ..session import cut_lineage
from .features import series_window
from .forecast import actuals_by_step


def fold_cutoffs(df: DataFrame, split: SplitConfig) -> list:
    """First test day of each fold, oldest first; the last day is one aggregate."""
    from datetime import timedelta
    last = df.agg(F.max(F.to_date(split.date_col))).first()[0]
    if last is None:
        return []
    shift = 1 if split.include_last_day else 0
    return [last - timedelta(days=split.test_days + (split.n_folds - i) * split.step_days - shift) for i in range(1, split.n_folds + 1)]


def fold_forecasts(df: DataFrame, split: SplitConfig = SplitConfig(), cfg: ForecastConfig = ForecastConfig(), carry=()) -> DataFrame:
    """(fold, series, [carry], horizon_step, quantiles, actual): the seasonal forecast of each fold's training
    rows against the h-th test row, for every step that has one.

    Training rows of a fold come before its cutoff less the embargo.  A step's base is the value at the
    same place of the last training season (the last value if the series is shorter), plus quantiles of
    the series' seasonal residuals over its last ``max_encoder_length`` training rows; below
    ``min_series_residuals`` of them the residuals count as 0.  Series without training rows have no row."""
    k = cfg.keys
    cuts = fold_cutoffs(df, split)
    day = F.to_date(F.col(k.date))
    w, whole = series_window(k), Window.partitionBy(*k.series)
    rows = df.select(*k.series, *carry, day.alias(k.date), k.target).withColumns({
        "_rn": F.row_number().over(w), "_r": F.col(k.target) - F.lag(k.target, cfg.season).over(w)})
    counts = {}
    for i, cut in enumerate(cuts):
        counts[f"_train{i}"] = F.count_if(F.col(k.date) < F.date_sub(F.lit(cut), split.embargo_days)).over(whole)
        counts[f"_before{i}"] = F.count_if(F.col(k.date) < F.lit(cut)).over(whole)
    rows = rows.withColumns(counts)
    aggs = [F.first(c).alias(c) for c in carry]
    for i, cut in enumerate(cuts):
        back = F.col(f"_train{i}") - F.col("_rn") + 1
        known = F.when((back >= 1) & (back <= cfg.max_encoder_length), F.col("_r"))
        step = (F.col("_rn") - F.col(f"_before{i}")).cast("int")
        ahead = (step >= 1) & (step <= cfg.horizon) & (F.col(k.date) < F.date_add(F.lit(cut), split.test_days))
        aggs.append(F.struct(
            F.lit(i + 1).alias("fold"), F.max(f"_train{i}").alias("n_train"), F.count(known).alias("n_residuals"),
            F.max_by(k.target, F.when(back >= 1, F.col("_rn"))).alias("last"),
            F.collect_list(F.when((back >= 1) & (back <= cfg.season), F.struct(back.cast("int").alias("back"), F.col(k.target).alias("y")))).alias("season"),
            F.collect_list(F.when(ahead, F.struct(step.alias("step"), F.col(k.target).alias("y")))).alias("ahead"),
            *[F.percentile(known, q).alias(X.quantile_name(q)) for q in cfg.quantiles]).alias(f"_fold{i}"))
    if not cuts:
        return rows.select(F.lit(1).alias("fold"), *k.series, *carry, F.lit(1).alias("horizon_step"),
                           *[F.lit(0.0).alias(X.quantile_name(q)) for q in cfg.quantiles], F.lit(0.0).alias("actual"))
    per = rows.groupBy(*k.series).agg(*aggs)
    each = (per.select(*k.series, *carry, F.explode(F.array(*[F.col(f"_fold{i}") for i in range(len(cuts))])).alias("f"))
               .where("f.n_train > 0").select(*k.series, *carry, "f.*").select("*", F.explode("ahead").alias("a")))
    want = F.lit(cfg.season) - (F.col("a.step") - 1) % cfg.season
    base = F.coalesce(F.try_element_at(F.filter("season", lambda s: s["back"] == want), F.lit(1))["y"], F.col("last"))
    enough = F.col("n_residuals") >= cfg.min_series_residuals
    cols = {X.quantile_name(q): X.clip0(base + F.when(enough, F.col(X.quantile_name(q))).otherwise(0.0)) for q in cfg.quantiles}
    return each.withColumns(cols).select("fold", *k.series, *carry, F.col("a.step").alias("horizon_step"),
                                         *cols, F.col("a.y").cast("double").alias("actual"))


def fold_report(forecasts: DataFrame, cfg: ForecastConfig = ForecastConfig(), by=("fold",)) -> DataFrame:
    """Per fold (or other columns): rows, series, MAE and bias of the median, coverage of the outer interval,
    weighted quantile loss (2 sum of pinball losses over quantiles / their number / sum |y|)."""
    k = cfg.keys
    taus = sorted(cfg.quantiles)
    mid = X.quantile_name(min(taus, key=lambda q: abs(q - 0.5)))
    lo, hi = X.quantile_name(taus[0]), X.quantile_name(taus[-1])
    y = F.col("actual")
    pin = sum((F.greatest(q * (y - F.col(X.quantile_name(q))), (q - 1) * (y - F.col(X.quantile_name(q)))) for q in taus), F.lit(0.0))
    return (forecasts.where(y.isNotNull()).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*k.series).alias("n_series"),
                 F.avg(F.abs(y - F.col(mid))).alias("mae"), F.avg(F.col(mid) - y).alias("bias"),
                 F.avg(((y >= F.col(lo)) & (y <= F.col(hi))).cast("double")).alias("coverage"),
                 F.try_divide(2 * F.sum(pin) / len(taus), F.nullif(F.sum(F.abs(y)), F.lit(0.0))).alias("wql")))


# ---- best forecaster per series -------------------------------------------------------------

def point_candidates(history: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """(series, horizon_step, model, prediction) of the point forecasters: ``naive`` (last value), ``seasonal`` (same
    place of the last season, else the last value), ``mean`` (mean of the last ``max_encoder_length`` rows) and
    ``drift`` (last value plus the mean step of these rows per step ahead), 0 at least.  One exchange and one aggregate by series."""
    k = cfg.keys
    whole = Window.partitionBy(*k.series)
    rows = history.select(*k.series, k.date, k.target).withColumn(
        "_back", F.count(F.lit(1)).over(whole) - F.row_number().over(series_window(k)) + 1)
    near = F.col("_back") <= cfg.max_encoder_length
    per = rows.groupBy(*k.series).agg(
        F.min_by(k.target, "_back").alias("last"), F.avg(F.when(near, F.col(k.target))).alias("mean"),
        F.max_by(F.when(near, F.col(k.target)), F.when(near, F.col("_back"))).alias("first"), F.max(F.when(near, F.col("_back"))).alias("n"),
        F.collect_list(F.when(F.col("_back") <= cfg.season, F.struct("_back", F.col(k.target).alias("y")))).alias("season"))
    steps = per.withColumn("horizon_step", F.explode(F.sequence(F.lit(1), F.lit(cfg.horizon))))
    want = F.lit(cfg.season) - (F.col("horizon_step") - 1) % cfg.season
    seasonal = F.coalesce(F.try_element_at(F.filter("season", lambda s: s["_back"] == want), F.lit(1))["y"], F.col("last"))
    drift = F.col("last") + F.coalesce(F.try_divide(F.col("last") - F.col("first"), F.nullif(F.col("n") - 1, F.lit(0))), F.lit(0.0)) * F.col("horizon_step")
    each = {"naive": F.col("last"), "seasonal": seasonal, "mean": F.col("mean"), "drift": drift}
    return steps.select(*k.series, "horizon_step", F.explode(F.array(*[
        F.struct(F.lit(name).alias("model"), X.clip0(v.cast("double")).alias("prediction")) for name, v in each.items()])).alias("c")).select(
        *k.series, "horizon_step", "c.*")


def best_per_series(candidates: DataFrame, validation: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """(series, model, val_mae, naive_mae, n_val): the candidate with the least mean absolute error on the h-th
    validation rows, ties to the first name; series without validation rows take ``naive`` with NULL errors."""
    k = cfg.keys
    scored = (candidates.join(actuals_by_step(validation, cfg).where(F.col(k.target).isNotNull()).drop(k.date), [*k.series, "horizon_step"], "left")
              .groupBy(*k.series, "model").agg(F.avg(F.abs(F.col(k.target) - F.col("prediction"))).alias("mae"), F.count(k.target).alias("n")))
    best = scored.groupBy(*k.series).agg(
        F.min(F.when(F.col("mae").isNotNull(), F.struct("mae", "model"))).alias("b"),
        F.max(F.when(F.col("model") == "naive", F.col("mae"))).alias("naive_mae"), F.max("n").alias("n_val"))
    return best.select(*k.series, F.coalesce("b.model", F.lit("naive")).alias("model"), F.col("b.mae").alias("val_mae"), "naive_mae", "n_val")


def forecast_with_best(history: DataFrame, validation_days: int, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """(series, horizon_step, model, prediction) after the end of ``history``: models are chosen on its last
    ``validation_days`` days, then forecast from all of it."""
    k = cfg.keys
    rows = cut_lineage(history.select(*k.series, k.date, k.target))  # read by the choice and by the forecast
    cut = F.date_sub(F.lit(rows.agg(F.max(F.to_date(k.date))).first()[0]), validation_days - 1)
    chosen = best_per_series(point_candidates(rows.where(F.to_date(k.date) < cut), cfg), rows.where(F.to_date(k.date) >= cut), cfg)
    return (point_candidates(rows, cfg).join(chosen.select(*k.series, F.col("model").alias("_best")), k.series, "left")
            .where(F.col("model") == F.coalesce("_best", F.lit("naive"))).drop("_best"))
