"""Quantile forecasts per (series, horizon step).

The reference trains a sequence network; this module re-aims the forecast at Spark:

* ``seasonal_quantiles`` -- seasonal-empirical forecaster, pure DataFrame/SQL:
  base(h) = the value at the same position of the last observed season, plus the
  q-quantile of the series' seasonal residuals y[t] - y[t-season] over its last
  ``max_encoder_length`` rows, clipped at 0.  Series with fewer than
  ``min_series_residuals`` residuals use the quantile of all series' residuals pooled (exact,
  found by rank without gathering the column).
  Quantiles are monotone in q by construction, so they never cross.
* ``gbt_quantiles`` -- learned forecaster: one pooled GBTRegressor over (features at the
  decision row, horizon step h, known calendar features at t+h), trained with early
  stopping on the validation cut; quantiles by split-conformal residual quantiles per h.

Per-series work is bounded: the residual window is at most ``max_encoder_length`` rows,
and ``percentile`` holds at most that many values per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ForecastConfig
from ..functions import expressions as X
from .features import series_window


def _qcols(cfg: ForecastConfig) -> list[str]:
    return [X.quantile_name(q) for q in cfg.quantiles]


def _season_rows(history: DataFrame, cfg: ForecastConfig, carry) -> DataFrame:
    """History rows with the seasonal residual ``_r`` and ``_back`` (1 = last row of the
    series), from one ascending series window: ``_back`` = rows in series - row number
    + 1, so no second (descending) sort is needed."""
    k = cfg.keys
    w = series_window(k)
    whole = Window.partitionBy(*k.series)
    return (history.select(*k.series, *carry, k.date, k.target)
                   .withColumn("_r", F.col(k.target) - F.lag(k.target, cfg.season).over(w))
                   .withColumn("_back", F.count(F.lit(1)).over(whole) - F.row_number().over(w) + 1))


def _residual(cfg: ForecastConfig):
    """The seasonal residual of the rows in the encoder window, else NULL."""
    return F.when((F.col("_back") <= cfg.max_encoder_length) & F.col("_r").isNotNull(), F.col("_r"))


def _per_series(history: DataFrame, cfg: ForecastConfig, carry) -> DataFrame:
    """One row per series: carried attributes, last value, the last season's values
    (array indexed by distance from the end) and the residual count / quantiles over
    the last ``max_encoder_length`` rows.  The aggregate runs on the window's
    partitioning, so it adds no exchange; every per-series collection is bounded
    (season values <= season, percentile inputs <= max_encoder_length)."""
    k = cfg.keys
    rows = _season_rows(history, cfg, carry)
    r = _residual(cfg)
    season = F.when(F.col("_back") <= cfg.season, F.struct(F.col("_back"), F.col(k.target).alias("y")))
    return rows.groupBy(*k.series).agg(
        *[F.first(c).alias(c) for c in carry],
        F.max_by(k.target, k.date).alias("_last"),
        F.array_sort(F.collect_list(season)).alias("_season"),
        F.count(r).alias("n_residuals"),
        *[F.percentile(r, q).alias(f"r_{X.quantile_name(q)}") for q in cfg.quantiles])


def seasonal_residual_quantiles(history: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Per series: number of residuals and the residual quantiles (``r_p10`` ...) over
    the last ``max_encoder_length`` rows."""
    k = cfg.keys
    return _per_series(history, cfg, []).select(
        *k.series, "n_residuals", *[f"r_{X.quantile_name(q)}" for q in cfg.quantiles])


def fit_seasonal(history: DataFrame, cfg: ForecastConfig = ForecastConfig(), carry=("cat_id",)) -> DataFrame:
    """The fitted forecaster as a table, one row per series: last season, last value, residual
    quantiles (``r_p10`` ...) and the pooled ones (``pooled_p10`` ...).  It can be saved and
    scored later with :func:`predict_seasonal`.

    One exchange of the history by series, one ascending window, one per-series aggregate,
    materialised.  The pooled quantiles are only looked for when a series needs them; they
    read the residuals of all series, materialised as one column."""
    from ..session import cut_lineage
    from .common import exact_quantile
    carry = [c for c in carry if c in history.columns]
    per = cut_lineage(_per_series(history, cfg, carry))
    pooled = {f"pooled_{q}": F.lit(0.0) for q in _qcols(cfg)}
    if per.where(F.col("n_residuals") < cfg.min_series_residuals).limit(1).count():
        r = cut_lineage(_season_rows(history, cfg, []).select(_residual(cfg).alias("r")).where("r is not null"))
        pooled = {f"pooled_{X.quantile_name(q)}": F.coalesce(exact_quantile(r, "r", q), F.lit(0.0)) for q in cfg.quantiles}
    return per.withColumns(pooled)


def predict_seasonal(fitted: DataFrame, cfg: ForecastConfig = ForecastConfig(), carry=("cat_id",)) -> DataFrame:
    """Forecast table (item, store, [carry], horizon_step, p10, p50, p90) for steps
    1..horizon after each series' last observed row: the steps are expanded from the
    per-series table, no join."""
    k = cfg.keys
    carry = [c for c in carry if c in fitted.columns]
    enough = F.col("n_residuals") >= cfg.min_series_residuals
    steps = fitted.withColumn("horizon_step", F.explode(F.sequence(F.lit(1), F.lit(cfg.horizon))))
    # _season is sorted by distance from the end (1 = last row); step h uses distance
    # season - (h - 1) mod season, i.e. array position season - (h-1) mod season
    want = F.lit(cfg.season) - (F.col("horizon_step") - 1) % cfg.season
    hit = F.filter("_season", lambda e: e["_back"] == want)
    base = F.coalesce(F.try_element_at(hit, F.lit(1))["y"], F.col("_last"))
    cols = {q: X.clip0(base + F.when(enough, F.col(f"r_{q}")).otherwise(F.col(f"pooled_{q}"))) for q in _qcols(cfg)}
    return steps.withColumns(cols).select(*k.series, *carry, "horizon_step", *_qcols(cfg))


def seasonal_quantiles(history: DataFrame, cfg: ForecastConfig = ForecastConfig(),
                       carry=("cat_id",)) -> DataFrame:
    """Fit on ``history`` and forecast every series."""
    return predict_seasonal(fit_seasonal(history, cfg, carry), cfg, carry)


def actuals_by_step(future: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Observed value of step h = the h-th future row of the series (row based, as the
    forecast steps are).  Returns (item, store, horizon_step, date, sales)."""
    k = cfg.keys
    return (future.select(*k.series, k.date, k.target)
                  .withColumn("horizon_step", F.row_number().over(series_window(k)))
                  .filter(F.col("horizon_step") <= cfg.horizon))


def join_actuals(forecasts: DataFrame, future: DataFrame, cfg: ForecastConfig = ForecastConfig(),
                 how: str = "inner") -> DataFrame:
    """Forecast rows with their observed value (M4 alignment by key, not by position): those
    that have one, or with ``how="left"`` all, date and value NULL where there is none."""
    k = cfg.keys
    return forecasts.join(actuals_by_step(future, cfg), [*k.series, "horizon_step"], how)


def interval_stats(forecasts: DataFrame, lo: str = "p10", mid: str = "p50", hi: str = "p90") -> DataFrame:
    """Mean interval width and median of the mid quantile (A7).  The median is exact
    but computed without gathering the column (``exact_quantile``)."""
    from .common import exact_quantile
    return (forecasts.agg(F.count(F.lit(1)).alias("n_predictions"),
                          F.avg(F.col(hi) - F.col(lo)).alias("mean_interval_width"))
                     .withColumn("median_p50", exact_quantile(forecasts, mid, 0.5)))


def mae_coverage(with_actuals: DataFrame, y: str = "sales", lo: str = "p10", mid: str = "p50",
                 hi: str = "p90") -> DataFrame:
    """MAE of the mid quantile and empirical coverage of [lo, hi]."""
    inside = ((F.col(y) >= F.col(lo)) & (F.col(y) <= F.col(hi))).cast("double")
    return with_actuals.agg(F.count(F.lit(1)).alias("n_evaluated"),
                            F.avg(F.abs(F.col(y) - F.col(mid))).alias("mae_p50"),
                            F.avg(inside).alias("coverage"))


def naive_baseline_mae(history: DataFrame, future: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """MAE of repeating each series' last observed value over its future rows (M2)."""
    k = cfg.keys
    last = history.groupBy(*k.series).agg(F.max_by(k.target, k.date).alias("_last"))
    act = actuals_by_step(future, cfg)
    j = act.join(last, k.series)
    return j.agg(F.count(F.lit(1)).alias("n_evaluated"),
                 F.avg(F.abs(F.col(k.target) - F.col("_last"))).alias("naive_mae"))


# ---- learned forecaster (M1(b), M5) ------------------------------------------------------

def direct_training_rows(df: DataFrame, cfg: ForecastConfig, unknown=("sales", "sell_price", "sales_lag_1",
                         "sales_rmean_7", "sales_rmean_30", "sales_rstd_7"), known=("day_of_week",)) -> DataFrame:
    """Pooled direct multi-horizon rows: for each decision row t and step h in 1..H the
    label y[t+h] with its ``label_date``, features known at t (y[t] itself and the price of t
    among them: the last price is carried in training as in scoring), calendar features of t+h
    and h itself.  Built by
    ``lead`` over the series window for each h (H projections of one window pass, then
    ``stack``-like explode) -- rows grow by H, which is the model's training set."""
    k = cfg.keys
    w = series_window(k)
    unknown = [c for c in unknown if c in df.columns]
    known = [c for c in known if c in df.columns]
    per_h = []
    for h in range(1, cfg.horizon + 1):
        per_h.append(F.struct(F.lit(h).alias("horizon_step"),
                              F.lead(k.target, h).over(w).alias("label"),
                              F.lead(k.date, h).over(w).alias("label_date"),
                              *[F.lead(c, h).over(w).alias(f"{c}_h") for c in known]))
    base = df.select(*k.series, k.date, *unknown, F.array(*per_h).alias("_h"))
    return (base.select(*k.series, k.date, *unknown, F.explode("_h").alias("_s"))
                .select("*", "_s.*").drop("_s").filter(F.col("label").isNotNull()))


def phase_labels(rows: DataFrame, validate_from, calibrate_from, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Add ``phase``: fit (label before ``validate_from``), validate (decided from then on, label
    before ``calibrate_from``), calibrate (decided from then on).  Rows whose label lies beyond
    the cut after their decision belong to no block and go, so no block sees another's labels."""
    d, label = F.col(cfg.keys.date), F.col("label_date")
    phase = (F.when(label < validate_from, "fit").when((d >= validate_from) & (label < calibrate_from), "validate")
              .when(d >= calibrate_from, "calibrate"))
    return rows.withColumn("phase", phase).where(F.col("phase").isNotNull())


def gbt_quantiles(rows: DataFrame, score_rows: DataFrame, cfg: ForecastConfig, feature_cols: list[str]):
    """Fit one GBTRegressor on the fit rows with early stopping on the validate rows (M5);
    conformal quantiles = per-step quantiles of the residuals of the calibrate rows, which the
    fit never saw (approx_percentile, bounded memory per step), added to the point forecast
    and clipped at 0 (M3)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from ..session import cut_lineage
    rows = cut_lineage(rows)   # read by the fit and by the calibration
    train = rows.where("phase <> 'calibrate'").withColumn("_val", F.col("phase") == "validate")
    asm = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=cfg.gbt_iterations,
                       maxDepth=cfg.gbt_depth, seed=cfg.seed, validationIndicatorCol="_val", validationTol=0.01)
    model = Pipeline(stages=[asm, gbt]).fit(train)
    held = model.transform(rows.where("phase = 'calibrate'"))
    resid = (held.groupBy("horizon_step")
                 .agg(*[F.percentile_approx(F.col("label") - F.col("prediction"), q, 10000)
                        .alias(f"r_{X.quantile_name(q)}") for q in cfg.quantiles]))
    scored = model.transform(score_rows).join(F.broadcast(resid), "horizon_step", "left")  # a row per step
    out = scored.withColumns({X.quantile_name(q): X.clip0(F.col("prediction")
                                                          + F.coalesce(F.col(f"r_{X.quantile_name(q)}"), F.lit(0.0)))
                              for q in cfg.quantiles})
    return model, out
