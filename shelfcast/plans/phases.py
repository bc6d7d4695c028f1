"""Phase orchestrators (G4, M6, the causal and evaluation runs).

Each phase is a function of DataFrames and configuration that chains the operators and
writes its result where the reference does (features -> Parquet partitioned by split,
predictions -> Parquet, report -> JSON).  No phase collects data to the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CausalConfig, FeatureConfig, ForecastConfig, SplitConfig
from ..operators import causal as ca
from ..operators import features as feat
from ..operators import forecast as fc
from ..operators import metrics as mt
from ..operators import panel as pn
from ..operators import split as sp
from ..session import cut_lineage
from ..sources import files


@dataclass(frozen=True)
class PhaseResult:
    output: DataFrame
    path: str | None
    seconds: float


def build_features(wide: DataFrame, calendar: DataFrame, prices: DataFrame, out_path: str | None = None,
                   cfg: FeatureConfig = FeatureConfig(), split: SplitConfig = SplitConfig(embargo_days=1),
                   sample_frac: float | None = None, narrow: bool = True) -> PhaseResult:
    """Phase 1 (G4): load and merge -> features -> split labels -> (narrowed) Parquet."""
    t0 = time.perf_counter()
    merged = pn.load_and_merge(wide, calendar, prices, sample_frac)
    labelled = sp.split_labels(feat.engineer_features(merged, cfg), split)
    if narrow:
        # one run of the feature plan: the ranges and the write both read its result
        labelled = pn.narrow_schema(cut_lineage(labelled))
    if out_path:
        files.write_splits(labelled, out_path, (cfg.keys.item, cfg.keys.store), cfg.keys.date)
        labelled = files.read_features(labelled.sparkSession, out_path)
    return PhaseResult(labelled, out_path, time.perf_counter() - t0)


def run_forecast(features: DataFrame, out_path: str | None = None,
                 cfg: ForecastConfig = ForecastConfig(), n_series: int | None = None,
                 model_path: str | None = None) -> PhaseResult:
    """Phase 2 (M6): time index, casts and sampling (D1, P8) -> fit/validate cut (D2) -> fitted
    forecaster, saved if ``model_path`` is given (K4) -> p10/p50/p90 for every series and step
    after its fit window (M1, M3) -> Parquet (K2).  Steps that were observed carry date and
    actual, the others NULL, so ``forecast_report`` gives MAE / coverage / width (A7, A8)."""
    t0 = time.perf_counter()
    from ..operators.windows import add_time_index, cast_for_model, fit_validate_cut
    timed = cast_for_model(add_time_index(features), categoricals=("day_of_week", "month", "year"))
    df = pn.sample_n_series(timed, n_series, cfg.keys)
    cut = fit_validate_cut(df, cfg.horizon)
    hist = cut.filter(F.col("phase") == "fit")
    fut = cut.filter(F.col("phase") == "validate")
    fitted = fc.fit_seasonal(hist, cfg)
    if model_path:
        files.save_predictions(fitted, model_path)
        fitted = features.sparkSession.read.parquet(model_path)
    pred = fc.join_actuals(fc.predict_seasonal(fitted, cfg), fut, cfg, how="left")
    if out_path:
        files.save_predictions(pred, out_path)
        pred = features.sparkSession.read.parquet(out_path)
    return PhaseResult(pred, out_path, time.perf_counter() - t0)


def forecast_report(predictions: DataFrame) -> DataFrame:
    """One-row summary of a forecast run: all predictions and those with actuals, MAE and
    coverage over the latter, interval width and median p50 over all."""
    from ..operators.common import exact_quantile
    return predictions.agg(
        F.count(F.lit(1)).alias("n_predictions"), F.count("sales").alias("n_evaluated"),
        F.avg(F.abs(F.col("sales") - F.col("p50"))).alias("mae_p50"),
        mt.coverage_expr().alias("coverage"),
        F.avg(F.col("p90") - F.col("p10")).alias("mean_interval_width")
    ).withColumn("median_p50", exact_quantile(predictions, "p50", 0.5))


def run_causal(rows: DataFrame, cfg: CausalConfig = CausalConfig(), out_path: str | None = None,
               series: tuple = ("item_id", "store_id", "cat_id")) -> tuple[DataFrame, DataFrame]:
    """Phase 3: cross-fitted residuals -> per-segment effects -> ATE summary.  With ``out_path``
    the per-series elasticity table that phase 4 reads is written there."""
    r = cut_lineage(ca.cell_mean_residuals(rows, cfg)) if out_path else ca.cell_mean_residuals(rows, cfg)
    fx = ca.segment_effects(r, cfg)
    ate = ca.ate_summary(ca.row_effects(r, fx, list(cfg.segment)))
    if out_path:
        files.save_predictions(series_elasticity(r, cfg, series), out_path)
    return fx, ate


def series_elasticity(resid: DataFrame, cfg: CausalConfig, series=("item_id", "store_id", "cat_id")) -> DataFrame:
    """Elasticity table (series columns, tau, effect, n) of all series whose price varies."""
    fx = ca.segment_effects(resid, cfg, segment=list(series))
    return fx.filter(F.col("tau").isNotNull()).select(*series, "tau", "effect", "n")


def run_prescriptive(predictions: DataFrame, elasticities: DataFrame, delta_p: float,
                     out_path: str | None = None) -> PhaseResult:
    """Phase 4 fusion: forecasts and the elasticity table of phase 3 -> price-adjusted demand."""
    t0 = time.perf_counter()
    from ..operators.prescriptive import prescriptive_forecast
    out = prescriptive_forecast(predictions, elasticities, delta_p)
    if out_path:
        files.save_predictions(out, out_path)
        out = predictions.sparkSession.read.parquet(out_path)
    return PhaseResult(out, out_path, time.perf_counter() - t0)


def run_evaluation(forecasts: DataFrame, history: DataFrame, out_path: str | None = None,
                   mode: str = "per_series") -> PhaseResult:
    """Phase 4 (E5): report by grouping sets, optionally written as one JSON document."""
    t0 = time.perf_counter()
    rep = mt.evaluation_report(forecasts.where(F.col("sales").isNotNull()), history, mode=mode)
    if out_path:
        mt.write_report_json(rep, out_path)
    return PhaseResult(rep, out_path, time.perf_counter() - t0)
