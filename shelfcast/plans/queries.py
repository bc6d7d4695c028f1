"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator of the
inventory.  Each reads the driver tables of ``sf_dir`` whole and runs the library
operator; the last projection only names and rounds columns (6 decimals where two
engines can differ in the last bit) so the result compares with the DuckDB oracle."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..sources import driver_tables as dt
from ..sources.scope import memo
from . import context as ctx
from .context import r6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register ``fn`` under ``name``; each call runs inside its own input scope."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf):
            with ctx.query_scope():
                return fn(spark, sf)
        QUERIES[name] = run
        return fn
    return deco


K = ["item_id", "store_id", "date"]


@query("panel_view")
def panel_view(spark, sf):
    return ctx.raw_panel(spark, sf)


@query("lag_features")
def lag_features(spark, sf):
    p = ctx.raw_panel(spark, sf).select(*K, "sales")
    return feat.add_lag_features(p, ctx.FEATURES.lag_days)


@query("rolling_mean")
def rolling_mean(spark, sf):
    p = feat.add_rolling_features(ctx.raw_panel(spark, sf).select(*K, "sales"))
    return p.select(*K, r6("sales_rmean_7").alias("sales_rmean_7"),
                    r6("sales_rmean_30").alias("sales_rmean_30"))


@query("rolling_std")
def rolling_std(spark, sf):
    p = feat.add_rolling_features(ctx.raw_panel(spark, sf).select(*K, "sales"))
    return p.select(*K, r6("sales_rstd_7").alias("sales_rstd_7"),
                    r6("sales_rstd_30").alias("sales_rstd_30"))


@query("rolling_minmax")
def rolling_minmax(spark, sf):
    p = feat.add_rolling_features(ctx.raw_panel(spark, sf).select(*K, "sales"))
    return p.select(*K, "sales_rmin_7", "sales_rmax_7", "sales_rmin_30", "sales_rmax_30")


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (report projection only)."""
    return df.select(*[r6(f.name).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


@query("full_features")
def full_features(spark, sf):
    """The 45-column feature table (G1) with the default settings."""
    return round_doubles(ctx.features(spark, sf))


@query("entry_features")
def entry_features(spark, sf):
    """Feature table with short lags (1, 7), one 7-row rolling window and a 5-row
    warm-up, for tables whose series are short (the sf0.001 smoke run)."""
    from ..config import FeatureConfig
    cfg = FeatureConfig(lag_days=(1, 7), rolling_windows=(7,), warmup_days=5,
                        state_flags=ctx.PANEL_FLAGS)
    return round_doubles(ctx.features(spark, sf, cfg))


@query("calendar_features")
def calendar_features(spark, sf):
    return feat.add_calendar_features(ctx.calendar(spark, sf).select("date"))


def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    from ..session import scratch_path
    return scratch_path(spark, f"tables/{name}")


@query("load_calendar")
def load_calendar(spark, sf):
    """The derived calendar written as a CSV file, then read back by the calendar reader
    (S1: explicit schema, typed date, 'NoEvent' fill, has_event)."""
    from ..sources import driver_tables as dt
    from ..sources import files
    path = _scratch(spark, "calendar") + "/calendar.csv"
    cols = files.CALENDAR_SCHEMA_COLUMNS
    dt.raw_calendar(spark, sf).select(*cols).write.option("header", True).csv(path)
    return files.load_calendar(spark, path)


@query("event_flags")
def event_flags(spark, sf):
    return ctx.calendar(spark, sf).select("date", "event_name_1", "event_type_1",
                                          "event_name_2", "event_type_2", "has_event")


@query("state_flag_select")
def state_flag_select(spark, sf):
    df = feat.add_snap_features(ctx.panel_with_calendar(spark, sf), ctx.PANEL_FLAGS)
    return df.select("item_id", "store_id", "date", "state_id", "snap_eligible")


@query("price_change")
def price_change(spark, sf):
    df = feat.add_price_features(ctx.raw_panel(spark, sf).drop("dept_id"))
    return df.select(*K, r6("price_change_abs").alias("price_change_abs"),
                     r6("price_change_pct").alias("price_change_pct"))


@query("price_momentum")
def price_momentum(spark, sf):
    df = feat.add_price_features(ctx.raw_panel(spark, sf).drop("dept_id"))
    return df.select(*K, r6("price_momentum_7d").alias("price_momentum_7d"))


@query("price_rel_to_dept")
def price_rel_to_dept(spark, sf):
    df = feat.add_price_features(ctx.panel(spark, sf))
    return df.select(*K, "dept_id", r6("price_rel_to_dept").alias("price_rel_to_dept"))


@query("warmup_cut")
def warmup_cut(spark, sf):
    return feat.drop_warmup(ctx.raw_panel(spark, sf).select(*K, "sales"), 30)


def _dense(spark, sf):
    from ..operators.windows import densify
    return densify(ctx.panel(spark, sf).select(*K, "sales", "sell_price"))


@query("densify_panel")
def densify_panel(spark, sf):
    return _dense(spark, sf).select(*K, "sales", "sell_price")


@query("price_ffill")
def price_ffill(spark, sf):
    return feat.forward_fill(_dense(spark, sf), ["sell_price"]).select(*K, "sell_price")


@query("null_policy")
def null_policy(spark, sf):
    """Null policy (ffill price columns, zero-fill numerics, warm-up 30) on the densified
    panel, where inserted days have no price."""
    from pyspark.sql import Window
    from ..config import FeatureConfig
    d = _dense(spark, sf)
    w = Window.partitionBy("item_id", "store_id").orderBy("date")
    prev = F.lag("sell_price", 1).over(w)
    d = d.withColumns({"price_change_abs": F.col("sell_price") - prev,
                       "price_change_pct": F.try_divide(F.col("sell_price") - prev, F.nullif(prev, F.lit(0)))})
    d = feat.add_lag_features(d, (1, 7))
    out = feat.handle_missing_values(d, FeatureConfig(warmup_days=30))
    return round_doubles(out)


# ---- loading, melt, joins, sampling ----------------------------------------------------

def _melted(spark, sf):
    from ..operators.panel import melt_sales
    from ..sources import driver_tables as dt
    return melt_sales(dt.wide_sales(spark, sf))


@query("load_prices")
def load_prices(spark, sf):
    """Weekly prices written as a CSV file and read back by the price reader."""
    from ..sources import driver_tables as dt
    from ..sources import files
    path = _scratch(spark, "prices") + "/sell_prices.csv"
    dt.weekly_prices(spark, sf).write.option("header", True).csv(path)
    return files.load_prices(spark, path)


@query("csv_sales_melt")
def csv_sales_melt(spark, sf):
    """Wide sales matrix written as the reference's sales CSV; the reader picks the first
    existing candidate file (S4), reads the header-named day columns (S3) and the matrix
    is melted (P1)."""
    from ..operators.panel import melt_sales
    from ..sources import driver_tables as dt
    from ..sources import files
    folder = _scratch(spark, "raw")
    dt.wide_sales(spark, sf).write.option("header", True).csv(f"{folder}/sales_train_validation.csv")
    return melt_sales(files.load_wide_sales(spark, folder))


@query("melt_sales")
def melt_sales_q(spark, sf):
    """Wide day-column matrix -> long (P1, P2, S3: the composite id is pruned)."""
    return _melted(spark, sf)


@query("panel_calendar_join")
def panel_calendar_join(spark, sf):
    from ..operators.panel import join_calendar
    return join_calendar(_melted(spark, sf), ctx.calendar(spark, sf))


@query("panel_merged")
def panel_merged(spark, sf):
    """Master loader G2: melt -> calendar join (J1) -> weekly price join."""
    from ..operators.panel import load_and_merge
    from ..sources import driver_tables as dt
    return load_and_merge(dt.wide_sales(spark, sf), ctx.calendar(spark, sf), dt.weekly_prices(spark, sf))


@query("panel_price_join")
def panel_price_join(spark, sf):
    from ..operators.panel import join_prices
    from ..sources import driver_tables as dt
    p = ctx.panel(spark, sf).select("item_id", "store_id", "date")
    p = p.join(ctx.calendar(spark, sf).select("date", "wm_yr_wk"), "date")
    return join_prices(p, dt.weekly_prices(spark, sf)).select(*K, "wm_yr_wk", "sell_price")


@query("sample_series_frac")
def sample_series_frac(spark, sf):
    """Sample 20 % of the series on the wide matrix, then melt."""
    from ..operators.panel import melt_sales, sample_series_fraction
    from ..sources import driver_tables as dt
    return melt_sales(sample_series_fraction(dt.wide_sales(spark, sf), 0.2))


@query("sample_n_series")
def sample_n_series_q(spark, sf):
    from ..operators.panel import sample_n_series
    return sample_n_series(ctx.panel(spark, sf), 100)


@query("dropna_required")
def dropna_required(spark, sf):
    from ..operators.panel import drop_incomplete
    p = feat.add_lag_features(ctx.raw_panel(spark, sf), (7,))
    return drop_incomplete(p, ["item_id", "store_id", "date", "sales", "sell_price", "sales_lag_7"])


@query("filter_series")
def filter_series(spark, sf):
    return ctx.raw_panel(spark, sf).filter(F.col("state_id") == "ASIA")


def _timed(spark, sf):
    from ..operators.windows import add_time_index
    return add_time_index(ctx.panel_with_calendar(spark, sf))


@query("time_index")
def time_index(spark, sf):
    return _timed(spark, sf).select(*K, "d", "time_idx")


@query("time_index_from_dates")
def time_index_from_dates(spark, sf):
    from ..operators.windows import add_time_index
    return add_time_index(ctx.panel(spark, sf).select(*K)).select(*K, "time_idx")


@query("series_counts")
def series_counts(spark, sf):
    p = ctx.raw_panel(spark, sf)
    return p.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("item_id", "store_id").alias("n_series"),
                 F.count_distinct("item_id").alias("n_items"),
                 F.count_distinct("store_id").alias("n_stores"),
                 F.count_distinct("cat_id").alias("n_categories"))


@query("narrow_schema_ranges")
def narrow_schema_ranges(spark, sf):
    from ..operators.panel import integer_ranges
    return integer_ranges(ctx.features(spark, sf))


# ---- temporal splits -------------------------------------------------------------------

from ..config import SplitConfig  # noqa: E402
from ..operators import split as sp  # noqa: E402

PIPE_SPLIT = SplitConfig(embargo_days=1)
CV_SPLIT = SplitConfig(embargo_days=1, n_folds=3)


@query("temporal_split")
def temporal_split(spark, sf):
    lab = sp.split_labels(ctx.panel(spark, sf).select(*K, "sales"), PIPE_SPLIT)
    return lab.filter(F.col("split").isNotNull())


@query("rolling_folds")
def rolling_folds(spark, sf):
    return sp.rolling_folds(ctx.panel(spark, sf).select(*K, "sales"), CV_SPLIT)


@query("leakage_check")
def leakage_check(spark, sf):
    return sp.leakage_check(sp.rolling_folds(ctx.panel(spark, sf).select(*K, "sales"), CV_SPLIT))


@query("split_summary")
def split_summary(spark, sf):
    return sp.split_summary(ctx.panel(spark, sf), CV_SPLIT)


# ---- forecast dataset preparation -------------------------------------------------------

@query("fit_validate_cut")
def fit_validate_cut(spark, sf):
    from ..operators.windows import fit_validate_cut as cut
    return cut(_timed(spark, sf), 30).select(*K, "time_idx", "phase")


@query("group_normalize")
def group_normalize(spark, sf):
    from ..operators.windows import apply_group_normalizer, group_normalizer
    p = ctx.panel(spark, sf).select(*K, "sales")
    out = apply_group_normalizer(p, group_normalizer(p), value="sales")
    return out.select(*K, r6("target_norm").alias("target_norm"),
                      r6("target_center").alias("target_center"),
                      r6("target_scale").alias("target_scale"))


@query("window_samples")
def window_samples(spark, sf):
    from ..config import ForecastConfig
    from ..operators.windows import window_samples as ws
    cfg = ForecastConfig(horizon=14, max_encoder_length=30, min_encoder_length=14)
    t = _timed(spark, sf).withColumn("day_of_week", F.weekday("date"))
    s = ws(t, cfg, known=("day_of_week",), unknown=("sales",))
    return s.select(*K, "time_idx", "encoder_length",
                    F.size("decoder").alias("decoder_length"),
                    F.col("encoder")[0]["time_idx"].alias("encoder_first_idx"),
                    F.col("encoder_relative_idx")[0].alias("encoder_first_rel"),
                    F.aggregate("encoder", F.lit(0.0), lambda a, x: a + x["sales"]).alias("encoder_sales"),
                    F.element_at("decoder", -1)["time_idx"].alias("decoder_last_idx"),
                    F.aggregate("decoder", F.lit(0).cast("bigint"),
                                lambda a, x: a + x["day_of_week"]).alias("decoder_dow_sum"))


@query("encoder_context")
def encoder_context(spark, sf):
    from ..operators.windows import encoder_context as ec
    train, test = sp.single_split(_timed(spark, sf).select(*K, "time_idx"), PIPE_SPLIT)
    return ec(train, test, 30).select(*K, "time_idx", "part")


@query("prediction_windows")
def prediction_windows(spark, sf):
    """One encoder (30 rows before the test window) and decoder (14 test rows) per series."""
    from ..config import ForecastConfig
    from ..operators.windows import encoder_context as ec
    from ..operators.windows import prediction_windows as pw
    cfg = ForecastConfig(horizon=14, max_encoder_length=30, min_encoder_length=1)
    t = _timed(spark, sf).withColumn("day_of_week", F.weekday("date")).select(*K, "time_idx", "day_of_week", "sales")
    train, test = sp.single_split(t, PIPE_SPLIT)
    out = pw(ec(train, test, 90), cfg)
    return out.select("item_id", "store_id", "encoder_length", "decoder_length",
                      F.col("encoder")[0]["time_idx"].alias("encoder_first_idx"),
                      F.aggregate("encoder", F.lit(0.0), lambda a, x: a + x["sales"]).alias("encoder_sales"),
                      F.element_at("decoder", -1)["time_idx"].alias("decoder_last_idx"))


# ---- forecasts and backtest metrics -----------------------------------------------------

from ..operators import forecast as fc  # noqa: E402
from ..operators import metrics as mt  # noqa: E402


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


@query("forecast_seasonal_quantiles")
def forecast_seasonal_quantiles(spark, sf):
    """Seasonal-empirical p10/p50/p90 for 28 steps after each series' history (M1, M3)."""
    return _round(ctx.forecasts(spark, sf), ["p10", "p50", "p90"])


@query("forecast_interval_stats")
def forecast_interval_stats(spark, sf):
    return _round(fc.interval_stats(ctx.forecasts(spark, sf)), ["mean_interval_width", "median_p50"])


@query("forecast_mae_coverage")
def forecast_mae_coverage(spark, sf):
    return _round(fc.mae_coverage(ctx.forecasts_with_actuals(spark, sf)), ["mae_p50", "coverage"])


@query("naive_baseline_mae")
def naive_baseline_mae(spark, sf):
    hist, fut = ctx.history_future(spark, sf)
    return _round(fc.naive_baseline_mae(hist, fut, ctx.backtest_config()), ["naive_mae"])


@query("wql")
def wql(spark, sf):
    f = ctx.forecasts_with_actuals(spark, sf)
    return _round(f.agg(mt.wql_expr("sales", "p10", 0.1).alias("WQL_10"),
                        mt.wql_expr("sales", "p50", 0.5).alias("WQL_50"),
                        mt.wql_expr("sales", "p90", 0.9).alias("WQL_90")), ["WQL_10", "WQL_50", "WQL_90"])


@query("coverage")
def coverage(spark, sf):
    f = ctx.forecasts_with_actuals(spark, sf)
    c = f.agg(mt.coverage_expr().alias("coverage_pct"))
    c = c.withColumn("coverage_error", F.abs(F.col("coverage_pct") - 0.8))
    return _round(c, ["coverage_pct", "coverage_error"])


@query("mase_series")
def mase_series(spark, sf):
    hist, _ = ctx.history_future(spark, sf)
    return _round(mt.mase_series(ctx.forecasts_with_actuals(spark, sf), hist), ["mae", "MASE"])


_REPORT_COLS = ["WQL_10", "WQL_50", "WQL_90", "coverage_pct", "coverage_error", "MASE"]


@query("eval_report")
def eval_report(spark, sf):
    """Global / by-category / by-store report with per-series seasonal differences."""
    hist, _ = ctx.history_future(spark, sf)
    return _round(mt.evaluation_report(ctx.forecasts_with_actuals(spark, sf), hist), _REPORT_COLS)


@query("mase_by_slice")
def mase_by_slice(spark, sf):
    """The same report with the reference's flattened history per slice (E4 parity)."""
    hist, _ = ctx.history_future(spark, sf)
    return _round(mt.evaluation_report(ctx.forecasts_with_actuals(spark, sf), hist, mode="flattened"),
                  _REPORT_COLS)


@query("eval_report_json")
def eval_report_json(spark, sf):
    hist, _ = ctx.history_future(spark, sf)
    return mt.report_json(mt.evaluation_report(ctx.forecasts_with_actuals(spark, sf), hist))


@query("null_audit")
def null_audit(spark, sf):
    d = feat.add_lag_features(_dense(spark, sf), (1, 7, 14, 30))
    return mt.null_audit(d)


# ---- causal elasticity ------------------------------------------------------------------

from ..operators import causal as ca  # noqa: E402
from ..operators import prescriptive as pr  # noqa: E402


@query("dml_folds")
def dml_folds(spark, sf):
    p = ctx.raw_panel(spark, sf).select("item_id", "store_id").distinct()
    return ca.add_folds(p, ctx.causal_config())


@query("dml_residuals")
def dml_residuals(spark, sf):
    r = ctx.residuals(spark, sf)
    return _round(r.select(*K, "fold", "m_y", "m_t", "r_y", "r_t"), ["m_y", "m_t", "r_y", "r_t"])


_FX = ["effect", "se", "ci_lower", "ci_upper", "tau", "p_value"]


@query("dml_segment_cate")
def dml_segment_cate(spark, sf):
    return _round(ca.segment_effects(ctx.residuals(spark, sf), ctx.causal_config()), _FX)


@query("dml_ate")
def dml_ate(spark, sf):
    r = ctx.residuals(spark, sf)
    fx = ca.segment_effects(r, ctx.causal_config())
    return _round(ca.ate_summary(ca.row_effects(r, fx, ["cat_id"])), ["ATE", "ci_lower", "ci_upper"])


@query("series_elasticity")
def series_elasticity(spark, sf):
    return _round(ctx.series_elasticities(spark, sf), ["tau", "effect"])


@query("dml_linear_cate")
def dml_linear_cate(spark, sf):
    """theta(x) = b0 + b1 * relative price, from one aggregate of cross products."""
    beta, _ = ca.linear_effects(ctx.residuals(spark, sf), ["price_rel_to_dept"], ctx.causal_config())
    out = spark.range(1).select(F.lit(beta[0]).alias("b0"), F.lit(beta[1]).alias("b1"))
    return _round(out, ["b0", "b1"])


@query("dml_binary_ate")
def dml_binary_ate(spark, sf):
    """Effect of a price cut (price below the previous row's) on units."""
    d = ctx.causal_input(spark, sf)
    out = ca.binary_treatment_ate(d, F.col("price_change_pct") < 0, ctx.causal_config())
    return _round(out, ["point_estimate", "se", "ci_lower", "ci_upper", "p_value"])


@query("standardize")
def standardize(spark, sf):
    p = ctx.panel(spark, sf).select(*K, "sales", "sell_price")
    z = ca.standardize(p, ["sales", "sell_price"])
    return _round(z, ["sales", "sell_price"])


@query("ordinal_encode")
def ordinal_encode(spark, sf):
    """Item codes fitted on the history window, applied to every row (unseen -> -1)."""
    hist, _ = ctx.history_future(spark, sf)
    dic = ca.ordinal_dictionary(hist, "item_id")
    return ca.ordinal_encode(ctx.panel(spark, sf).select(*K), dic, "item_id").select(*K, "item_id_code")


@query("dml_forest_cate")
def dml_forest_cate(spark, sf):
    _, rows, _ = ca.forest_effects(ctx.residuals(spark, sf), ["price_rel_to_dept", "day_of_week", "has_event"],
                                   ctx.causal_config())
    return rows.select(*K, "effect", "ci_lower", "ci_upper", F.col("_clipped").alias("rt_clipped"))


@query("cate_importance")
def cate_importance(spark, sf):
    _, _, imp = ca.forest_effects(ctx.residuals(spark, sf), ["price_rel_to_dept", "day_of_week", "has_event"],
                                  ctx.causal_config())
    return imp


@query("dml_gbt")
def dml_gbt(spark, sf):
    d = ctx.causal_input(spark, sf).withColumn("has_event_d", F.col("has_event").cast("double"))
    r = ca.gbt_residuals(d, ["day_of_week", "has_event_d", "price_rel_to_dept"], ctx.causal_config())
    fx = ca.segment_effects(r, ctx.causal_config())
    return fx


# ---- prescriptive and what-if --------------------------------------------------------------

@query("tau_by_category")
def tau_by_category(spark, sf):
    return _round(pr.category_tau(ctx.series_elasticities(spark, sf)), ["cat_tau"])


@query("elasticity_fallback")
def elasticity_fallback(spark, sf):
    out = pr.resolve_tau(ctx.forecasts(spark, sf), ctx.series_elasticities(spark, sf))
    return _round(out.select("item_id", "store_id", "cat_id", "horizon_step", "tau", "tau_source"), ["tau"])


_FINAL = ["p10", "p50", "p90", "tau", "final_p10", "final_p50", "final_p90"]


@query("prescriptive_forecast")
def prescriptive_forecast(spark, sf):
    out = ctx.prescriptive(spark, sf, -0.10)
    return _round(out.select("item_id", "store_id", "cat_id", "horizon_step", *_FINAL), _FINAL)


@query("whatif_grid")
def whatif_grid(spark, sf):
    g = pr.whatif_grid(ctx.forecasts(spark, sf), ctx.series_elasticities(spark, sf))
    cols = ["delta_p", "final_p10", "final_p50", "final_p90"]
    return _round(g.select("item_id", "store_id", "horizon_step", *cols), cols)


def _base_price(spark, sf):
    hist, _ = ctx.history_future(spark, sf)
    return hist.groupBy("item_id", "store_id").agg(F.max_by("sell_price", "date").alias("base_price"))


_WS = ["delta_p", "tau", "base_price", "new_price", "min_downside"]
_WS2 = ["base_volume", "new_volume", "base_revenue", "new_revenue", "revenue_impact"]


@query("whatif_summary")
def whatif_summary(spark, sf):
    # elasticities first: the large tables behind them are gone when the forecasts are made
    elasticities = ctx.series_elasticities(spark, sf)
    s = pr.whatif_summary(ctx.forecasts(spark, sf), elasticities, _base_price(spark, sf))
    return _round(s, _WS).withColumns({c: ctx.r2(c) for c in _WS2})


@query("safety_stock")
def safety_stock(spark, sf):
    s = pr.safety_stock(ctx.prescriptive(spark, sf, -0.10), "p90")
    return _round(s.select("item_id", "store_id", "horizon_step", "target_stock"), ["target_stock"])


@query("fan_chart_points")
def fan_chart_points(spark, sf):
    hist, _ = ctx.history_future(spark, sf)
    out = pr.fan_chart_points(hist, ctx.prescriptive(spark, sf, -0.10), n_history=30)
    return _round(out, ["value"])


# ---- sinks and the learned forecaster ----------------------------------------------------

@query("sink_roundtrip")
def sink_roundtrip(spark, sf):
    """Write the split-labelled panel as snappy Parquet partitioned by split into the
    shared checkpoint folder (K1), then read it back (S5)."""
    from ..sources import files
    path = _scratch(spark, "sink-roundtrip")
    lab = sp.split_labels(ctx.panel(spark, sf).select(*K, "sales"), PIPE_SPLIT)
    files.write_splits(lab, path)
    return files.read_features(spark, path).select(*K, "sales", "split")


@query("forecast_gbt_quantiles")
def forecast_gbt_quantiles(spark, sf):
    """Pooled direct multi-horizon GBT (7 steps) on the feature table: fitted on labels before
    the last 56 days, early stopping on decisions and labels of the 28 days after that,
    conformal p10/p50/p90 from decisions of the last 28 days, for the 7 steps after the last row of each
    series that has rows after the 30-row warm-up (M1(b), M5)."""
    from ..config import ForecastConfig
    cfg = ForecastConfig(horizon=7, gbt_iterations=10, gbt_depth=5)
    f = ctx.features(spark, sf, materialize=True)
    last = f.agg(F.max("date")).first()[0]
    rows = fc.phase_labels(fc.direct_training_rows(f, cfg), F.date_sub(F.lit(last), 56), F.date_sub(F.lit(last), 28), cfg)
    at_decision = ["sales", "sell_price", "sales_lag_1", "sales_rmean_7", "sales_rmean_30", "sales_rstd_7"]
    feats = [*at_decision, "day_of_week_h", "horizon_step"]
    latest = f.groupBy("item_id", "store_id").agg(F.max("date").alias("date"))
    base = f.join(latest, ["item_id", "store_id", "date"], "left_semi")
    score = (base.select("item_id", "store_id", "date", *at_decision,
                         F.explode(F.sequence(F.lit(1), F.lit(cfg.horizon))).alias("horizon_step"))
                 .withColumn("day_of_week_h", F.weekday(F.date_add("date", F.col("horizon_step")))))
    _, out = fc.gbt_quantiles(rows, score, cfg, feats)
    return out.select("item_id", "store_id", "horizon_step", "p10", "p50", "p90")


@query("events_panel_features")
def events_panel_features(spark, sf):
    """Lag and rolling features on the events panel with renamed keys (series = user x
    event type, date = day, target = number of events): the operators take the column
    names from ``PanelKeys``."""
    from ..config import PanelKeys
    from ..sources import driver_tables as dt
    keys = PanelKeys(item="event_type", store="user_id", date="day", target="n_events")
    p = feat.add_rolling_features(feat.add_lag_features(dt.events_panel(spark, sf), (1, 7), keys), (7,), keys)
    return p.select("user_id", "event_type", "day", "n_events", r6("value_sum").alias("value_sum"),
                    "n_events_lag_1", "n_events_lag_7", r6("n_events_rmean_7").alias("n_events_rmean_7"),
                    r6("n_events_rstd_7").alias("n_events_rstd_7"), "n_events_rmax_7")


@query("drop_counts")
def drop_counts(spark, sf):
    """Rows removed by the 30-row warm-up cut and by dropping rows without a 7-row lag."""
    from ..operators.panel import drop_incomplete
    p = ctx.panel(spark, sf).select(*K, "sales")
    warm = mt.drop_counts(p, feat.drop_warmup(p, 30), "warmup")
    lagged = feat.add_lag_features(p, (7,))
    req = mt.drop_counts(lagged, drop_incomplete(lagged, [*K, "sales", "sales_lag_7"]), "dropna")
    return warm.unionByName(req)


@query("forecast_run_report")
def forecast_run_report(spark, sf):
    """Phase-2 orchestrator end to end (M6): feature table -> time index -> fit/validate
    cut at max(time_idx) - 28 -> seasonal quantiles after the fit window -> actuals of
    the validation rows -> MAE, coverage, interval width, median."""
    from . import phases
    pred = phases.run_forecast(ctx.features(spark, sf, materialize=True), None, ctx.backtest_config()).output
    return _round(phases.forecast_report(pred),
                  ["mae_p50", "coverage", "mean_interval_width", "median_p50"])


# ---- series that grow with the data --------------------------------------------------------

def _on_parts(name: str, fn):
    """The query ``fn`` on the panel of (part, supplier region) series, whose number grows with
    the scale factor (brand and nation give 625 series at any size)."""
    @query(f"part_{name}")
    def run(spark, sf):
        memo(("panel", sf), lambda: dt.part_panel(spark, sf))
        return fn(spark, sf)
    run.__doc__ = f"``{name}`` on the (part, region) panel."
    return run


for _name, _fn in (("panel_view", panel_view), ("entry_features", entry_features),
                   ("forecast_seasonal_quantiles", forecast_seasonal_quantiles), ("series_elasticity", series_elasticity),
                   ("prescriptive_forecast", prescriptive_forecast), ("whatif_summary", whatif_summary)):
    _on_parts(_name, _fn)

from . import model_queries  # noqa: E402,F401  registers its queries here
