"""Registered queries of the fitted models, backtests and growing tables (see ``queries``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ForecastConfig, SplitConfig
from ..operators import backtest as bt
from ..operators import causal as ca
from ..operators import effects as ef
from ..operators import forecast as fc
from ..session import scratch_path
from ..sources import files, models
from . import context as ctx
from .context import r6
from .queries import K, _timed, query

EFFECT = ["effect", "se", "ci_lower", "ci_upper"]


def _rounded(df, *cols):
    return df.withColumns({c: r6(c) for c in cols})


def _linear(spark, sf):
    return ef.fit_linear(ctx.residuals(spark, sf), ["price_rel_to_dept"], ctx.causal_config())


@query("dml_linear_rows")
def dml_linear_rows(spark, sf):
    """theta(x) = b0 + b1 * relative price of every row with its robust interval (C4 b)."""
    r = ctx.residuals(spark, sf)
    rows = ef.fit_linear(r, ["price_rel_to_dept"], ctx.causal_config()).effect(r)
    return _rounded(rows.select(*K, *EFFECT), *EFFECT)


@query("dml_linear_saved")
def dml_linear_saved(spark, sf):
    """The same, fitted, saved, loaded and then applied (K4)."""
    path = models.save_fitted(spark, _linear(spark, sf), scratch_path(spark, "models/linear"))
    rows = models.load_fitted(spark, path).effect(ctx.residuals(spark, sf))
    return _rounded(rows.select(*K, *EFFECT), *EFFECT)


@query("dml_honest_forest")
def dml_honest_forest(spark, sf):
    """Honest forest effects of every row (C1, C4 c)."""
    r = ctx.residuals(spark, sf)
    model = ef.fit_honest_forest(r, ["price_rel_to_dept", "day_of_week", "has_event"], ctx.causal_config(), n_groups=4)
    return model.effect(r).select(*K, *EFFECT)


@query("dml_doubly_robust")
def dml_doubly_robust(spark, sf):
    """Effect on sales of a price cut and of a price rise against the same price as on the series' row before,
    by category, from learned propensities (C6)."""
    d = ctx.causal_input(spark, sf).where("price_change_pct is not null")
    d = d.withColumn("move", F.when(F.col("price_change_pct") < -0.05, "cut").when(F.col("price_change_pct") > 0.05, "rise").otherwise("same"))
    fx, _ = ef.doubly_robust(d, "move", ["same", "cut", "rise"], ["day_of_week", "has_event", "price_rel_to_dept"], ctx.causal_config(),
                             segment=("cat_id",))
    return fx


@query("forecast_learned_quantiles")
def forecast_learned_quantiles(spark, sf):
    """Pooled quantile-loss model on normalised targets (M1, D3): fitted on all decisions whose labels lie before
    the last 7 days, p10/p50/p90 for the 7 steps after the last row of each series."""
    from ..operators.quantile_model import fit_quantiles
    cfg = ForecastConfig(horizon=7)
    f = ctx.features(spark, sf, materialize=True)
    last = f.agg(F.max("date")).first()[0]
    rows = fc.direct_training_rows(f, cfg).where(F.col("label_date") <= F.date_sub(F.lit(last), 7))
    model = fit_quantiles(rows, cfg)
    latest = f.groupBy("item_id", "store_id").agg(F.max("date").alias("date"))
    score = (f.join(latest, K, "left_semi").select(*K, *model.levels, *model.spreads, F.explode(F.sequence(F.lit(1), F.lit(7))).alias("horizon_step"))
              .withColumn("day_of_week_h", F.weekday(F.date_add("date", F.col("horizon_step")))))
    return model.predict(score).select("item_id", "store_id", "horizon_step", "p10", "p50", "p90")


BACKTEST_SPLIT = SplitConfig(test_days=28, n_folds=3, step_days=28, embargo_days=1)


@query("fold_backtest")
def fold_backtest(spark, sf):
    """Seasonal quantile forecasts of three rolling folds, scored by fold (T2, M1, E5), from one scan."""
    p = ctx.panel(spark, sf).select(*K, "sales")
    rep = bt.fold_report(bt.fold_forecasts(p, BACKTEST_SPLIT, ctx.backtest_config()), ctx.backtest_config())
    return _rounded(rep, "mae", "bias", "coverage", "wql")


@query("best_model_per_series")
def best_model_per_series(spark, sf):
    """The point forecaster with the least error on the last 28 days, per series, beside the naive one's (M2, M5)."""
    hist, val = ctx.history_future(spark, sf)
    cfg = ctx.backtest_config()
    return _rounded(bt.best_per_series(bt.point_candidates(hist, cfg), val, cfg), "val_mae", "naive_mae")


@query("sample_slices")
def sample_slices(spark, sf):
    """The samples of ``window_samples`` from chunks that hold every row once, written and read back."""
    from ..operators.sample_slices import read_samples
    from ..operators.sample_slices import sample_slices as slices
    from ..session import cut_lineage
    cfg = ForecastConfig(horizon=14, max_encoder_length=30, min_encoder_length=14)
    t = _timed(spark, sf).withColumn("day_of_week", F.weekday("date"))
    s = read_samples(cut_lineage(slices(t, cfg, ("day_of_week",), ("sales",), chunk=256)), cfg, ("day_of_week",), ("sales",))
    return s.select(*K, "time_idx", "encoder_length", F.size("decoder").alias("decoder_length"),
                    F.col("encoder")[0]["time_idx"].alias("encoder_first_idx"), F.col("encoder_relative_idx")[0].alias("encoder_first_rel"),
                    F.aggregate("encoder", F.lit(0.0), lambda a, x: a + x["sales"]).alias("encoder_sales"),
                    F.element_at("decoder", -1)["time_idx"].alias("decoder_last_idx"),
                    F.aggregate("decoder", F.lit(0).cast("bigint"), lambda a, x: a + x["day_of_week"]).alias("decoder_dow_sum"))


@query("growable_dictionary")
def growable_dictionary(spark, sf):
    """Customer codes from the orders of 1992 to 1993, grown by those of all years (F13, U4): old codes stay."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_custkey").cast("string").alias("customer"), "o_orderdate")
    from ..session import cut_lineage
    old = cut_lineage(ca.ordinal_dictionary(orders.where(F.col("o_orderdate") < F.lit("1994-01-01").cast("date")), "customer"))
    return ca.extend_dictionary(old, orders, "customer")


@query("stable_narrowing")
def stable_narrowing(spark, sf):
    """Order lines appended in two batches with different ranges, each in its smallest types that do not fall behind
    the table's, read back as one table (P12)."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("long").alias("l_linenumber"),
        F.col("l_partkey").cast("long").alias("l_partkey"))
    path = scratch_path(spark, "tables/narrow")
    small = F.col("l_orderkey") <= 100
    files.append_narrow(lines.where(small), path)
    files.append_narrow(lines.where(~small), path)
    return files.read_narrow(spark, path).select(*[F.col(c).cast("long").alias(c) for c in lines.columns])
