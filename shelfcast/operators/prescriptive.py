"""Prescriptive fusion and what-if analytics.

D_final[q] = D_base[q] * max(0, 1 + tau * dP).  tau comes from the series' elasticity,
else the mean tau of the forecast row's category, else the global mean tau (fallback
tiers).  Category means have one row per category and the global mean is a scalar
subquery; both are aggregates of the elasticity table.

The what-if grid evaluates all series at every price change of -30 % .. +30 % at once.
Its per-series summary uses that the multiplier is constant within a series and
non-negative: sum(p50 * m) = m * sum(p50) and min(p10 * m) = m * min(p10).  The
summary therefore aggregates the forecasts per series first and expands the 61 price
points on the per-series table, never on the per-step rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import WHATIF_PCT_RANGE
from ..functions import expressions as X
from .common import checked_broadcast, key_bound

Q = ("p10", "p50", "p90")


def category_tau(elasticities: DataFrame) -> DataFrame:
    """Unweighted mean tau per category, categories without a name dropped."""
    return (elasticities.filter(F.col("cat_id").isNotNull())
                        .groupBy("cat_id").agg(F.avg("tau").alias("cat_tau")))


def resolve_tau(forecasts: DataFrame, elasticities: DataFrame, fallback: str = "category") -> DataFrame:
    """Left join (item, store) elasticities onto forecasts and fill missing tau from the
    category mean (looked up by the forecast row's cat_id) and then the global mean (J3).
    ``fallback='global_only'`` skips the category tier."""
    e = elasticities.select("item_id", "store_id", "tau")
    out = forecasts.join(e, ["item_id", "store_id"], "left")
    tiers = [F.col("tau")]
    if fallback == "category" and "cat_id" in forecasts.columns:
        # one row per category: broadcast after checking the number of categories
        cats = checked_broadcast(category_tau(elasticities), key_bound(elasticities, ["cat_id"]))
        out = out.join(cats, "cat_id", "left")
        tiers.append(F.col("cat_tau"))
    global_tau = elasticities.select(F.avg("tau")).scalar()
    tiers.append(global_tau)
    out = out.withColumn("tau_source",
                         F.when(F.col("tau").isNotNull(), F.lit("series"))
                          .when(F.col("cat_tau").isNotNull() if "cat_tau" in out.columns else F.lit(False),
                                F.lit("category"))
                          .otherwise(F.lit("global")))
    out = out.withColumn("tau", F.coalesce(*tiers))
    return out.drop("cat_tau") if "cat_tau" in out.columns else out


def prescriptive_forecast(forecasts: DataFrame, elasticities: DataFrame, delta_p,
                          fallback: str = "category") -> DataFrame:
    """Forecast rows with tau and final_p10/50/90 (R1).  ``delta_p`` is a number or a
    column of the forecast table (per-row price change)."""
    out = resolve_tau(forecasts, elasticities, fallback)
    dp = delta_p if isinstance(delta_p, Column) else F.lit(float(delta_p))
    m = X.demand_multiplier("tau", dp)
    return out.withColumns({f"final_{q}": F.col(q) * m for q in Q if q in out.columns})


def price_grid(lo: int = WHATIF_PCT_RANGE[0], hi: int = WHATIF_PCT_RANGE[1]) -> Column:
    """Array of price changes lo%..hi% in 1 % steps (61 values by default)."""
    return F.transform(F.sequence(F.lit(lo), F.lit(hi)), lambda p: p / F.lit(100.0))


def whatif_grid(forecasts: DataFrame, elasticities: DataFrame, lo: int = WHATIF_PCT_RANGE[0],
                hi: int = WHATIF_PCT_RANGE[1]) -> DataFrame:
    """Every forecast row at every price change (B1): rows x 61."""
    base = resolve_tau(forecasts, elasticities)
    g = base.withColumn("delta_p", F.explode(price_grid(lo, hi)))
    m = X.demand_multiplier("tau", "delta_p")
    return g.withColumns({f"final_{q}": F.col(q) * m for q in Q})


def whatif_summary(forecasts: DataFrame, elasticities: DataFrame, base_price: DataFrame,
                   lo: int = WHATIF_PCT_RANGE[0], hi: int = WHATIF_PCT_RANGE[1]) -> DataFrame:
    """Per series and price change (A10, B2, B3, B6): base/new price, base/new volume
    over the horizon, revenues and impact, minimum downside (final p10) with the
    stockout label, and the elasticity label of the series' own tau (missing -> 0)."""
    per = (forecasts.groupBy("item_id", "store_id")
                    .agg(*([F.first("cat_id").alias("cat_id")] if "cat_id" in forecasts.columns else []),
                         F.sum("p50").alias("base_volume"), F.min("p10").alias("min_p10")))
    own = elasticities.select("item_id", "store_id", F.col("tau").alias("own_tau"))
    per = resolve_tau(per, elasticities).join(own, ["item_id", "store_id"], "left")
    per = per.join(base_price, ["item_id", "store_id"], "left")
    g = per.withColumn("delta_p", F.explode(price_grid(lo, hi)))
    m = X.demand_multiplier("tau", "delta_p")
    return g.select(
        "item_id", "store_id", "delta_p", "tau",
        F.col("base_price"), (F.col("base_price") * (1 + F.col("delta_p"))).alias("new_price"),
        F.col("base_volume"), (F.col("base_volume") * m).alias("new_volume"),
        (F.col("base_volume") * F.col("base_price")).alias("base_revenue"),
        (F.col("base_volume") * m * F.col("base_price") * (1 + F.col("delta_p"))).alias("new_revenue"),
        (F.col("base_volume") * m * F.col("base_price") * (1 + F.col("delta_p"))
         - F.col("base_volume") * F.col("base_price")).alias("revenue_impact"),
        (F.col("min_p10") * m).alias("min_downside"),
        X.stockout_risk(F.col("min_p10") * m).alias("stockout_risk"),
        X.elasticity_label(F.coalesce(F.col("own_tau"), F.lit(0.0))).alias("elasticity_label"))


def safety_stock(prescriptive: DataFrame, policy: str = "p50") -> DataFrame:
    """Target stock per row: final_p50 (median policy) or final_p90 (conservative)."""
    if policy not in ("p50", "p90"):
        raise ValueError("policy must be 'p50' or 'p90'")
    return prescriptive.withColumn("target_stock", F.col(f"final_{policy}"))


def fan_chart_points(history: DataFrame, prescriptive: DataFrame, n_history: int = 30,
                     date: str = "date", value: str = "sales") -> DataFrame:
    """Long chart table (item, store, step, kind, value) (B5, U2): the last ``n_history``
    history rows as steps -n..-1 (kind 'history'), then for each quantile line the last
    observed value at step 0 followed by the final quantiles at steps 1..H."""
    from pyspark.sql import Window
    back = Window.partitionBy("item_id", "store_id").orderBy(F.col(date).desc())
    keys = prescriptive.select("item_id", "store_id").distinct()
    h = (history.select("item_id", "store_id", date, value).join(keys, ["item_id", "store_id"], "left_semi")
                .withColumn("_b", F.row_number().over(back)).filter(F.col("_b") <= n_history))
    hist = h.select("item_id", "store_id", (-F.col("_b")).alias("step"), F.lit("history").alias("kind"),
                    F.col(value).alias("value"))
    kinds = [f"final_{q}" for q in Q]
    # step 0 of every quantile line is the last observed value (one explode per series)
    stitch = (h.filter(F.col("_b") == 1)
               .select("item_id", "store_id", F.lit(0).alias("step"),
                       F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"), F.col(value).alias("value")))
    # the three quantile lines from one scan of the prescriptive table
    lines = (prescriptive.select("item_id", "store_id", F.col("horizon_step").alias("step"),
                                 F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value"))
                                                     for k in kinds])).alias("_l"))
                         .select("item_id", "store_id", "step", "_l.kind", "_l.value"))
    return hist.unionByName(stitch).unionByName(lines)
