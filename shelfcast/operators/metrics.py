"""Backtest metrics and the evaluation report.

All metrics are aggregates, so the report is one grouped pass over the forecasts
(``GROUPING SETS ((), (cat_id), (store_id))``) and one over the history, joined on
(grouping id, slice value).  Partial aggregation runs before the shuffle, so a hot
category or store is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (COVERAGE_OK_ERROR, COVERAGE_TARGET, MASE_SEASONALITY,
                      MASE_ZERO_DENOMINATOR, PanelKeys)
from ..functions import expressions as X
from ..session import cut_lineage
from .common import numbered


# ---- aggregate expressions (usable in any groupBy) ---------------------------------------

def wql_expr(y="sales", yhat="p50", q: float = 0.5) -> Column:
    """2 * sum(pinball) / sum(|y|), 0 when the denominator is 0."""
    num = F.sum(X.pinball(y, yhat, q))
    den = F.sum(F.abs(X.col(y)))
    return F.coalesce(F.lit(2.0) * F.try_divide(num, F.nullif(den, F.lit(0.0))), F.lit(0.0))


def coverage_expr(y="sales", lo="p10", hi="p90") -> Column:
    """Share of y inside [lo, hi], bounds inclusive."""
    return F.avg(((X.col(y) >= X.col(lo)) & (X.col(y) <= X.col(hi))).cast("double"))


def mae_expr(y="sales", yhat="p50") -> Column:
    return F.avg(F.abs(X.col(y) - X.col(yhat)))


def mase_ratio(mae: Column, naive_mean: Column, n_hist: Column) -> Column:
    """MAE / naive MAE with the reference's guards: history of at most ``season`` values
    -> denominator 1; zero naive error -> 1e-6 (E3)."""
    den = (F.when(n_hist <= MASE_SEASONALITY, F.lit(1.0))
            .when(naive_mean == 0, F.lit(MASE_ZERO_DENOMINATOR))
            .otherwise(naive_mean))
    return mae / den


# ---- seasonal differences of the history --------------------------------------------------

def seasonal_diffs(history: DataFrame, keys: PanelKeys = PanelKeys(), season: int = MASE_SEASONALITY) -> DataFrame:
    """Per series: number of history rows and the sum / count of |y[t] - y[t-season]|
    within the series (the per-series convention)."""
    w = Window.partitionBy(*keys.series).orderBy(keys.date)
    d = F.abs(F.col(keys.target) - F.lag(keys.target, season).over(w))
    return (history.select(*keys.series, keys.date, keys.target).withColumn("_d", d)
                   .groupBy(*keys.series)
                   .agg(F.count(F.lit(1)).alias("n_hist"), F.sum("_d").alias("sum_absdiff"),
                        F.count("_d").alias("n_diffs")))


def flattened_seasonal_diffs(history: DataFrame, slices: DataFrame, slice_col: str,
                             keys: PanelKeys = PanelKeys(), season: int = MASE_SEASONALITY) -> DataFrame:
    """Reference-parity convention: the histories of all series of a slice are laid end to
    end (series ordered by item, store; rows by date) and differenced at lag ``season``
    across series boundaries.  Returns (slice, n_hist, sum_absdiff, n_diffs).

    Inside a series the differences are plain window lags.  Only the first ``season`` rows of
    a series meet rows of earlier ones: these heads and the last ``season`` rows (tails) of every
    series, placed by a running count over the series of the slice, are joined by place.  The
    running count comes from range partitions and prefix sums, so no task spans a slice."""
    s = keys.series
    w, whole = Window.partitionBy(*s).orderBy(keys.date), Window.partitionBy(*s)
    rows = (history.select(*s, keys.date, keys.target)
                   .withColumns({"_d": F.abs(F.col(keys.target) - F.lag(keys.target, season).over(w)),
                                 "_rn": F.row_number().over(w), "_n": F.count(F.lit(1)).over(whole)}))
    edge = F.when((F.col("_rn") <= season) | (F.col("_rn") > F.col("_n") - season), F.struct("_rn", F.col(keys.target).alias("y")))
    per = (rows.groupBy(*s).agg(F.first("_n").alias("_n"), F.sum("_d").alias("_sum"), F.count("_d").alias("_diffs"),
                                F.collect_list(edge).alias("_edge"))  # at most 2 * season rows
               .join(slices.select(*s, slice_col).distinct(), s))
    placed = cut_lineage(numbered(per, [slice_col, *s], "_all", "_n"))
    first = placed.groupBy(slice_col).agg(F.min("_all").alias("_first"))
    ends = (placed.join(first.withColumnRenamed(slice_col, "_slice"), F.col(slice_col).eqNullSafe(F.col("_slice")))
                  .select(slice_col, "_n", F.explode("_edge").alias("_e"), (F.col("_all") - F.col("_first")).alias("_off"))
                  .select(slice_col, "_n", F.col("_e._rn").alias("_rn"), F.col("_e.y").alias("_y"), (F.col("_off") + F.col("_e._rn")).alias("_pos")))
    heads = ends.where((F.col("_rn") <= season) & (F.col("_pos") > season))
    tails = (ends.where(F.col("_rn") > F.col("_n") - season)
                 .select(F.col(slice_col).alias("_slice"), (F.col("_pos") + season).alias("_at"), F.col("_y").alias("_y0")))
    across = (heads.join(tails, F.col(slice_col).eqNullSafe(F.col("_slice")) & (F.col("_pos") == F.col("_at")))
                   .select(slice_col, F.abs(F.col("_y") - F.col("_y0")).alias("_sum"), F.lit(1).cast("long").alias("_diffs"), F.lit(0).cast("long").alias("_n")))
    parts = placed.select(slice_col, F.coalesce("_sum", F.lit(0.0)).alias("_sum"), "_diffs", "_n").unionByName(across)
    return parts.groupBy(slice_col).agg(F.sum("_n").alias("n_hist"), F.sum("_sum").alias("sum_absdiff"), F.sum("_diffs").alias("n_diffs"))


def mase_series(forecasts: DataFrame, history: DataFrame, keys: PanelKeys = PanelKeys(),
                y: str = "sales", yhat: str = "p50") -> DataFrame:
    """MASE per series (E3 applied to each series)."""
    f = forecasts.groupBy(*keys.series).agg(mae_expr(y, yhat).alias("mae"))
    d = seasonal_diffs(history, keys)
    j = f.join(d, keys.series, "left").fillna({"n_hist": 0, "n_diffs": 0})
    naive = F.try_divide(F.col("sum_absdiff"), F.nullif(F.col("n_diffs").cast("double"), F.lit(0.0)))
    return j.select(*keys.series, "mae", "n_hist",
                    mase_ratio(F.col("mae"), F.coalesce(naive, F.lit(0.0)), F.col("n_hist")).alias("MASE"))


# ---- the report ---------------------------------------------------------------------

NULL_SLICE = "nan"  # key of the slice without a value in the JSON document
SLICE_LABEL = {3: "global", 1: "category", 2: "store"}


def evaluation_report(forecasts: DataFrame, history: DataFrame, keys: PanelKeys = PanelKeys(),
                      y: str = "sales", mode: str = "per_series") -> DataFrame:
    """Long report (slice_type, slice_value, WQL_10, WQL_50, WQL_90, coverage_pct,
    coverage_error, MASE, calibration) for global, each category and each store (E4-E6).

    The global MASE is the unweighted mean of the category MASEs, as in the reference
    (NULL when there is no category).  ``mode`` picks the seasonal-difference convention:
    ``per_series`` (lag within each series) or ``flattened`` (reference parity, E4)."""
    s = keys.series
    has_cat = "cat_id" in forecasts.columns
    sets = [[]] + ([["cat_id"]] if has_cat else []) + [[keys.store]]
    fcols = forecasts.select(*s, *(["cat_id"] if has_cat else []), y, "p10", "p50", "p90")
    if not has_cat:
        fcols = fcols.withColumn("cat_id", F.lit(None).cast("string"))
    m = (fcols.groupingSets(sets, *([] if not has_cat else ["cat_id"]), keys.store)
              .agg(F.grouping_id().alias("gid"),
                   wql_expr(y, "p10", 0.1).alias("WQL_10"), wql_expr(y, "p50", 0.5).alias("WQL_50"),
                   wql_expr(y, "p90", 0.9).alias("WQL_90"), coverage_expr(y).alias("coverage_pct"),
                   mae_expr(y, "p50").alias("mae")))
    if not has_cat:
        m = m.withColumn("gid", F.when(F.col("gid") == 1, F.lit(3)).otherwise(F.lit(2)))\
             .withColumn("cat_id", F.lit(None).cast("string"))
    m = m.withColumn("slice_value", F.when(F.col("gid") == 1, F.col("cat_id"))
                                      .when(F.col("gid") == 2, F.col(keys.store)))
    series_slices = fcols.select(*s, "cat_id").distinct()
    if mode == "flattened":
        parts = []
        for gid, col in ((1, "cat_id"), (2, keys.store)):
            if gid == 1 and not has_cat:
                continue
            fd = flattened_seasonal_diffs(history, series_slices, col, keys)
            parts.append(fd.select(F.lit(gid).alias("gid"), F.col(col).alias("slice_value"),
                                   "n_hist", "sum_absdiff", "n_diffs"))
        hist = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    else:
        d = seasonal_diffs(history, keys).join(series_slices, s)
        hist = (d.groupingSets([["cat_id"], [keys.store]], "cat_id", keys.store)
                 .agg(F.grouping_id().alias("gid"), F.sum("n_hist").alias("n_hist"),
                      F.sum("sum_absdiff").alias("sum_absdiff"), F.sum("n_diffs").alias("n_diffs"))
                 .withColumn("slice_value", F.when(F.col("gid") == 1, F.col("cat_id"))
                                              .otherwise(F.col(keys.store)))
                 .select("gid", "slice_value", "n_hist", "sum_absdiff", "n_diffs"))
    naive = F.try_divide(F.col("sum_absdiff"), F.nullif(F.col("n_diffs").cast("double"), F.lit(0.0)))
    # null-safe: rows without a category are a slice of their own
    left, right = m.filter(F.col("gid") != 3), hist.withColumnsRenamed({"gid": "_gid", "slice_value": "_value"})
    same = (F.col("gid") == F.col("_gid")) & F.col("slice_value").eqNullSafe(F.col("_value"))
    sliced = (left.join(right, same, "left").drop("_gid", "_value")
               .withColumn("MASE", mase_ratio(F.col("mae"), F.coalesce(naive, F.lit(0.0)),
                                              F.coalesce(F.col("n_hist"), F.lit(0)))))
    glob = m.filter(F.col("gid") == 3).withColumn("MASE", F.lit(None).cast("double"))
    cols = ["gid", "slice_value", "WQL_10", "WQL_50", "WQL_90", "coverage_pct", "MASE"]
    out = sliced.select(*cols).unionByName(glob.select(*cols))
    # global MASE = mean of the category MASEs: one scalar aggregate over the report's slices
    cat_mean = sliced.where("gid = 1").agg(F.avg("MASE")).scalar()
    out = out.withColumn("MASE", F.when(F.col("gid") == 3, cat_mean).otherwise(F.col("MASE")))
    err = F.abs(F.col("coverage_pct") - F.lit(COVERAGE_TARGET))
    label = F.create_map(*[x for k, v in SLICE_LABEL.items() for x in (F.lit(k), F.lit(v))])
    return out.select(label[F.col("gid")].alias("slice_type"), "slice_value", "WQL_10", "WQL_50", "WQL_90",
                      "coverage_pct", err.alias("coverage_error"), "MASE",
                      F.when(err < COVERAGE_OK_ERROR, F.lit("OK")).otherwise(F.lit("DRIFT")).alias("calibration"))


def report_json(report: DataFrame) -> DataFrame:
    """One-row DataFrame holding the nested JSON document
    ``{global_metrics: {...}, by_category: {value: {...}}, by_store: {value: {...}}}``.
    The report has one row per slice (1 + #categories + #stores), so the nesting is a
    small final aggregate."""
    gm = F.struct(F.col("WQL_10"), F.col("WQL_50"), F.col("WQL_90"),
                  F.col("coverage_pct").alias("empirical_coverage_pct"), F.col("coverage_error"),
                  F.col("MASE"))
    sl = F.struct(F.col("WQL_50"), F.col("MASE"), F.col("coverage_pct"))
    key = F.coalesce(F.col("slice_value").cast("string"), F.lit(NULL_SLICE))
    t = F.col("slice_type")
    doc = report.groupBy().agg(
        F.first(F.when(t == "global", gm), ignorenulls=True).alias("global_metrics"),
        F.map_from_entries(F.collect_list(F.when(t == "category", F.struct(key, sl)))).alias("by_category"),
        F.map_from_entries(F.collect_list(F.when(t == "store", F.struct(key, sl)))).alias("by_store"))
    return doc.select(F.to_json(F.struct("global_metrics", "by_category", "by_store")).alias("json"))


def write_report_json(report: DataFrame, path: str) -> None:
    """Write the JSON document as a single text file under ``path`` (K3)."""
    report_json(report).coalesce(1).write.mode("overwrite").text(path)


def null_audit(df: DataFrame, columns=None) -> DataFrame:
    """NULL (and NaN) count per column in one pass, as a long table."""
    cols = columns or df.columns
    fr = {c for c in cols if df.schema[c].dataType.typeName() in ("double", "float")}
    aggs = [F.count_if(F.col(c).isNull() | (F.isnan(c) if c in fr else F.lit(False))).alias(c) for c in cols]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"),
                                                     F.col("_rows").alias("n_rows")) for c in cols])).alias("s")
                       ).select("s.*")


def drop_counts(before: DataFrame, after: DataFrame, step: str) -> DataFrame:
    """One row (step, rows_before, rows_after, rows_dropped) for a filtering step.
    Both counts are scalar aggregates (partial counts per task, no data moved)."""
    b = before.select(F.count(F.lit(1))).scalar()
    a = after.select(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(F.lit(step).alias("step"), b.alias("rows_before"),
                                               a.alias("rows_after"), (b - a).alias("rows_dropped"))
