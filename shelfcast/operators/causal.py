"""Price effect by double machine learning, re-aimed at Spark.

Cross-fitting: every row gets fold = md5(item|store) mod K, so a series is never split
across folds.  Nuisances E[Y|W,X] and E[T|W,X] are estimated out of fold:

* ``cell_mean_residuals`` -- mean of Y and T in the row's confounder cell computed from
  all folds except the row's own: (cell total - cell-in-fold total) / (count - count in
  fold).  One aggregate by (cell, fold), one equi-join back; no per-fold passes.  Cells
  seen only in the row's own fold fall back to the coarser cell (last confounder
  dropped), then to the out-of-fold global mean.
* ``gbt_residuals`` -- Spark ML GBTRegressor nuisances, one per (fold, target), scored on
  the held-out fold.

Final stage on the residuals rY, rT:

* ``segment_effects`` -- per segment, the slope of rY on rT with an intercept, theta =
  cov(rT, rY) / var(rT): the nuisance cells do not know the segment, so its residuals keep
  a level of their own, which the intercept takes up.  Heteroskedasticity-robust (HC1)
  standard error sqrt(n/(n-2) * sum(u^2 e^2)) / sum(u^2) with u = rT - mean(rT) and the
  residual e; 95 % interval theta +- z*se.
* ``linear_effects`` -- theta(x) = (1, x) . beta from the normal equations of
  rY ~ rT*(1, x): one aggregate of cross-product sums, a (k+1)x(k+1) solve on the driver.
* ``fit_forest`` -- R-learner forest: RandomForestRegressor on label rY/rT with weight
  rT^2 (0 for tiny |rT|), over standardised numbers and encoded strings; intervals from
  half-sample forests; the fitted object scores new rows.

Effects are in units per currency unit (dY/dT); ``tau`` converts a segment effect to an
elasticity at the segment means, effect * mean(T) / mean(Y), for the demand multiplier.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CausalConfig
from ..functions import expressions as X
from .common import MAX_BROADCAST_ROWS, checked_broadcast, numbered

MAX_VALUES = 1000  # of a string column that become indicator features


def add_folds(df: DataFrame, cfg: CausalConfig = CausalConfig()) -> DataFrame:
    return df.withColumn("fold", X.fold_of(*cfg.fold_keys, n_folds=cfg.n_folds))


# ---- preprocessing (F12, F13) ----------------------------------------------------------

def standardize(df: DataFrame, columns) -> DataFrame:
    """(x - mean) / population std from one aggregate (scalar subqueries); zero std -> /1."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])
    out = {}
    for c in columns:
        m = stats.select(f"m_{c}").scalar()
        s = stats.select(f"s_{c}").scalar()
        out[c] = (F.col(c) - m) / F.coalesce(F.nullif(s, F.lit(0.0)), F.lit(1.0))
    return df.withColumns(out)


def ordinal_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values with codes 0..n-1, numbered by range partitions and prefix sums,
    so no task holds the whole dictionary."""
    d = df.select(column).where(F.col(column).isNotNull()).distinct()
    return numbered(d, [column], "_code").select(column, F.col("_code").cast("int").alias(f"{column}_code"))


def extend_dictionary(dictionary: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """A dictionary grown by the values of ``df`` it does not hold: they follow the largest code in
    sorted order, and codes given before never move.  Only the new values are exchanged and numbered."""
    code = f"{column}_code"
    new = df.select(column).where(F.col(column).isNotNull()).distinct().join(dictionary.select(column), column, "left_anti")
    last = dictionary.agg(F.coalesce(F.max(code), F.lit(-1))).first()[0]
    return dictionary.select(column, code).unionByName(
        numbered(new, [column], "_code").select(column, (F.col("_code") + last + 1).cast("int").alias(code)))


def ordinal_encode(df: DataFrame, dictionary: DataFrame, column: str) -> DataFrame:
    """Codes from a fitted dictionary; values not in it get -1."""
    return (df.join(dictionary, column, "left")
              .withColumn(f"{column}_code", F.coalesce(F.col(f"{column}_code"), F.lit(-1))))


# ---- nuisances (C3) --------------------------------------------------------------------

def cell_mean_residuals(df: DataFrame, cfg: CausalConfig = CausalConfig(),
                        cells=None, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Adds m_y, m_t (out-of-fold cell means) and r_y, r_t.  Rows with NULL outcome,
    treatment or cell values are dropped first (P7).

    Plan: one aggregate of the rows by (cell, fold) -- the only pass over the data
    before the final join.  Coarser levels (last confounder dropped, then global) and the
    totals over folds are computed on that small table; the resulting per-(cell, fold)
    estimate table is materialised in the checkpoint folder and joined back to the rows
    once.  Its row count is known exactly and checked before the broadcast; above the
    limit the join is a shuffle join."""
    from pyspark.sql import Window
    from ..session import cut_lineage
    cells = list(cells if cells is not None else (*cfg.confounders, *cfg.segment))
    y, t = cfg.outcome, cfg.treatment
    base = add_folds(df, cfg) if "fold" not in df.columns else df
    base = base.na.drop("any", subset=[y, t, *cells])
    fine = base.groupBy(*cells, "fold").agg(F.sum(y).alias("fy"), F.sum(t).alias("ft"),
                                            F.count(F.lit(1)).alias("fn"))
    levels = [cells, cells[:-1]] if len(cells) > 1 else [cells]
    levels.append([])
    est = fine.select(*cells, "fold")
    for i, lv in enumerate(levels):
        by_fold = fine.groupBy(*lv, "fold").agg(F.sum("fy").alias("fy"), F.sum("ft").alias("ft"),
                                                F.sum("fn").alias("fn"))
        w = Window.partitionBy(*lv)   # over the small per-(level, fold) table only
        n_out = F.nullif(F.sum("fn").over(w) - F.col("fn"), F.lit(0)).cast("double")
        lvl = by_fold.select(*lv, "fold",
                             F.try_divide(F.sum("fy").over(w) - F.col("fy"), n_out).alias(f"my{i}"),
                             F.try_divide(F.sum("ft").over(w) - F.col("ft"), n_out).alias(f"mt{i}"))
        est = est.join(lvl, [*lv, "fold"], "left")
    est = cut_lineage(est.select(*cells, "fold",
                                 F.coalesce(*[F.col(f"my{i}") for i in range(len(levels))]).alias("m_y"),
                                 F.coalesce(*[F.col(f"mt{i}") for i in range(len(levels))]).alias("m_t")))
    n_est = est.count()   # exact size of the materialised estimate table
    out = base.join(checked_broadcast(est, n_est, max_broadcast_rows), [*cells, "fold"], "left")
    return out.withColumn("r_y", F.col(y) - F.col("m_y")).withColumn("r_t", F.col(t) - F.col("m_t"))


def gbt_residuals(df: DataFrame, features, cfg: CausalConfig = CausalConfig()) -> DataFrame:
    """Out-of-fold GBT nuisances: for each fold k, fit on the other folds, score fold k;
    K x 2 Spark ML fits, then one union of the scored folds."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from ..session import cut_lineage
    base = add_folds(df, cfg) if "fold" not in df.columns else df
    # read by 2K fits and K scorings: materialise once instead of re-running its plan
    base = cut_lineage(base.na.drop("any", subset=[cfg.outcome, cfg.treatment, *features]))
    parts = []
    for k in range(cfg.n_folds):
        train, hold = base.filter(F.col("fold") != k), base.filter(F.col("fold") == k)
        scored = hold
        for target, name in ((cfg.outcome, "m_y"), (cfg.treatment, "m_t")):
            pipe = Pipeline(stages=[
                VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep"),
                GBTRegressor(featuresCol="_x", labelCol=target, predictionCol=name,
                             maxIter=cfg.n_trees, maxDepth=cfg.max_depth, seed=cfg.seed)])
            scored = pipe.fit(train).transform(scored).drop("_x")
        parts.append(scored)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.withColumn("r_y", F.col(cfg.outcome) - F.col("m_y"))
               .withColumn("r_t", F.col(cfg.treatment) - F.col("m_t")))


# ---- final stage (C4, C5, C6) -------------------------------------------------------------

def normal_two_sided_p(z: Column) -> Column:
    """2 * (1 - Phi(|z|)) with the Abramowitz-Stegun 7.1.26 erf approximation (|error| <
    1.5e-7); plain arithmetic, so any SQL engine gives the same value."""
    x = F.abs(z) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1.0 - poly * F.exp(-x * x)
    return 1.0 - erf


def segment_effects(resid: DataFrame, cfg: CausalConfig = CausalConfig(), segment=None) -> DataFrame:
    """Per segment: n, effect, se, ci_lower, ci_upper, tau (elasticity at the means),
    p_value (normal approximation) and p_value_rule (0.001 if the interval excludes 0,
    else 0.5, as the reference's summary).

    The effect is NULL where the residual treatment does not vary, the interval also for
    segments of two rows.  Two aggregates with map-side partial sums; the per-segment line
    of the first is joined to the rows for the second: broadcast if its counted size allows, else
    a shuffle join whose hot segments adaptive execution splits."""
    from ..session import cut_lineage
    seg = list(segment if segment is not None else cfg.segment)
    y, t = cfg.outcome, cfg.treatment
    rows = resid.where(F.col("r_y").isNotNull() & F.col("r_t").isNotNull())
    s1 = rows.groupBy(*seg).agg(F.count(F.lit(1)).alias("n"), F.avg("r_t").alias("_mx"), F.avg("r_y").alias("_my"),
                                F.var_pop("r_t").alias("_vx"), F.covar_pop("r_t", "r_y").alias("_cxy"),
                                F.avg(t).alias("mean_t"), F.avg(y).alias("mean_y"))
    s1 = s1.withColumn("effect", F.try_divide(F.col("_cxy"), F.nullif(F.col("_vx"), F.lit(0.0))))
    if seg:
        s1 = cut_lineage(s1)  # read by its count, the join and the result
        line = s1.select(*seg, "effect", "_mx", "_my")
        j = rows.join(checked_broadcast(line, s1.count()), seg)
    else:
        one = s1.select(F.struct("effect", "_mx", "_my")).scalar()
        j = rows.withColumns({c: one[c] for c in ("effect", "_mx", "_my")})
    u = F.col("r_t") - F.col("_mx")
    e = (F.col("r_y") - F.col("_my")) - F.col("effect") * u
    s2 = j.groupBy(*seg).agg(F.sum(u * u * e * e).alias("meat"))
    out = s1.join(s2, seg) if seg else s1.withColumn("meat", s2.select("meat").scalar())
    n = F.col("n").cast("double")
    se = F.try_divide(F.sqrt(F.col("meat") * F.when(n > 2, n / F.nullif(n - 2, F.lit(0.0)))), F.nullif(n * F.col("_vx"), F.lit(0.0)))
    out = out.withColumn("se", se)
    lo = F.col("effect") - cfg.z * F.col("se")
    hi = F.col("effect") + cfg.z * F.col("se")
    return out.select(*seg, "n", "effect", "se", lo.alias("ci_lower"), hi.alias("ci_upper"),
                      (F.col("effect") * F.try_divide(F.col("mean_t"), F.nullif(F.col("mean_y"), F.lit(0.0)))).alias("tau"),
                      normal_two_sided_p(F.try_divide(F.col("effect"), F.nullif(F.col("se"), F.lit(0.0)))).alias("p_value"),
                      F.when((lo > 0) | (hi < 0), F.lit(0.001)).otherwise(F.lit(0.5)).alias("p_value_rule"))


def row_effects(resid: DataFrame, effects: DataFrame, segment) -> DataFrame:
    """Per-row CATE with interval: each row takes its segment's effect."""
    return resid.join(effects.select(*segment, "effect", "ci_lower", "ci_upper"), list(segment))


def ate_summary(row_fx: DataFrame) -> DataFrame:
    """ATE = mean per-row effect, interval = mean of per-row bounds; p-value rule 0.001
    if the interval excludes 0 else 0.5; significant if p < 0.05 (A11, C5)."""
    a = row_fx.agg(F.avg("effect").alias("ATE"), F.avg("ci_lower").alias("ci_lower"),
                   F.avg("ci_upper").alias("ci_upper"), F.count(F.lit(1)).alias("n"))
    p = F.when((F.col("ci_lower") > 0) | (F.col("ci_upper") < 0), F.lit(0.001)).otherwise(F.lit(0.5))
    return a.withColumn("p_value", p).withColumn("significant", F.col("p_value") < 0.05)


def linear_effects(resid: DataFrame, x_cols, cfg: CausalConfig = CausalConfig()):
    """theta(x) = b0 + b.x from the normal equations of r_y ~ r_t * (1, x).

    See ``effects.fit_linear``.  Returns (beta, rows with effect, se, ci_lower, ci_upper)."""
    from .effects import fit_linear
    model = fit_linear(resid, x_cols, cfg)
    return list(model.beta), model.effect(resid)


def binary_treatment_ate(df: DataFrame, treated: Column, cfg: CausalConfig = CausalConfig(), cells=None) -> DataFrame:
    """Discrete-treatment DML ATE (C6): T in {0, 1}; r_t = T - out-of-fold propensity
    (cell share treated), effect = slope of r_y on r_t with sandwich interval."""
    d = df.withColumn("_treated", treated.cast("double"))
    c2 = CausalConfig(n_folds=cfg.n_folds, outcome=cfg.outcome, treatment="_treated",
                      confounders=cfg.confounders, segment=cfg.segment, fold_keys=cfg.fold_keys, z=cfg.z)
    r = cell_mean_residuals(d, c2, cells)
    return segment_effects(r, c2, segment=[]).select(
        F.col("effect").alias("point_estimate"), "se", "ci_lower", "ci_upper", "p_value", "n")


# ---- forest CATE (C4(c), C7) ----------------------------------------------------------------

@dataclass(frozen=True)
class ForestEffects:
    """A fitted heterogeneous-effect forest: the point model and the half-sample models."""

    preprocess: object
    main: object
    halves: tuple
    x_cols: tuple
    z: float

    def effect(self, rows: DataFrame) -> DataFrame:
        """``rows`` with effect, ci_lower and ci_upper; the rows need the x columns only, so
        new ones can be scored."""
        out = self.main.transform(self.preprocess.transform(rows))
        for m in self.halves:
            out = m.transform(out)
        preds = [F.col(f"_h{g}") for g in range(len(self.halves))]
        mean = sum(preds) / len(preds)
        sd = F.sqrt(sum((p - mean) * (p - mean) for p in preds) / max(len(preds) - 1, 1))
        added = [c for c in out.columns if c not in rows.columns and c != "effect"]
        return out.withColumns({"ci_lower": F.col("effect") - self.z * sd, "ci_upper": F.col("effect") + self.z * sd}).drop(*added)

    def importances(self, spark) -> DataFrame:
        """Importance of each x column, largest first; the indicator columns of a categorical
        one are added up."""
        total = dict.fromkeys(self.x_cols, 0.0)
        for name, v in zip(self.preprocess.feature_columns, self.main.featureImportances.toArray()):
            total[name] += float(v)
        return spark.createDataFrame(list(total.items()), "feature string, importance double").orderBy(F.desc("importance"))


class Preprocessor:
    """Fitted input transformation (C2): numeric columns standardised, string columns as
    sorted ordinal codes spread over indicator columns (unseen and NULL values are all zero), all other
    columns left out of the feature vector.  Fitting reads one aggregate for the numeric
    columns and the distinct values of each string column, which bound the vector's width."""

    def fit(self, df: DataFrame, x_cols, output: str = "_x") -> Preprocessor:
        kinds = dict(df.dtypes)
        self.output = output
        self.numeric = [c for c in x_cols if kinds[c] not in ("string", "date", "timestamp") and not kinds[c].startswith(("array", "map", "struct"))]
        self.values = {c: self._values(df, c) for c in x_cols if kinds[c] == "string"}
        aggs = [f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(self.numeric) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
        row = df.agg(*aggs).first() if aggs else None
        self.stats = {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(self.numeric)}
        self.feature_columns = [c for c in x_cols if c in self.stats or c in self.values
                                for _ in range(len(self.values.get(c, [0])))]
        self.x_cols = list(x_cols)
        return self

    @staticmethod
    def _values(df: DataFrame, c: str) -> list[str]:
        """The sorted values of a string column, each of which becomes a feature."""
        found = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(MAX_VALUES + 1).collect()]
        if len(found) > MAX_VALUES:
            raise ValueError(f"column {c} has more than {MAX_VALUES} values; give its codes (ordinal_dictionary) instead")
        return sorted(found)

    def transform(self, df: DataFrame) -> DataFrame:
        cols = []
        for c in self.x_cols:
            if c in self.stats:
                m, s = self.stats[c]
                cols.append((F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(m)) / F.lit(s))
            for v in self.values.get(c, []):
                cols.append(F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0)))
        from pyspark.ml.functions import array_to_vector
        return df.withColumn(self.output, array_to_vector(F.array(*cols)))


def fit_forest(resid: DataFrame, x_cols, cfg: CausalConfig = CausalConfig()) -> tuple[ForestEffects, DataFrame]:
    """R-learner forest: label r_y / r_t, weight r_t^2; rows with |r_t| < ``min_abs_rt`` get
    weight 0 (their label is not defined) and so leave the fit as it is.  The point model is fitted
    on all rows, each of ``n_half_samples`` models on its own md5 half of the series.
    Returns the fitted object and the training rows with their ``_clipped`` mark."""
    from pyspark.ml.regression import RandomForestRegressor

    from ..session import cut_lineage
    small = F.abs(F.col("r_t")) < cfg.min_abs_rt
    pre = Preprocessor().fit(resid, x_cols)
    # the training table is read by 1 + n_half_samples forest fits: materialise it once
    rows = cut_lineage(resid.withColumn("_clipped", small)
                            .withColumn("_label", F.when(small, 0.0).otherwise(F.col("r_y") / F.col("r_t")))
                            .withColumn("_w", F.when(small, 0.0).otherwise(F.col("r_t") * F.col("r_t"))))
    train = pre.transform(rows.where("_w > 0"))

    def fit(data, seed, pred):
        return RandomForestRegressor(featuresCol="_x", labelCol="_label", weightCol="_w", predictionCol=pred,
                                     numTrees=cfg.n_trees, maxDepth=cfg.max_depth, seed=seed).fit(data)

    halves = []
    for g in range(cfg.n_half_samples):
        key = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in cfg.fold_keys], F.lit(f"half{g}")))
        halves.append(fit(train.where(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % 2 == 0), cfg.seed + 1 + g, f"_h{g}"))
    model = ForestEffects(pre, fit(train, cfg.seed, "effect"), tuple(halves), tuple(x_cols), cfg.z)
    return model, rows.drop("_label", "_w")


def forest_effects(resid: DataFrame, x_cols, cfg: CausalConfig = CausalConfig()):
    """Fit the forest and score its own rows: (model, rows with effect / ci_lower / ci_upper /
    ``_clipped``, importances)."""
    model, rows = fit_forest(resid, x_cols, cfg)
    return model, model.effect(rows), model.importances(resid.sparkSession)
