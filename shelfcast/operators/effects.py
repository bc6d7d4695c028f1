"""Effects that differ from row to row, with intervals.

* ``fit_linear`` -- theta(x) = (1, x) . beta by the normal equations of r_y on r_t (1, x), with the
  heteroskedasticity-robust (HC1) covariance V of beta; a row's interval is
  theta(x) +- z sqrt((1, x) V (1, x)').  Two aggregates of (k+1)^2 sums.
* ``fit_honest_forest`` -- groups of trees.  Each group takes its own half of the series and splits
  it again: one part grows the trees (Spark's random forest on r_y / r_t, weight r_t^2), the other
  part estimates the effect in every leaf, so no row estimates in a leaf it helped to grow.
  A row's effect solves the leaves' moments added up over all trees; the spread of the groups'
  effects, less what comes from few trees, gives the interval (Student, groups - 1).
* ``doubly_robust`` -- treatment of two or more levels.  Out-of-fold multinomial propensities and
  outcome regressions per level give every row a score whose mean is the effect against the base
  level, right if either model is; propensities are trimmed and a report says how often.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CausalConfig
from ..session import cut_lineage
from .causal import Preprocessor, add_folds, normal_two_sided_p


# ---- linear effects (C4 b) ---------------------------------------------------------------

@dataclass(frozen=True)
class LinearEffects:
    """Fitted linear effect: coefficients of (1, x) and their robust covariance."""

    x_cols: tuple
    beta: tuple
    cov: tuple
    n: int
    z: float

    def _design(self) -> list[Column]:
        return [F.lit(1.0), *[F.col(c).cast("double") for c in self.x_cols]]

    def effect(self, rows: DataFrame) -> DataFrame:
        """``rows`` with effect, se, ci_lower, ci_upper; NULL where an x is."""
        x = self._design()
        theta = sum((F.lit(b) * c for b, c in zip(self.beta[1:], x[1:])), F.lit(self.beta[0]))
        var = F.lit(0.0)
        for i in range(len(x)):
            for j in range(i, len(x)):
                var = var + F.lit((1 if i == j else 2) * self.cov[i][j]) * x[i] * x[j]
        se = F.sqrt(F.greatest(var, F.lit(0.0)))
        out = rows.withColumns({"effect": theta, "se": se})
        return out.withColumns({"ci_lower": F.col("effect") - self.z * F.col("se"),
                                "ci_upper": F.col("effect") + self.z * F.col("se")})

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """``term`` (intercept and the x columns), coefficient, se, ci_lower, ci_upper, p_value."""
        rows = [(t, b, math.sqrt(max(self.cov[i][i], 0.0))) for i, (t, b) in enumerate(zip(("intercept", *self.x_cols), self.beta))]
        out = spark.createDataFrame(rows, "term string, coefficient double, se double")
        return out.withColumns({"ci_lower": F.col("coefficient") - self.z * F.col("se"),
                                "ci_upper": F.col("coefficient") + self.z * F.col("se"),
                                "p_value": normal_two_sided_p(F.try_divide("coefficient", F.nullif("se", F.lit(0.0))))})


def _sums(rows: DataFrame, z: list[Column], weight: Column) -> np.ndarray:
    """Sum over the rows of weight * z z' as one aggregate."""
    k = len(z)
    row = rows.agg(*[F.sum(weight * z[i] * z[j]).alias(f"a_{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    out = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            out[i, j] = out[j, i] = row[f"a_{i}_{j}"] or 0.0
    return out


def fit_linear(resid: DataFrame, x_cols, cfg: CausalConfig = CausalConfig()) -> LinearEffects:
    """Fit on the rows whose residuals and x are all there.  Collinear x share their effect (least
    norm); without rows all is 0."""
    rows = resid.select("r_y", "r_t", *[F.col(c).cast("double").alias(c) for c in x_cols]).na.drop("any")
    z = [F.col("r_t"), *[F.col("r_t") * F.col(c) for c in x_cols]]
    # cross products of (z, r_y): the last column is the right-hand side
    both = _sums(rows, [*z, F.col("r_y")], F.lit(1.0))
    k = len(z)
    bread = np.linalg.pinv(both[:k, :k])
    beta = bread @ both[:k, k]
    e = F.col("r_y") - sum((F.lit(float(b)) * c for b, c in zip(beta, z)), F.lit(0.0))
    meat = _sums(rows.withColumn("_e", e), z, F.col("_e") * F.col("_e"))
    n = rows.count()
    cov = bread @ meat @ bread * (n / (n - k) if n > k else float("nan"))
    return LinearEffects(tuple(x_cols), tuple(map(float, beta)), tuple(tuple(map(float, r)) for r in cov), n, cfg.z)


# ---- honest forest (C1, C4 c) --------------------------------------------------------------

def student_factor(z: float, df: int) -> float:
    """The Student quantile with ``df`` degrees of freedom where the normal one is ``z``
    (Cornish-Fisher terms up to df**-3; below 1 % off from three on)."""
    return (z + (z ** 3 + z) / (4 * df) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * df ** 2)
            + (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / (384 * df ** 3))


def honest_parts(cfg: CausalConfig, group: int) -> Column:
    """What a row does in a group: 'grow', 'estimate', or NULL (its series is in the other half).
    Whole series (``fold_keys``) go to one part, by md5."""
    key = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in cfg.fold_keys], F.lit(f"honest{group}")))
    quarter = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % 4
    return F.when(quarter == 0, "grow").when(quarter == 1, "estimate")


@dataclass(frozen=True)
class HonestForest:
    """Fitted forests (one a group) and the moments of their leaves, a table of ``group``, ``tree``,
    ``leaf``, ``n``, ``t``, ``y``, ``tt``, ``ty`` (means but for n)."""

    preprocess: Preprocessor
    forests: tuple
    leaves: DataFrame
    z: float

    @staticmethod
    def _hits(group: int) -> Column:
        """The moments of a row's leaves in the trees of a group."""
        leaf = vector_to_array(F.col(f"_leaf{group}")).cast("array<int>")
        key = lambda x, i: F.concat_ws("|", F.lit(group).cast("string"), i.cast("string"), x.cast("string"))
        return F.filter(F.transform(leaf, lambda x, i: F.element_at("_m", key(x, i))), lambda s: s.isNotNull())

    def effect(self, rows: DataFrame) -> DataFrame:
        """``rows`` with effect, se, ci_lower, ci_upper; the rows need the x columns only.  A leaf
        without estimating rows has no say; NULL where no tree has one."""
        out = self.preprocess.transform(rows)
        # at most trees * 2**depth entries
        moments = self.leaves.select(F.map_from_entries(F.collect_list(F.struct(
            F.concat_ws("|", *[F.col(c).cast("string") for c in ("group", "tree", "leaf")]), F.struct("t", "y", "tt", "ty")))).alias("m"))
        out = out.withColumn("_m", moments.scalar())
        sums, names = [], ("t", "y", "tt", "ty")
        for g, forest in enumerate(self.forests):
            out = forest.transform(out).drop("_p")
            out = out.withColumn(f"_s{g}", self._hits(g)).drop(f"_leaf{g}")
            sums.append(F.aggregate(f"_s{g}", F.struct(F.lit(0.0).alias("n"), *[F.lit(0.0).alias(c) for c in names]),
                                    lambda a, s: F.struct((a["n"] + 1.0).alias("n"), *[(a[c] + s[c]).alias(c) for c in names])))
        out = out.withColumns({f"_g{g}": s for g, s in enumerate(sums)})

        def slope(s):
            """The effect that solves summed moments with an intercept."""
            n = F.nullif(s["n"], F.lit(0.0))
            t, y = F.try_divide(s["t"], n), F.try_divide(s["y"], n)
            return F.try_divide(F.try_divide(s["ty"], n) - t * y, F.nullif(F.try_divide(s["tt"], n) - t * t, F.lit(0.0)))

        groups = range(len(self.forests))
        whole = F.struct(*[sum((F.col(f"_g{g}")[c] for g in groups), F.lit(0.0)).alias(c) for c in ("n", *names)])
        out = out.withColumn("effect", slope(whole))
        # each tree's pull on its group's effect, to take the noise of few trees out of the spread
        out = out.withColumns({f"_e{g}": slope(F.col(f"_g{g}")) for g in groups})
        there = F.filter(F.array(*[F.col(f"_e{g}") for g in groups]), lambda e: e.isNotNull())
        out = out.withColumn("_e", there)
        mean = F.aggregate("_e", F.lit(0.0), lambda a, e: a + e) / F.size("_e")
        spread = F.aggregate("_e", F.lit(0.0), lambda a, e: a + (e - mean) * (e - mean)) / F.nullif(F.size("_e") - 1, F.lit(0))

        def noise(g):
            s = F.col(f"_g{g}")
            n = F.nullif(s["n"], F.lit(0.0))
            t, y = F.try_divide(s["t"], n), F.try_divide(s["y"], n)
            var = F.try_divide(s["tt"], n) - t * t
            pull = F.aggregate(f"_s{g}", F.lit(0.0), lambda a, x: a + F.pow(
                F.try_divide((x["ty"] - t * y) - F.col(f"_e{g}") * (x["tt"] - t * t), F.nullif(var, F.lit(0.0))), F.lit(2.0)))
            return F.coalesce(F.try_divide(pull, n * F.nullif(n - 1, F.lit(0.0))), F.lit(0.0))

        inner = sum((noise(g) for g in groups), F.lit(0.0)) / len(self.forests)
        # the spread is at least what independent groups of this size can't go below
        var = F.greatest(spread - inner, spread / len(self.forests))
        wide = student_factor(self.z, max(len(self.forests) - 1, 3))
        out = out.withColumn("se", F.sqrt(var))
        out = out.withColumns({"ci_lower": F.col("effect") - wide * F.col("se"), "ci_upper": F.col("effect") + wide * F.col("se")})
        return out.select(*rows.columns, "effect", "se", "ci_lower", "ci_upper")


def fit_honest_forest(resid: DataFrame, x_cols, cfg: CausalConfig = CausalConfig(), n_groups: int = 8,
                      trees: int = 5, least_leaf: int = 20) -> HonestForest:
    """``n_groups`` forests of ``trees`` trees; leaves hold ``least_leaf`` growing rows or more.

    The rows are materialised once.  Leaf moments are one grouped sum over (row, tree) pairs of the
    estimating rows, pre-aggregated in every task; the table has at most a row per leaf."""
    from pyspark.ml.regression import RandomForestRegressor
    rows = resid.where(F.col("r_y").isNotNull() & F.col("r_t").isNotNull())
    pre = Preprocessor().fit(rows, x_cols)
    small = F.abs(F.col("r_t")) < cfg.min_abs_rt
    data = cut_lineage(pre.transform(rows).select(
        *cfg.fold_keys, pre.output, "r_y", "r_t", F.when(small, 0.0).otherwise(F.col("r_y") / F.col("r_t")).alias("_label"),
        F.when(small, 0.0).otherwise(F.col("r_t") * F.col("r_t")).alias("_w")))
    forests, parts = [], []
    for g in range(n_groups):
        part = honest_parts(cfg, g)
        forest = RandomForestRegressor(featuresCol=pre.output, labelCol="_label", weightCol="_w", predictionCol="_p",
                                       leafCol=f"_leaf{g}", numTrees=trees, maxDepth=cfg.max_depth,
                                       minInstancesPerNode=least_leaf, seed=cfg.seed + g).fit(
            data.where(part.eqNullSafe("grow") & (F.col("_w") > 0)))
        held = forest.transform(data.where(part.eqNullSafe("estimate")))
        leaf = F.posexplode(vector_to_array(F.col(f"_leaf{g}")).cast("array<int>")).alias("tree", "leaf")
        parts.append(held.select(F.lit(g).alias("group"), leaf, "r_t", "r_y"))
        forests.append(forest)
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    leaves = cut_lineage(union.groupBy("group", "tree", "leaf").agg(
        F.count(F.lit(1)).alias("n"), F.avg("r_t").alias("t"), F.avg("r_y").alias("y"),
        F.avg(F.col("r_t") * F.col("r_t")).alias("tt"), F.avg(F.col("r_t") * F.col("r_y")).alias("ty")))
    return HonestForest(pre, tuple(forests), leaves, cfg.z)


# ---- discrete treatment (C6) --------------------------------------------------------------

def doubly_robust_scores(df: DataFrame, treatment: str, levels, x_cols, cfg: CausalConfig = CausalConfig(),
                         trim: float = 0.01) -> DataFrame:
    """``df`` (rows with outcome, a known level and a fold) plus per level i: ``_e{i}`` (out-of-fold
    propensity, as fitted), ``_score{i}`` (doubly robust value of the outcome under that level).
    ``trim`` bounds propensities from below in the scores.

    K folds, each with one multinomial logistic regression and one linear outcome regression per
    level on the other folds.  A level that a training side has never seen has propensity 0 (trimmed) and
    the training side's mean outcome."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.regression import LinearRegression
    y = cfg.outcome
    level = F.lit(None).cast("double")
    for i, v in enumerate(levels):
        level = F.when(F.col(treatment) == F.lit(v), float(i)).otherwise(level)
    base = add_folds(df, cfg) if "fold" not in df.columns else df
    base = base.withColumn("_level", level).where(F.col(y).isNotNull() & F.col("_level").isNotNull())
    pre = Preprocessor().fit(base, x_cols)
    base = cut_lineage(pre.transform(base))
    parts = []
    for k in range(cfg.n_folds):
        train, out = base.where(F.col("fold") != k), base.where(F.col("fold") == k)
        seen = {int(r[0]): (r[1], r[2]) for r in train.groupBy("_level").agg(F.count(F.lit(1)), F.avg(y)).collect()}
        if not seen:
            continue
        mean = sum(n * m for n, m in seen.values()) / sum(n for n, _ in seen.values())
        if len(seen) > 1:
            share = LogisticRegression(featuresCol=pre.output, labelCol="_level", family="multinomial", probabilityCol="_prob",
                                       rawPredictionCol="_raw", predictionCol="_pred", regParam=1e-6).fit(train)
            out = share.transform(out).withColumn("_prob", vector_to_array("_prob")).drop("_raw", "_pred")
        else:
            out = out.withColumn("_prob", F.array(*[F.lit(1.0 if i in seen else 0.0) for i in range(len(levels))]))
        for i in range(len(levels)):
            e = F.coalesce(F.get("_prob", F.lit(i)), F.lit(0.0)) if i in seen else F.lit(0.0)
            out = out.withColumn(f"_e{i}", e)
            if i in seen:
                fit = LinearRegression(featuresCol=pre.output, labelCol=y, predictionCol=f"_m{i}", regParam=1e-6)
                out = fit.fit(train.where(F.col("_level") == i)).transform(out)
            else:
                out = out.withColumn(f"_m{i}", F.lit(float(mean)))
            own = F.when(F.col("_level") == i, (F.col(y) - F.col(f"_m{i}")) / F.greatest(F.col(f"_e{i}"), F.lit(trim)))
            out = out.withColumn(f"_score{i}", F.col(f"_m{i}") + F.coalesce(own, F.lit(0.0)))
        parts.append(out.drop("_prob", pre.output, *[f"_m{i}" for i in range(len(levels))]))
    out = parts[0] if parts else base.withColumns({f"{c}{i}": F.lit(None).cast("double") for i in range(len(levels)) for c in ("_e", "_score")})
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut_lineage(out)


def doubly_robust(df: DataFrame, treatment: str, levels, x_cols, cfg: CausalConfig = CausalConfig(), trim: float = 0.01,
                  segment=()) -> tuple[DataFrame, DataFrame]:
    """(effects, trimming report).  Effects of each level but the first against the first, over all
    rows or per ``segment``: ``level``, ``n``, ``point_estimate``, ``se``, ``ci_lower``, ``ci_upper``, ``p_value``.
    The report has per level: ``n`` rows that took it, ``n_low`` rows whose propensity for it is below
    ``trim``, ``share_low``, ``least`` propensity."""
    scored = doubly_robust_scores(df, treatment, levels, x_cols, cfg, trim)
    each = F.explode(F.array(*[F.struct(F.lit(str(v)).alias("level"), (F.col(f"_score{i}") - F.col("_score0")).alias("s"))
                               for i, v in enumerate(levels) if i])).alias("x")
    n = F.col("n").cast("double")
    fx = (scored.select(*segment, each).groupBy(*segment, F.col("x.level").alias("level"))
          .agg(F.count(F.lit(1)).alias("n"), F.avg("x.s").alias("point_estimate"), F.stddev_samp("x.s").alias("_sd"))
          .withColumn("se", F.col("_sd") / F.sqrt(n)).drop("_sd"))
    fx = fx.withColumns({"ci_lower": F.col("point_estimate") - cfg.z * F.col("se"), "ci_upper": F.col("point_estimate") + cfg.z * F.col("se"),
                         "p_value": normal_two_sided_p(F.try_divide("point_estimate", F.nullif("se", F.lit(0.0))))})
    shares = F.explode(F.array(*[F.struct(F.lit(str(v)).alias("level"), (F.col("_level") == i).alias("own"), F.col(f"_e{i}").alias("e"))
                                 for i, v in enumerate(levels)])).alias("x")
    report = (scored.select(shares).groupBy(F.col("x.level").alias("level"))
              .agg(F.count_if("x.own").alias("n"), F.count_if(F.col("x.e") < trim).alias("n_low"),
                   F.avg((F.col("x.e") < trim).cast("double")).alias("share_low"), F.min("x.e").alias("least")))
    return fx, report
