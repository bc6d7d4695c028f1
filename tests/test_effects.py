"""Known-truth checks of the interval-bearing effects."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.config import CausalConfig
from shelfcast.operators import causal as ca
from shelfcast.operators import effects as ef

from .fixtures import causal_pdf

CFG = CausalConfig(outcome="sales", treatment="price", confounders=("is_holiday",), segment=("category",),
                   fold_keys=("row_id",), n_folds=3, n_trees=10, max_depth=4)


@pytest.fixture(scope="module")
def resid(spark):
    r = ca.cell_mean_residuals(spark.createDataFrame(causal_pdf()), CFG)
    return r.withColumn("is_elec", (F.col("category") == "electronics").cast("double")).cache()


def covered(rows) -> float:
    return rows.agg(F.avg(F.col("true_tau").between(F.col("ci_lower"), F.col("ci_upper")).cast("double"))).first()[0]


def test_linear_intervals_cover_the_truth(resid):
    model = ef.fit_linear(resid, ["is_elec", "base_volatility"], CFG)
    assert all(abs(b - truth) < 3 * model.cov[i][i] ** 0.5 for i, (b, truth) in enumerate(zip(model.beta, (-1, -1, 1))))
    rows = model.effect(resid)
    assert covered(rows) >= 0.9
    width = rows.agg(F.avg(F.col("ci_upper") - F.col("ci_lower"))).first()[0]
    assert 0.02 < width < 0.6  # narrow enough to tell electronics (-1.7) from the rest (-0.7)
    coef = {r.term: r for r in model.coefficients(resid.sparkSession).collect()}
    assert coef["is_elec"].ci_upper < 0 < coef["base_volatility"].ci_lower and coef["is_elec"].p_value < 0.001


def test_linear_equals_least_squares(resid):
    p = resid.select("r_y", "r_t", "base_volatility").toPandas()
    z = np.stack([p.r_t, p.r_t * p.base_volatility], 1)
    beta = np.linalg.lstsq(z, p.r_y, rcond=None)[0]
    e = p.r_y.to_numpy() - z @ beta
    bread = np.linalg.inv(z.T @ z)
    cov = bread @ (z * (e ** 2)[:, None]).T @ z @ bread * len(p) / (len(p) - 2)
    model = ef.fit_linear(resid, ["base_volatility"], CFG)
    assert model.beta == pytest.approx(tuple(beta)) and np.allclose(model.cov, cov)
    one = model.effect(resid.limit(1)).first()
    x = np.array([1, one.base_volatility])
    assert one.se == pytest.approx(float(np.sqrt(x @ cov @ x))) and one.effect == pytest.approx(float(x @ beta))


def test_linear_takes_missing_and_collinear_x(spark, resid):
    rows = resid.withColumns({"twice": F.col("base_volatility") * 2, "gap": F.when(F.col("is_holiday") == 0, F.col("base_volatility"))})
    both = ef.fit_linear(rows, ["base_volatility", "twice"], CFG).effect(rows)
    one = ef.fit_linear(rows, ["base_volatility"], CFG).effect(rows)
    assert both.agg(F.avg("effect")).first()[0] == pytest.approx(one.agg(F.avg("effect")).first()[0])
    gap = ef.fit_linear(rows, ["gap"], CFG)
    assert gap.n == rows.where("gap is not null").count()
    assert gap.effect(rows).where("gap is null and effect is not null").count() == 0
    assert ef.fit_linear(rows.limit(0), ["gap"], CFG).n == 0


def test_honest_parts_are_disjoint(resid):
    for g in range(3):
        parts = resid.select("row_id", ef.honest_parts(CFG, g).alias("p")).where("p is not null")
        per = parts.groupBy("row_id").agg(F.count_distinct("p").alias("k"))
        assert per.where("k > 1").count() == 0
        n = {r.p: r["count"] for r in parts.groupBy("p").count().collect()}
        assert all(600 < n[p] < 900 for p in ("grow", "estimate"))
    same = resid.where(ef.honest_parts(CFG, 0).eqNullSafe(ef.honest_parts(CFG, 1))).count()
    assert same < 0.6 * resid.count()


def test_honest_forest_covers_the_truth(spark, resid):
    model = ef.fit_honest_forest(resid, ["is_elec", "base_volatility"], CFG, n_groups=6, trees=4)
    rows = model.effect(resid).cache()
    assert rows.count() == 3000 and rows.where("effect is null or se is null").count() == 0
    assert covered(rows) >= 0.9
    width = rows.agg(F.avg(F.col("ci_upper") - F.col("ci_lower"))).first()[0]
    assert width < 1.5, width
    m = {r.is_elec: r.e for r in rows.groupBy("is_elec").agg(F.avg("effect").alias("e")).collect()}
    assert m[1.0] == pytest.approx(-1.7, abs=0.25) and m[0.0] == pytest.approx(-0.7, abs=0.25)
    # leaves hold the estimating rows of their group, each once a tree
    n = {r["group"]: r.n for r in model.leaves.where("tree = 0").groupBy("group").agg(F.sum("n").alias("n")).collect()}
    want = resid.agg(*[F.count_if(ef.honest_parts(CFG, g) == "estimate").alias(str(g)) for g in range(6)]).first()
    assert [n[g] for g in range(6)] == list(want)
    # new rows need the x columns only
    new = spark.createDataFrame([(1.0, 0.2), (0.0, 0.4)], "is_elec double, base_volatility double")
    assert [c.effect < -0.2 for c in model.effect(new).collect()] == [True, True]


def test_student_factor():
    for df, want in ((3, 3.182), (5, 2.571), (7, 2.365), (30, 2.042)):
        assert ef.student_factor(1.959964, df) == pytest.approx(want, rel=0.03)


@pytest.fixture(scope="module")
def discrete(spark):
    """Levels none / small / large, taken the more often the larger a continuous confounder is."""
    rng = np.random.default_rng(3)
    n = 8000
    x, w = rng.normal(0, 1, n), rng.choice(["u", "v"], n)
    raw = np.stack([np.zeros(n), 0.7 * x + 0.5 * (w == "v"), 0.9 * x - 0.5], 1)
    p = np.exp(raw) / np.exp(raw).sum(1, keepdims=True)
    level = (rng.uniform(size=n)[:, None] > p.cumsum(1)).sum(1)
    y = 10 + 3 * x + 2 * (w == "v") + np.array([0, 1, 2.5])[level] + rng.normal(0, 1, n)
    return spark.createDataFrame(pd.DataFrame({"row_id": np.arange(n).astype(str), "x": x, "w": w,
                                               "level": np.array(["none", "small", "large"])[level], "sales": y}))


def test_doubly_robust_effects(discrete):
    fx, report = ef.doubly_robust(discrete, "level", ["none", "small", "large"], ["x", "w"], CFG, trim=0.05)
    got = {r.level: r for r in fx.collect()}
    assert set(got) == {"small", "large"}
    for level, truth in (("small", 1.0), ("large", 2.5)):
        r = got[level]
        assert abs(r.point_estimate - truth) < 0.1 and r.ci_lower < truth < r.ci_upper and r.p_value < 0.05 and r.n == 8000
    # the plain difference is far off: the confounder is not in any cell
    plain = {r.level: r.y for r in discrete.groupBy("level").agg(F.avg("sales").alias("y")).collect()}
    assert plain["large"] - plain["none"] > 3.5
    rep = {r.level: r for r in report.collect()}
    assert sum(r.n for r in rep.values()) == 8000 and 0 < rep["large"].share_low < 0.1 and rep["none"].least > 0


def test_doubly_robust_segments_and_missing_levels(discrete):
    fx, report = ef.doubly_robust(discrete, "level", ["none", "large", "never"], ["x"], CFG, segment=("w",))
    got = {(r.w, r.level): r for r in fx.collect()}
    assert set(got) == {("u", "large"), ("u", "never"), ("v", "large"), ("v", "never")}
    rep = {r.level: r for r in report.collect()}
    assert rep["never"].n == 0 and rep["never"].share_low == 1.0
    with_nulls = discrete.withColumn("sales", F.when(F.col("x") > -3, F.col("sales")))
    assert ef.doubly_robust(with_nulls, "level", ["none", "large"], ["x", "w"], CFG)[0].first().n < 8000
