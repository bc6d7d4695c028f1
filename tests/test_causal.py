"""Known-truth checks of the DML operators on the causal fixture (3,000 rows)."""

import pytest
from pyspark.sql import functions as F

from shelfcast.config import CausalConfig
from shelfcast.operators import causal as ca

from .fixtures import causal_pdf

CFG = CausalConfig(outcome="sales", treatment="price", confounders=("is_holiday",), segment=("category",),
                   fold_keys=("row_id",), n_folds=3, n_trees=10, max_depth=4, n_half_samples=4)


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(causal_pdf())


@pytest.fixture(scope="module")
def resid(data):
    return ca.cell_mean_residuals(data, CFG).cache()


def test_segment_effects_recover_truth(resid):
    fx = {r.category: r for r in ca.segment_effects(resid, CFG).collect()}
    truth = {r.category: r.t for r in resid.groupBy("category").agg(F.avg("true_tau").alias("t")).collect()}
    assert set(fx) == {"electronics", "clothing", "food"}
    for c, r in fx.items():
        assert abs(r.effect - truth[c]) < 0.2, (c, r.effect, truth[c])
        assert r.ci_lower < r.effect < r.ci_upper
        assert r.p_value_rule == 0.001 and r.p_value < 0.05
    assert fx["electronics"].effect < fx["food"].effect


def test_naive_slope_is_biased_by_holiday(data):
    naive = data.groupBy("category").agg(F.regr_slope("sales", "price").alias("b")).collect()
    truth = {"electronics": -1.7, "clothing": -0.7, "food": -0.7}
    assert any(abs(r.b - truth[r.category]) > 0.5 for r in naive)


def test_out_of_fold_means(resid):
    # every row's nuisance comes from the other folds: recompute one cell by hand
    r = resid.filter("category = 'food' AND is_holiday = 0 AND fold = 0").first()
    other = resid.filter("category = 'food' AND is_holiday = 0 AND fold != 0").agg(
        F.avg("sales").alias("y"), F.avg("price").alias("t")).first()
    assert r.m_y == pytest.approx(other.y) and r.m_t == pytest.approx(other.t)


def test_ate_summary(resid):
    fx = ca.segment_effects(resid, CFG)
    a = ca.ate_summary(ca.row_effects(resid, fx, ["category"])).first()
    true_ate = resid.agg(F.avg("true_tau")).first()[0]
    assert abs(a.ATE - true_ate) < 0.2 and a.significant and a.ci_lower < a.ATE < a.ci_upper


def test_linear_cate_slope(resid):
    beta, rows = ca.linear_effects(resid, ["base_volatility"], CFG)
    assert len(beta) == 2 and "effect" in rows.columns
    assert beta[1] > 0   # tau rises with volatility (true slope 1)


def test_binary_ate_sign(data):
    d = data.withColumn("t_bin", (F.col("price") > 20).cast("int"))
    out = ca.binary_treatment_ate(d, F.col("price") > F.lit(20.0), CFG).first()
    assert out.point_estimate < 0 and out.n == 3000


def test_standardize_and_ordinal(spark, data):
    z = ca.standardize(data, ["price"]).agg(F.avg("price").alias("m"), F.stddev_pop("price").alias("s")).first()
    assert z.m == pytest.approx(0, abs=1e-9) and z.s == pytest.approx(1)
    dic = ca.ordinal_dictionary(data, "category")
    codes = {r.category: r.category_code for r in dic.collect()}
    assert codes == {"clothing": 0, "electronics": 1, "food": 2}
    new = spark.createDataFrame([("toys",), ("food",)], "category string")
    got = {r.category: r.category_code for r in ca.ordinal_encode(new, dic, "category").collect()}
    assert got == {"toys": -1, "food": 2}


def test_forest_effects_and_importance(resid):
    r2 = resid.withColumn("is_elec", (F.col("category") == "electronics").cast("double"))
    _, rows, imp = ca.forest_effects(r2, ["is_elec", "base_volatility"], CFG)
    got = imp.collect()
    assert [g.importance for g in got] == sorted([g.importance for g in got], reverse=True)
    assert got[0].feature == "is_elec"
    m = {r.e: r.v for r in rows.groupBy(F.col("is_elec").alias("e")).agg(F.avg("effect").alias("v")).collect()}
    assert m[1.0] < m[0.0]
    assert rows.filter(F.col("ci_lower") > F.col("ci_upper")).count() == 0


def test_gbt_residuals_out_of_fold(data):
    from shelfcast.config import CausalConfig
    cfg = CausalConfig(outcome="sales", treatment="price", confounders=("is_holiday",), segment=("category",),
                       fold_keys=("row_id",), n_folds=3, n_trees=5, max_depth=3)
    d = data.withColumn("is_elec", (F.col("category") == "electronics").cast("double")) \
            .withColumn("hol", F.col("is_holiday").cast("double"))
    r = ca.gbt_residuals(d, ["hol", "is_elec"], cfg)
    assert r.count() == 3000 and r.filter(F.col("r_t").isNull()).count() == 0
    # the price nuisance explains the holiday / category price shifts, so residual
    # prices are centred and far less spread than raw prices
    st = r.agg(F.avg("r_t"), F.stddev("r_t"), F.stddev("price")).first()
    assert abs(st[0]) < 0.5 and st[1] < 0.5 * st[2]
    fx = {x.category: x.effect for x in ca.segment_effects(r, cfg).collect()}
    assert fx["electronics"] < fx["food"]


def test_run_causal_phase(data):
    from shelfcast.plans import phases
    fx, ate = phases.run_causal(data, CFG)
    assert fx.count() == 3
    a = ate.first()
    assert a.n == 3000 and a.ci_lower < a.ATE < a.ci_upper and a.significant


def test_series_levels_do_not_bias_the_slope(spark):
    """40 series with their own level of price and sales, true effect -1."""
    import numpy as np
    rng = np.random.default_rng(11)
    rows = []
    for i in range(40):
        level, base = rng.uniform(5, 40), rng.uniform(20, 400)
        for t in range(120):
            price = level + rng.normal(0, 1)
            rows.append((f"i{i}", "s", "c", int(t % 7), float(price), float(base + 3 * (t % 7) - price + rng.normal(0, 1))))
    df = spark.createDataFrame(rows, "item_id string, store_id string, cat_id string, dow int, price double, sales double")
    cfg = CausalConfig(outcome="sales", treatment="price", confounders=("dow",), segment=("cat_id",),
                       fold_keys=("item_id", "store_id"), n_folds=3)
    fx = ca.segment_effects(ca.cell_mean_residuals(df, cfg), cfg, segment=["item_id", "store_id"]).collect()
    assert len(fx) == 40
    assert abs(sum(r.effect for r in fx) / 40 + 1) < 0.2 and all(abs(r.effect + 1) < 0.6 for r in fx)
    assert sum(r.ci_lower <= -1 <= r.ci_upper for r in fx) >= 36


def test_segments_of_few_rows(spark):
    r = spark.createDataFrame([("a", 1.0, 2.0, 1.0, 1.0), ("b", 1.0, 1.0, 1.0, 1.0), ("b", 3.0, 2.0, 1.0, 1.0), ("c", 1.0, 1.0, 1.0, 1.0),
                               ("c", 2.0, 1.0, 1.0, 1.0)], "g string, r_y double, r_t double, sales double, price double")
    fx = {x.g: x for x in ca.segment_effects(r, CFG, segment=["g"]).collect()}
    assert fx["a"].effect is None and fx["c"].effect is None  # the price does not vary
    assert fx["b"].effect == pytest.approx(2.0) and fx["b"].se is None and fx["b"].p_value_rule == 0.5


def test_half_samples_differ_and_intervals_cover(resid):
    cfg = CausalConfig(outcome="sales", treatment="price", confounders=("is_holiday",), segment=("category",), fold_keys=("row_id",),
                       n_folds=3, n_trees=20, max_depth=4, n_half_samples=10)
    model, rows = ca.fit_forest(resid, ["category", "base_volatility"], cfg)
    out = model.effect(rows)
    cover = out.agg(F.avg(((F.col("true_tau") >= F.col("ci_lower")) & (F.col("true_tau") <= F.col("ci_upper"))).cast("double"))).first()[0]
    assert cover >= 0.9
    trees = {m.toDebugString for m in model.halves}
    assert len(trees) == 10


def test_forest_scores_new_rows(spark, resid):
    model, _ = ca.fit_forest(resid, ["category", "base_volatility"], CFG)
    new = spark.createDataFrame([("electronics", 0.2), ("food", 0.2), ("unseen", 0.3), (None, None)], "category string, base_volatility double")
    got = {r.category: r for r in model.effect(new).collect()}
    assert set(got) == {"electronics", "food", "unseen", None} and got["electronics"].effect < got["food"].effect
    assert all(r.ci_lower <= r.ci_upper for r in got.values())
    assert model.effect(new).columns == ["category", "base_volatility", "effect", "ci_lower", "ci_upper"]
    imp = model.importances(spark).collect()
    assert [r.feature for r in imp] == ["category", "base_volatility"] and sum(r.importance for r in imp) == pytest.approx(1)


def test_phase_three_writes_what_phase_four_reads(spark, tmp_path):
    import numpy as np
    from shelfcast.plans import phases
    rng = np.random.default_rng(5)
    rows = [(f"i{i % 12}", "s", f"c{i % 2}", int(i % 5), float(p := 10 + rng.normal()), float(100 - 2 * p + rng.normal())) for i in range(1200)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, cat_id string, dow int, price double, sales double")
    cfg = CausalConfig(outcome="sales", treatment="price", confounders=("dow",), segment=("cat_id",), fold_keys=("item_id", "store_id"), n_folds=3)
    phases.run_causal(df, cfg, str(tmp_path / "tau"))
    tau = spark.read.parquet(str(tmp_path / "tau"))
    assert tau.count() == 12
    pred = spark.createDataFrame([("i1", "s", "c1", 1, 8.0, 10.0, 12.0), ("new", "s", "c0", 1, 8.0, 10.0, 12.0)],
                                 "item_id string, store_id string, cat_id string, horizon_step int, p10 double, p50 double, p90 double")
    out = {r.item_id: r for r in phases.run_prescriptive(pred, tau, -0.1, str(tmp_path / "out")).output.collect()}
    assert out["i1"].final_p50 > 10 and out["new"].final_p50 > 10
