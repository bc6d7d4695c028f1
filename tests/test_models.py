"""Learned quantiles, backtests, saved models, sliced samples, growing dictionaries and tables."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.config import CausalConfig, ForecastConfig, SplitConfig
from shelfcast.operators import backtest as bt
from shelfcast.operators import causal as ca
from shelfcast.operators import effects as ef
from shelfcast.operators import features as feat
from shelfcast.operators import forecast as fc
from shelfcast.operators import quantile_model as qm
from shelfcast.operators import sample_slices as ss
from shelfcast.operators import windows as win
from shelfcast.session import scratch_path
from shelfcast.sources import files, models

from .fixtures import causal_pdf

CFG = ForecastConfig(horizon=7, max_encoder_length=90, min_encoder_length=14, min_series_residuals=14)
FIRST = dt.date(2020, 1, 6)


def sales_pdf(n_series=24, n_days=160, seed=5):
    """Series of very different size with a weekly shape and noise in proportion to their level."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n_series):
        level, day = 10 ** rng.uniform(0.5, 3), np.arange(n_days)
        y = level * (1 + 0.4 * np.sin(2 * np.pi * day / 7)) * rng.gamma(12, 1 / 12, n_days)
        rows += [(f"i{i}", "s", FIRST + dt.timedelta(days=int(d)), float(v), 1.0) for d, v in zip(day, y)]
    return pd.DataFrame(rows, columns=["item_id", "store_id", "date", "sales", "sell_price"])


def feature_rows(df):
    f = feat.add_rolling_features(feat.add_lag_features(df, (1, 7)), (7, 30)).withColumn("day_of_week", F.weekday("date"))
    return f.where("sales_rstd_7 is not null and sales_lag_7 is not null")


def decisions(f, cfg):
    last = f.agg(F.max("date")).first()[0]
    return (f.where(F.col("date") == last).withColumn("horizon_step", F.explode(F.sequence(F.lit(1), F.lit(cfg.horizon))))
             .withColumn("day_of_week_h", F.weekday(F.date_add("date", F.col("horizon_step")))))


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(sales_pdf()).cache()


CUT = FIRST + dt.timedelta(days=153)


@pytest.fixture(scope="module")
def learned(panel):
    f = feature_rows(panel.where(F.col("date") < F.lit(CUT)))
    return f, qm.fit_quantiles(fc.direct_training_rows(f, CFG), CFG)


def wql(pred, panel):
    joined = fc.join_actuals(pred.select("item_id", "store_id", "horizon_step", "p10", "p50", "p90"), panel.where(F.col("date") >= F.lit(CUT)), CFG)
    return bt.fold_report(joined.withColumn("actual", F.col("sales")), CFG, by=()).first()


def test_steps_lower_the_loss_and_gradient_is_right():
    rng = np.random.default_rng(0)
    x, y, theta = np.c_[np.ones(50), rng.normal(size=(50, 2))], rng.normal(size=50), rng.normal(size=(3, 3)) * 0.3
    taus = np.array([0.1, 0.5, 0.9])
    flat = qm.step_sums(x, y, theta, taus, 1)
    for k in range(9):
        bump = np.zeros(9)
        bump[k] = 1e-6
        up, down = (qm.step_sums(x, y, theta + s * bump.reshape(3, 3), taus, 1)[0] for s in (1, -1))
        assert flat[2 + k] == pytest.approx((up - down) / 2e-6, abs=1e-4)
    hess = flat[11:].reshape(9, 9)
    assert np.allclose(hess, hess.T) and np.linalg.eigvalsh(hess).min() > -1e-8


def test_learned_quantiles_beat_the_pooled_trees(learned, panel):
    f, model = learned
    assert list(model.losses) == sorted(model.losses, reverse=True) and len(model.losses) > 3
    pred = model.predict(decisions(f, CFG))
    assert pred.count() == 24 * 7 and pred.where("p10 > p50 or p50 > p90 or p10 < 0").count() == 0
    got = wql(pred, panel)
    assert 0.6 <= got.coverage <= 0.95
    rows = fc.phase_labels(fc.direct_training_rows(f, CFG), F.lit(CUT - dt.timedelta(days=56)), F.lit(CUT - dt.timedelta(days=28)), CFG)
    feats = ["sales", "sales_lag_1", "sales_rmean_7", "sales_rmean_30", "sales_rstd_7", "day_of_week_h", "horizon_step"]
    trees = models.gbt_forecaster(rows, CFG, feats)
    assert got.wql < wql(trees.predict(decisions(f, CFG)), panel).wql


def test_forecasts_follow_the_scale_of_a_series(spark, learned):
    f, model = learned
    pdf = sales_pdf()
    big = pdf[pdf.item_id == "i3"].assign(item_id="i3x", sales=lambda d: d.sales * 100)
    f2 = feature_rows(spark.createDataFrame(pd.concat([pdf, big])).where(F.col("date") < F.lit(CUT)))
    model = qm.fit_quantiles(fc.direct_training_rows(f2, CFG), CFG)
    got = {(r.item_id, r.horizon_step): (r.p10, r.p50, r.p90) for r in model.predict(decisions(f2, CFG)).where("item_id like 'i3%'").collect()}
    for h in range(1, 8):
        one, hundred = (got[i, h] for i in ("i3", "i3x"))
        assert hundred == pytest.approx(tuple(100 * v for v in one), rel=1e-6)


def test_unseen_series_and_missing_features(spark, learned):
    _, model = learned
    rows = spark.createDataFrame([("new", "s", 5.0, None, None, None, None, 3, 1), ("i0", "s", None, None, None, None, None, None, 7)],
                                 "item_id string, store_id string, sales double, sales_lag_1 double, sales_rmean_7 double, "
                                 "sales_rmean_30 double, sales_rstd_7 double, day_of_week_h int, horizon_step int")
    assert all(r.p10 is not None and r.p10 <= r.p50 <= r.p90 for r in model.predict(rows).collect())


# ---- saved objects ---------------------------------------------------------------------------

def same_rows(a, b):
    key = lambda df: sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect())
    assert key(a) == key(b)


def test_saved_objects_give_equal_scores(spark, learned, panel):
    f, model = learned
    new = spark.newSession()
    path = lambda n: scratch_path(spark, f"models/{n}")
    again = models.load_fitted(new, models.save_fitted(spark, model, path("quantiles")))
    same_rows(again.predict(decisions(f, CFG)).select("item_id", "horizon_step", "p10", "p50", "p90"),
              model.predict(decisions(f, CFG)).select("item_id", "horizon_step", "p10", "p50", "p90"))
    r = ca.cell_mean_residuals(spark.createDataFrame(causal_pdf(600)), CausalConfig(outcome="sales", treatment="price",
                               confounders=("is_holiday",), segment=("category",), fold_keys=("row_id",))).cache()
    cfg = CausalConfig(fold_keys=("row_id",), n_trees=3, max_depth=3, n_half_samples=2)
    for name, fitted in (("linear", ef.fit_linear(r, ["base_volatility"], cfg)),
                         ("honest", ef.fit_honest_forest(r, ["category", "base_volatility"], cfg, n_groups=2, trees=2)),
                         ("forest", ca.fit_forest(r, ["category", "base_volatility"], cfg)[0])):
        p = path(name)
        models.save_fitted(spark, fitted, p)
        models.save_fitted(spark, fitted, p)  # replaces
        cols = ["row_id", "effect", "ci_lower", "ci_upper"]
        same_rows(models.load_fitted(new, p).effect(r).select(*cols), fitted.effect(r).select(*cols))
    rows = fc.phase_labels(fc.direct_training_rows(f, CFG), F.lit(CUT - dt.timedelta(days=56)), F.lit(CUT - dt.timedelta(days=28)), CFG)
    trees = models.gbt_forecaster(rows, ForecastConfig(horizon=7, gbt_iterations=3, gbt_depth=3), ["sales", "sales_rmean_7", "horizon_step"])
    loaded = models.load_fitted(new, models.save_fitted(spark, trees, path("trees")))
    same_rows(loaded.predict(decisions(f, CFG)).select("item_id", "horizon_step", "p10", "p90"),
              trees.predict(decisions(f, CFG)).select("item_id", "horizon_step", "p10", "p90"))
    with pytest.raises(FileNotFoundError):
        models.load_fitted(spark, path("nothing"))
    with pytest.raises(TypeError):
        models.save_fitted(spark, object(), path("odd"))


# ---- backtest -----------------------------------------------------------------------------------

def test_folds_equal_separate_fits(spark, panel):
    split = SplitConfig(test_days=7, n_folds=3, step_days=14, embargo_days=2, include_last_day=True)
    short = spark.createDataFrame([("z", "s", FIRST + dt.timedelta(days=159 - i), float(i), 1.0) for i in range(3)], panel.schema)
    rows = panel.unionByName(short)
    got = bt.fold_forecasts(rows, split, CFG).cache()
    assert got.where("item_id = 'z'").count() == 0  # never in a training side
    for fold, cut in enumerate(bt.fold_cutoffs(rows, split), 1):
        train = panel.where(F.col("date") < F.date_sub(F.lit(cut), 2))
        test = panel.where((F.col("date") >= F.lit(cut)) & (F.col("date") < F.date_add(F.lit(cut), 7)))
        want = fc.join_actuals(fc.seasonal_quantiles(train, CFG, carry=()), test, CFG)
        cols = ["item_id", "horizon_step", "p10", "p50", "p90"]
        same_rows(got.where(F.col("fold") == fold).select(*cols, "actual"), want.select(*cols, F.col("sales").alias("actual")))
    rep = bt.fold_report(got, CFG).collect()
    assert sorted(r.fold for r in rep) == [1, 2, 3] and all(r.n_series == 24 and r.n_rows == 168 for r in rep)


def test_one_scan_whatever_the_folds(panel):
    plans = [bt.fold_forecasts(panel, SplitConfig(test_days=7, n_folds=n, step_days=7), CFG)._jdf.queryExecution().executedPlan().toString()
             for n in (1, 6)]
    assert plans[0].count("Exchange hash") == plans[1].count("Exchange hash") == 1
    assert bt.fold_forecasts(panel.limit(0), SplitConfig(), CFG).count() == 0


def test_best_model_is_never_worse_than_naive(spark, panel):
    hist, val = panel.where(F.col("date") < F.lit(CUT)), panel.where(F.col("date") >= F.lit(CUT))
    rng = np.random.default_rng(1)
    walk = pd.DataFrame({"item_id": "walk", "store_id": "s", "date": [FIRST + dt.timedelta(days=i) for i in range(160)],
                         "sales": 500 + np.cumsum(rng.normal(0, 1, 160)) + 3.0 * np.arange(160), "sell_price": 1.0})
    walk = spark.createDataFrame(walk)
    hist, val = hist.unionByName(walk.where(F.col("date") < F.lit(CUT))), val.unionByName(walk.where(F.col("date") >= F.lit(CUT)))
    hist = hist.unionByName(spark.createDataFrame([("gone", "s", FIRST, 4.0, 1.0)], hist.schema))
    best = {r.item_id: r for r in bt.best_per_series(bt.point_candidates(hist, CFG), val, CFG).collect()}
    assert len(best) == 26 and best["walk"].model == "drift" and best["gone"].model == "naive" and best["gone"].n_val == 0
    assert all(r.val_mae <= r.naive_mae for r in best.values() if r.n_val)
    assert {r.model for r in best.values()} >= {"mean", "drift"} or {r.model for r in best.values()} >= {"seasonal", "drift"}
    out = bt.forecast_with_best(panel, 7, CFG)
    assert out.count() == 24 * 7 and out.groupBy("item_id").agg(F.count_distinct("model").alias("k")).where("k > 1").count() == 0


# ---- samples, dictionaries, narrow tables ----------------------------------------------------------

@pytest.mark.parametrize("chunk", [1, 10, 1000])
def test_slices_give_the_window_samples(panel, chunk):
    t = win.add_time_index(panel.where("item_id in ('i1', 'i2')")).withColumn("day_of_week", F.weekday("date"))
    cfg = ForecastConfig(horizon=5, max_encoder_length=12, min_encoder_length=4)
    sl = ss.sample_slices(t, cfg, ("day_of_week",), ("sales",), chunk=chunk)
    same_rows(ss.read_samples(sl, cfg, ("day_of_week",), ("sales",)), win.window_samples(t, cfg, ("day_of_week",), ("sales",)))
    held = sl.agg(F.sum(F.size("rows"))).first()[0]
    assert held <= 320 * (1 + 17 / chunk)
    short = t.where("time_idx < 8")
    assert ss.sample_slices(short, cfg, ("day_of_week",), ("sales",)).count() == 0


def test_dictionary_grows_without_moving_codes(spark):
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "c string")
    first = ca.ordinal_dictionary(df("m", "b", None, "m"), "c")
    second = ca.extend_dictionary(first, df("z", "a", "b", None, "a"), "c")
    third = ca.extend_dictionary(second, df("a", "z"), "c")
    want = {"b": 0, "m": 1, "a": 2, "z": 3}
    assert {r.c: r.c_code for r in second.collect()} == want == {r.c: r.c_code for r in third.collect()}
    assert {r.c: r.c_code for r in ca.extend_dictionary(first.limit(0), df("q", "p"), "c").collect()} == {"p": 0, "q": 1}


def test_narrow_table_widens_and_reads_back(spark):
    path = scratch_path(spark, "tables/narrow-test")
    with pytest.raises(FileNotFoundError):
        files.read_narrow(spark, path)
    one = spark.createDataFrame([(1, 2, 0.5, "a"), (3, None, None, None)], "x long, y long, v double, s string")
    assert files.append_narrow(one, path) == {"x": "tinyint", "y": "tinyint", "v": "float", "s": "string"}
    two = spark.createDataFrame([(40_000, 2 ** 40, 1.5, "b")], "x long, y long, v double, s string")
    assert files.append_narrow(two, path)["x"] == "int"
    three = spark.createDataFrame([(7, 0.25)], "x long, v double")  # small again, and without some columns
    assert files.append_narrow(three, path) == {"x": "int", "v": "float", "y": "bigint", "s": "string"}
    got = files.read_narrow(spark, path)
    assert dict(got.dtypes) == {"x": "int", "y": "bigint", "v": "float", "s": "string"}
    assert sorted((r.x, r.y, r.v, r.s) for r in got.select("x", "y", "v", "s").collect()) == [
        (1, 2, 0.5, "a"), (3, None, None, None), (7, None, 0.25, None), (40_000, 2 ** 40, 1.5, "b")]
