"""Forecast dataset preparation and the forecasters."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.config import ForecastConfig
from shelfcast.operators import forecast as fc
from shelfcast.operators import windows as wn


def _series(spark, n=60, seed=1, gaps=()):
    rng = np.random.default_rng(seed)
    rows = []
    for item in ("a", "b"):
        for i in range(n):
            if i in gaps:
                continue
            rows.append((item, "s", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(10 + (i % 7) + rng.integers(0, 3)),
                         1.0 + i / 100, f"d_{i + 1}"))
    return spark.createDataFrame(rows, "item_id string, store_id string, date date, sales double, "
                                       "sell_price double, d string")


def test_time_index(spark):
    df = wn.add_time_index(_series(spark))
    assert df.agg(F.min("time_idx")).first()[0] == 1
    df2 = wn.add_time_index(_series(spark).drop("d"))
    assert df2.agg(F.min("time_idx"), F.max("time_idx")).first() == (0, 59)


def test_window_samples_mask_unknown(spark):
    df = wn.add_time_index(_series(spark)).withColumn("day_of_week", F.weekday("date"))
    cfg = ForecastConfig(horizon=7, max_encoder_length=20, min_encoder_length=10)
    s = wn.window_samples(df, cfg, known=("day_of_week",), unknown=("sales",))
    dec_fields = s.schema["decoder"].dataType.elementType.fieldNames()
    assert "sales" not in dec_fields and "day_of_week" in dec_fields
    assert "sales" in s.schema["encoder"].dataType.elementType.fieldNames()
    # per series: rows with >= 10 history rows and 7 future rows -> 60 - 9 - 7 = 44
    assert s.count() == 2 * 44
    r = s.filter("item_id = 'a' AND time_idx = 30").first()
    assert r.encoder_length == 20 and r.encoder[-1].time_idx == 30 and r.decoder[0].time_idx == 31
    assert r.encoder_relative_idx[0] == -19 and r.decoder_relative_idx[-1] == 7


def test_densify_and_ffill(spark):
    df = _series(spark, n=20, gaps=(5, 6, 7)).drop("d")
    d = wn.densify(df)
    assert d.count() == 2 * 20
    filled = wn.forward_fill(d, ["sell_price"]).filter("date = '2020-01-07'").first()
    assert filled.sales == 0.0 and filled.sell_price == pytest.approx(1.04)


def test_fit_validate_and_context(spark):
    df = wn.add_time_index(_series(spark))
    lab = wn.fit_validate_cut(df, 14)
    assert lab.filter("phase = 'validate'").agg(F.min("time_idx")).first()[0] == 47
    train, test = df.filter("time_idx <= 50"), df.filter("time_idx > 50")
    ctx = wn.encoder_context(train, test, 10)
    assert ctx.filter("part = 'context'").agg(F.min("time_idx")).first()[0] == 41
    assert ctx.filter("part = 'test'").count() == test.count()


def test_group_normalizer_unseen(spark):
    df = _series(spark)
    params = wn.group_normalizer(df.filter("item_id = 'a'"))
    out = wn.apply_group_normalizer(df, params)
    b = out.filter("item_id = 'b'").first()
    a = out.filter("item_id = 'a'").first()
    assert b.target_center == pytest.approx(a.target_center)   # global pair for unseen series
    m = out.filter("item_id = 'a'").agg(F.avg("target_norm"), F.stddev_pop("target_norm")).first()
    assert m[0] == pytest.approx(0, abs=1e-9) and m[1] == pytest.approx(1)


def test_seasonal_quantiles(spark):
    df = _series(spark)
    cfg = ForecastConfig(horizon=14, max_encoder_length=30, min_series_residuals=5)
    f = fc.seasonal_quantiles(df, cfg)
    assert f.count() == 2 * 14
    rows = f.collect()
    assert all(r.p10 <= r.p50 <= r.p90 and r.p10 >= 0 for r in rows)
    # step h and h+7 share the seasonal base
    a = {r.horizon_step: r for r in rows if r.item_id == "a"}
    assert a[1].p50 == a[8].p50
    st = fc.interval_stats(f).first()
    assert st.n_predictions == 28 and st.mean_interval_width >= 0


def test_pooled_fallback(spark):
    df = _series(spark)
    short = df.filter("item_id = 'b' AND date < '2020-01-12'")
    both = df.filter("item_id = 'a'").unionByName(short)
    cfg = ForecastConfig(horizon=7, max_encoder_length=30, min_series_residuals=10)
    q = fc.seasonal_residual_quantiles(both, cfg)
    a = q.filter("item_id = 'a'").first()
    f = {r.item_id: r for r in fc.seasonal_quantiles(both, cfg).filter("horizon_step = 7").collect()}
    base_b = short.orderBy(F.desc("date")).first().sales
    assert f["b"].p90 == pytest.approx(max(0.0, base_b + a.r_p90))


def test_naive_and_mae(spark):
    df = _series(spark)
    hist, fut = df.filter("date < '2020-02-15'"), df.filter("date >= '2020-02-15'")
    cfg = ForecastConfig(horizon=10)
    n = fc.naive_baseline_mae(hist, fut, cfg).first()
    assert n.n_evaluated == 2 * 10 and n.naive_mae >= 0
    f = fc.seasonal_quantiles(hist, ForecastConfig(horizon=10, min_series_residuals=5))
    m = fc.mae_coverage(fc.join_actuals(f, fut, cfg)).first()
    assert m.n_evaluated == 20 and 0 <= m.coverage <= 1


def test_gbt_quantiles(spark):
    from shelfcast.operators import features as feat
    df = feat.add_rolling_features(feat.add_lag_features(_series(spark, n=80), (1,)), (7,))
    df = df.withColumn("day_of_week", F.weekday("date")).fillna(0)
    cfg = ForecastConfig(horizon=3, gbt_iterations=5, gbt_depth=3)
    rows = fc.direct_training_rows(df, cfg, unknown=("sales", "sales_lag_1", "sales_rmean_7"))
    assert rows.filter("item_id = 'a'").count() == 77 + 78 + 79
    day = lambda d: F.lit(d).cast("date")
    rows = fc.phase_labels(rows, day("2020-02-20"), day("2020-03-05"), cfg).cache()
    span = {r.phase: r for r in rows.groupBy("phase").agg(F.min("date").alias("lo"), F.max("label_date").alias("hi")).collect()}
    # no block is decided before another one's labels have ended
    assert str(span["fit"].hi) < "2020-02-20" <= str(span["validate"].lo)
    assert str(span["validate"].hi) < "2020-03-05" <= str(span["calibrate"].lo)
    feats = ["sales", "sales_lag_1", "sales_rmean_7", "day_of_week_h", "horizon_step"]
    fresh = rows.filter("phase = 'calibrate'").withColumn("sales", F.col("sales") + 1)
    _, out = fc.gbt_quantiles(rows, fresh, cfg, feats)
    got = out.select("p10", "p50", "p90").collect()
    assert got and all(r.p10 <= r.p50 <= r.p90 for r in got)


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 0.999, 1.0])
def test_exact_quantile_matches_numpy(spark, q):
    from shelfcast.operators.common import exact_quantile
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(0, 1, 20000), np.full(500, 0.25)])
    df = spark.createDataFrame([(float(x),) for x in vals], "v double")
    got = df.limit(1).select(exact_quantile(df, "v", q, accuracy=1000).alias("x")).first().x
    assert got == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)


def test_taxonomy_masks_unknown_in_decoder(spark):
    from shelfcast.config import ColumnTaxonomy
    from shelfcast.operators import features as feat
    df = wn.add_time_index(feat.add_lag_features(_series(spark), (1, 7)))
    df = df.withColumn("day_of_week", F.weekday("date"))
    s = wn.samples_from_taxonomy(df, ForecastConfig(horizon=5, max_encoder_length=10, min_encoder_length=5),
                                 ColumnTaxonomy())
    enc = set(s.schema["encoder"].dataType.elementType.fieldNames())
    dec = set(s.schema["decoder"].dataType.elementType.fieldNames())
    assert {"sales", "sales_lag_1", "sales_lag_7", "sell_price", "day_of_week"} <= enc
    assert {"sell_price", "day_of_week"} <= dec and not ({"sales", "sales_lag_1", "sales_lag_7"} & dec)


def test_exact_quantile_with_ties_lists_few_values(spark, monkeypatch):
    from shelfcast.operators import common
    monkeypatch.setattr(common, "FEW_VALUES", 50)
    rng = np.random.default_rng(3)
    vals = np.concatenate([np.zeros(30_000), rng.random(20_000), np.full(5_000, 0.5)])
    df = spark.createDataFrame([(float(x),) for x in vals] + [(None,), (float("nan"),)], "v double")
    for q in (0.0, 0.3, 0.5454, 30_000 / 54_999, 29_999 / 54_999, 0.7, 0.99, 1.0):
        col = common.exact_quantile(df, "v", q, accuracy=200)
        got = df.limit(1).select(col.alias("x"))
        assert "collect_list" not in got._jdf.queryExecution().toString()
        assert got.first().x == pytest.approx(float(np.quantile(vals, q)), abs=1e-12)
    assert df.limit(1).select(common.exact_quantile(df.where("v < -1"), "v", 0.5).alias("x")).first().x is None


def test_short_series_use_the_pooled_residual_quantile(spark):
    df = _series(spark)
    cfg = ForecastConfig(horizon=3, min_series_residuals=10 ** 6)
    fitted = fc.fit_seasonal(df, cfg)
    r = [x.r for x in fc._season_rows(df, cfg, []).select(fc._residual(cfg).alias("r")).collect() if x.r is not None]
    row = fitted.first()
    for q, name in zip(cfg.quantiles, ("p10", "p50", "p90")):
        assert row[f"pooled_{name}"] == pytest.approx(float(np.quantile(r, q)))


def test_samples_carry_the_fitted_centre_and_scale(spark):
    df = wn.add_time_index(_series(spark)).withColumn("day_of_week", F.weekday("date"))
    cfg = ForecastConfig(horizon=5, max_encoder_length=10, min_encoder_length=5)
    fitted = wn.group_normalizer(df.filter("item_id = 'a'"))
    out = wn.window_samples(df, cfg, known=("day_of_week",), unknown=("sales",), normalizer=fitted)
    pair = fitted.first()
    for r in out.select("item_id", "target_center", "target_scale").distinct().collect():  # 'b' takes the mean pair, here a's
        assert (r.target_center, r.target_scale) == (pytest.approx(pair.center), pytest.approx(pair.scale))
    assert out.count() == wn.window_samples(df, cfg, known=("day_of_week",), unknown=("sales",)).count()
