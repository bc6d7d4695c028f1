"""Property test: the Spark feature operators equal a pandas model of the reference's
groupby-shift / rolling / ffill semantics on random short series (NULL and zero prices,
single-row series, unsorted input)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfcast.config import FeatureConfig
from shelfcast.operators import features as feat

SERIES = st.lists(
    st.tuples(st.integers(1, 12),                       # rows in the series
              st.lists(st.one_of(st.none(), st.just(0.0), st.floats(0.5, 20, allow_nan=False)),
                       min_size=12, max_size=12),        # prices (NULL / 0 / value)
              st.lists(st.integers(0, 9), min_size=12, max_size=12)),   # units
    min_size=1, max_size=4)


def pandas_model(pdf: pd.DataFrame, lags, windows) -> pd.DataFrame:
    pdf = pdf.sort_values(["item_id", "store_id", "date"]).reset_index(drop=True)
    g = pdf.groupby(["item_id", "store_id"])
    out = pdf.copy()
    out["sell_price"] = g["sell_price"].transform(lambda x: x.ffill())
    gp = out.groupby(["item_id", "store_id"])["sell_price"]
    out["price_change_abs"] = gp.diff()
    prev = gp.shift(1)
    out["price_change_pct"] = out["price_change_abs"] / prev.replace(0, np.nan)
    out["price_momentum_7d"] = gp.transform(lambda x: x.rolling(7, min_periods=1).mean())
    gs = out.groupby(["item_id", "store_id"])["sales"]
    for L in lags:
        out[f"sales_lag_{L}"] = gs.shift(L)
    for w in windows:
        out[f"sales_rmean_{w}"] = gs.transform(lambda x: x.shift(1).rolling(w, min_periods=1).mean())
        out[f"sales_rstd_{w}"] = gs.transform(lambda x: x.shift(1).rolling(w, min_periods=1).std())
        out[f"sales_rmax_{w}"] = gs.transform(lambda x: x.shift(1).rolling(w, min_periods=1).max())
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SERIES)
def test_features_equal_pandas_model(spark, series):
    rows = []
    for s, (n, prices, units) in enumerate(series):
        for i in range(n):
            rows.append((f"i{s}", "st", dt.date(2021, 1, 1) + dt.timedelta(days=2 * i),
                         float(units[i]), prices[i]))
    rows = rows[::-1]   # input order must not matter
    pdf = pd.DataFrame(rows, columns=["item_id", "store_id", "date", "sales", "sell_price"])
    sdf = spark.createDataFrame(rows, "item_id string, store_id string, date date, sales double, sell_price double")
    lags, windows = (1, 3), (2, 5)
    got = feat.add_rolling_features(feat.add_lag_features(feat.add_price_features(sdf), lags), windows)
    got = got.toPandas().sort_values(["item_id", "store_id", "date"]).reset_index(drop=True)
    want = pandas_model(pdf, lags, windows)
    cols = ["sell_price", "price_change_abs", "price_change_pct", "price_momentum_7d"]
    cols += [f"sales_lag_{L}" for L in lags]
    cols += [f"sales_{k}_{w}" for w in windows for k in ("rmean", "rstd", "rmax")]
    for c in cols:
        a = pd.to_numeric(got[c]).to_numpy(dtype=float)
        b = pd.to_numeric(want[c]).to_numpy(dtype=float)
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12, equal_nan=True, err_msg=c)
    # null policy then warm-up: no NULL left in numerics, first k rows per series dropped
    pol = feat.handle_missing_values(feat.add_lag_features(feat.add_price_features(sdf), lags),
                                     FeatureConfig(warmup_days=2))
    n_expected = sum(max(n - 2, 0) for n, _, _ in series)
    assert pol.count() == n_expected
    assert pol.toPandas().select_dtypes("number").isna().sum().sum() == 0


SLICE_DATA = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(["s1", "s2"]),
                                st.integers(1, 15), st.integers(0, 9)), min_size=1, max_size=6,
                      unique_by=lambda t: (t[0], t[1]))


def reference_mase(y, yhat, hist, season=7):
    mae = np.mean(np.abs(np.asarray(y) - np.asarray(yhat)))
    if len(hist) <= season:
        den = 1.0
    else:
        h = np.asarray(hist, dtype=float)
        den = np.mean(np.abs(h[season:] - h[:-season]))
        den = den if den != 0 else 1e-6
    return mae / den


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SLICE_DATA)
def test_flattened_mase_equals_reference_formula(spark, data):
    from shelfcast.operators import metrics as mt
    rng = np.random.default_rng(len(data))
    hist_rows, fc_rows = [], []
    for item, store, n, seed in data:
        vals = np.random.default_rng(seed).integers(0, 20, n).astype(float)
        for i, v in enumerate(vals):
            hist_rows.append((item, store, dt.date(2021, 1, 1) + dt.timedelta(days=i), float(v)))
        y = float(rng.integers(0, 20))
        fc_rows.append((item, store, "C" + item, y, y - 2, y + float(rng.integers(-3, 4)), y + 2))
    hist = spark.createDataFrame(hist_rows, "item_id string, store_id string, date date, sales double")
    fc = spark.createDataFrame(fc_rows, "item_id string, store_id string, cat_id string, sales double, "
                                        "p10 double, p50 double, p90 double")
    rep = {(r.slice_type, r.slice_value): r.MASE for r in
           mt.evaluation_report(fc, hist, mode="flattened").collect()}
    hp = pd.DataFrame(hist_rows, columns=["item_id", "store_id", "date", "sales"])
    fp = pd.DataFrame(fc_rows, columns=["item_id", "store_id", "cat_id", "sales", "p10", "p50", "p90"])
    for store in fp.store_id.unique():
        sl = fp[fp.store_id == store]
        keys = sl[["item_id", "store_id"]].drop_duplicates()
        h = hp.merge(keys, on=["item_id", "store_id"]).sort_values(["item_id", "store_id", "date"])
        want = reference_mase(sl.sales, sl.p50, h.sales.to_numpy())
        assert rep[("store", store)] == pytest.approx(want, rel=1e-9)
