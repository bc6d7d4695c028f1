"""Feature pipeline from the CSV layouts: loading, melt, features, null policy, splits."""

import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.config import FeatureConfig, SplitConfig
from shelfcast.operators import features as feat
from shelfcast.operators import panel as pn
from shelfcast.operators import split as sp
from shelfcast.sources import files

from .fixtures import write_csvs

N_DAYS = 120


@pytest.fixture(scope="module")
def data_dir():
    d = tempfile.mkdtemp(prefix="shelfcast-test-")
    write_csvs(d, N_DAYS)
    return d


@pytest.fixture(scope="module")
def merged(spark, data_dir):
    wide = files.load_wide_sales(spark, data_dir)
    cal = files.load_calendar(spark, f"{data_dir}/calendar.csv")
    prices = files.load_prices(spark, f"{data_dir}/sell_prices.csv")
    return pn.load_and_merge(wide, cal, prices)


def test_load_and_merge(merged):
    assert merged.count() == 10 * N_DAYS
    for c in ("item_id", "store_id", "d", "sales", "date", "wm_yr_wk", "sell_price", "has_event", "snap_CA"):
        assert c in merged.columns
    assert "id" not in merged.columns
    assert merged.filter(F.col("sell_price").isNull()).count() == 0
    assert merged.filter(F.col("event_name_1").isNull()).count() == 0


def test_find_sales_file_errors(spark):
    d = tempfile.mkdtemp(prefix="shelfcast-empty-")
    with pytest.raises(FileNotFoundError) as e:
        files.find_sales_file(spark, d)
    assert "sales_train_evaluation.csv" in str(e.value) and "sales_train_validation.csv" in str(e.value)


def test_feature_table(merged):
    out = feat.engineer_features(merged)
    pdf = out.toPandas()
    assert len(pdf) == 10 * (N_DAYS - 30)
    assert len(out.columns) == 45 + 0, sorted(out.columns)
    nums = pdf.select_dtypes(include=[np.number])
    assert not nums.isna().any().any()
    for c in ("sales_lag_1", "sales_lag_30", "sales_rmean_7", "sales_rstd_30", "sales_rmax_30",
              "price_change_pct", "price_momentum_7d", "price_rel_to_dept", "snap_eligible", "is_month_end"):
        assert c in pdf.columns


def test_features_match_pandas(merged):
    """Lags / rolling of the previous W rows / momentum equal a per-series pandas run."""
    out = feat.engineer_features(merged, FeatureConfig(warmup_days=0)).toPandas()
    src = merged.select("item_id", "store_id", "date", "sales", "sell_price").toPandas()
    src = src.sort_values(["item_id", "store_id", "date"])
    g = src.groupby(["item_id", "store_id"])["sales"]
    src["lag7"] = g.shift(7)
    src["rmean7"] = g.transform(lambda x: x.shift(1).rolling(7, min_periods=1).mean())
    src["rstd30"] = g.transform(lambda x: x.shift(1).rolling(30, min_periods=1).std())
    src["mom"] = src.groupby(["item_id", "store_id"])["sell_price"].transform(lambda x: x.rolling(7, min_periods=1).mean())
    j = out.merge(src, on=["item_id", "store_id", "date"])
    assert len(j) == len(src)
    np.testing.assert_allclose(j["sales_lag_7"], j["lag7"].fillna(0))
    np.testing.assert_allclose(j["sales_rmean_7"], j["rmean7"].fillna(0), rtol=1e-9)
    np.testing.assert_allclose(j["sales_rstd_30"], j["rstd30"].fillna(0), rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(j["price_momentum_7d"], j["mom"], rtol=1e-9)


def test_snap_and_calendar(spark):
    df = spark.createDataFrame([("2016-01-01", "CA", 1, 0, 0), ("2016-01-31", "TX", 1, 0, 1),
                                ("2016-01-02", "WI", 0, 0, 1), ("2016-01-03", "NY", 1, 1, 1)],
                               "d string, state_id string, snap_CA int, snap_TX int, snap_WI int")
    df = df.withColumn("date", F.to_date("d"))
    r = {x.state_id: x for x in feat.add_calendar_features(feat.add_snap_features(df)).collect()}
    assert r["CA"].snap_eligible == 1 and r["TX"].snap_eligible == 0 and r["WI"].snap_eligible == 1
    assert r["NY"].snap_eligible == 0
    assert r["CA"].day_of_week == 4 and r["CA"].week_of_year == 53 and r["CA"].is_month_start == 1
    assert r["TX"].is_month_end == 1 and r["WI"].is_weekend == 1


def test_null_policy_ffill_then_zero(spark):
    rows = [("i", "s", d, float(d), p) for d, p in [(1, None), (2, 2.0), (3, None), (4, 0.0), (5, 1.0)]]
    df = spark.createDataFrame(rows, "item_id string, store_id string, t int, sales double, sell_price double")
    df = df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t")))
    out = feat.add_price_features(df)
    got = {r.t: r for r in feat.handle_missing_values(out, FeatureConfig(warmup_days=0)).collect()}
    assert got[1].sell_price == 0.0 and got[3].sell_price == 2.0
    # previous price 0 -> pct NULL, then forward-filled from the previous row's pct (0.0)
    assert got[5].price_change_pct == got[4].price_change_pct


def test_single_split_no_leakage(merged):
    lab = sp.split_labels(merged, SplitConfig(embargo_days=1))
    chk = sp.leakage_check(lab.filter(F.col("split").isNotNull())).first()
    assert chk.leak_free and chk.n_test == 10 * 28
    assert (chk.test_min - chk.train_max).days == 2
    last = merged.agg(F.max("date")).first()[0]
    assert chk.test_min == last - pd.Timedelta(days=28)
    inc = sp.split_labels(merged, SplitConfig(include_last_day=True)).filter("split = 'test'")
    assert inc.agg(F.max("date")).first()[0] == last


def test_rolling_folds(merged):
    folds = sp.rolling_folds(merged, SplitConfig(n_folds=3, step_days=14, embargo_days=1))
    chk = sp.leakage_check(folds).orderBy("fold").collect()
    assert [r.fold for r in chk] == [1, 2, 3] and all(r.leak_free for r in chk)
    assert chk[0].test_min < chk[1].test_min < chk[2].test_min
    many = sp.rolling_folds(merged, SplitConfig(n_folds=10, step_days=28))
    assert many.select("fold").distinct().count() < 10   # folds with an empty test window skipped


def test_split_validation(spark):
    df = spark.createDataFrame([("x",)], "date string")
    with pytest.raises(TypeError):
        sp.split_labels(df)
    with pytest.raises(ValueError):
        sp.split_labels(df.withColumnRenamed("date", "day"))


def test_narrowing(spark):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({"a": rng.integers(0, 100, 1000), "b": rng.uniform(0, 10, 1000),
                        "c": rng.choice(["x", "y", "z"], 1000)})
    df = spark.createDataFrame(pdf)
    assert dict(df.dtypes)["a"] == "bigint"
    n = pn.narrow_schema(df, categorical=["c"])
    assert dict(n.dtypes) == {"a": "tinyint", "b": "float", "c": "string"}


def test_sampling(merged, spark, data_dir):
    wide = files.load_wide_sales(spark, data_dir)
    s = pn.sample_series_fraction(wide, 0.5)
    assert s.count() == 5
    assert pn.sample_series_fraction(wide, 0.5).collect() == s.collect()    # deterministic
    assert pn.sample_n_series(merged, 3).select("item_id", "store_id").distinct().count() == 3
    assert pn.sample_n_series(merged, 100).count() == merged.count()


def test_train_span_days(merged):
    train, test = sp.single_split(merged, SplitConfig(embargo_days=1))
    assert sp.train_span_days(train).first().train_days == N_DAYS - 28 - 1 - 1 - 1
    assert test.select("date").distinct().count() == 28
