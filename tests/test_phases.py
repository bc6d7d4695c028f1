"""End-to-end phases on the CSV fixtures and small helpers."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcast.config import ForecastConfig
from shelfcast.operators import features as feat
from shelfcast.operators import metrics as mt
from shelfcast.operators import panel as pn
from shelfcast.operators.windows import cast_for_model
from shelfcast.plans import phases
from shelfcast.sources import files

from .fixtures import write_csvs


@pytest.fixture(scope="module")
def phase1(spark):
    d = tempfile.mkdtemp(prefix="shelfcast-phase-")
    write_csvs(d, 150)
    wide = files.load_wide_sales(spark, d)
    cal = files.load_calendar(spark, f"{d}/calendar.csv")
    prices = files.load_prices(spark, f"{d}/sell_prices.csv")
    return d, phases.build_features(wide, cal, prices, f"{d}/features")


def test_build_features_writes_splits(spark, phase1):
    d, res = phase1
    assert os.path.isdir(f"{d}/features/split=train") and os.path.isdir(f"{d}/features/split=test")
    types = dict(res.output.dtypes)
    assert types["day_of_week"] == "tinyint" and types["year"] == "smallint" and types["sales"] == "float"
    chk = mt.null_audit(res.output.drop("split")).filter("n_null > 0").count()
    assert chk == 0
    assert res.output.count() == 10 * (150 - 30)


def test_run_forecast_and_evaluation(spark, phase1):
    d, res = phase1
    cfg = ForecastConfig(horizon=14, max_encoder_length=60, min_series_residuals=10)
    feats = files.read_features(spark, f"{d}/features").withColumn("sales", F.col("sales").cast("double"))
    pred = phases.run_forecast(feats, f"{d}/pred", cfg, model_path=f"{d}/model").output
    assert pred.count() == 10 * 14 and "time_idx" not in pred.columns
    assert spark.read.parquet(f"{d}/model").count() == 10
    short = phases.run_forecast(feats.filter("NOT (item_id = 'FOODS_1_001' AND date > '2016-05-01')"), None, cfg)
    assert short.output.count() == 10 * 14 and short.output.filter("sales IS NULL").count() > 0
    assert phases.run_evaluation(short.output, feats).output.filter("WQL_50 IS NULL").count() == 0
    rep = phases.forecast_report(pred).first()
    assert rep.n_predictions == 140 and 0 <= rep.coverage <= 1 and rep.mae_p50 >= 0
    ev = phases.run_evaluation(pred, feats, f"{d}/report")
    got = {r.slice_type for r in ev.output.collect()}
    assert got == {"global", "category", "store"}
    txt = [f for f in os.listdir(f"{d}/report") if f.startswith("part-")]
    doc = json.loads(open(f"{d}/report/{txt[0]}").read())
    assert set(doc["by_store"]) == {"CA_1", "TX_1"}


def test_small_helpers(spark, phase1):
    _, res = phase1
    df = res.output
    assert pn.select_available(df, ["sales", "nope", "date"]) == ["sales", "date"]
    assert pn.missing_columns(df, ["sales", "nope"]) == ["nope"]
    c = cast_for_model(df, categoricals=["year"], reals=["sales_lag_1"])
    assert dict(c.dtypes)["year"] == "string" and dict(c.dtypes)["sales_lag_1"] == "float"
    inv = {r.family: r.n_columns for r in feat.feature_inventory(df).collect()}
    assert inv == {"lag": 4, "rolling": 8, "price": 5, "calendar": 8, "event_snap": 9}


def test_rows_without_category_are_a_slice(spark):
    f = spark.createDataFrame([("a", "s", None, 10.0, 8.0, 10.0, 12.0), ("b", "s", "C", 20.0, 16.0, 22.0, 24.0)],
                              "item_id string, store_id string, cat_id string, sales double, p10 double, p50 double, p90 double")
    import datetime as dt
    h = spark.createDataFrame([(i, "s", dt.date(2020, 1, 1) + dt.timedelta(k), float(k % 9)) for i in "ab" for k in range(30)],
                              "item_id string, store_id string, date date, sales double")
    for mode in ("per_series", "flattened"):
        rep = mt.evaluation_report(f, h, mode=mode)
        rows = {(r.slice_type, r.slice_value): r for r in rep.collect()}
        assert rows["category", None].MASE == 0.0 and rows["category", "C"].MASE > 0
        assert rows["global", None].MASE == pytest.approx(rows["category", "C"].MASE / 2)
        doc = json.loads(mt.report_json(rep).first().json)
        assert set(doc["by_category"]) == {"nan", "C"}
