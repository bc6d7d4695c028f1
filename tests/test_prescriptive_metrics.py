"""Golden values of the prescriptive fusion and the backtest metrics (literal fixtures)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import metrics as mt
from shelfcast.operators import prescriptive as pr

FC = [("A", "1", 1, 8.0, 10.0, 12.0, "Cat1"), ("A", "1", 2, 9.0, 12.0, 15.0, "Cat1"),
      ("B", "1", 1, 15.0, 20.0, 25.0, "Cat2"), ("B", "1", 2, 14.0, 18.0, 22.0, "Cat2"),
      ("C", "1", 1, 5.0, 8.0, 11.0, "Cat3")]
FC_SCHEMA = "item_id string, store_id string, horizon_step int, p10 double, p50 double, p90 double, cat_id string"
EL = [("A", "1", "Cat1", -2.0), ("B", "1", "Cat2", -1.0)]
EL_SCHEMA = "item_id string, store_id string, cat_id string, tau double"


def test_prescriptive_goldens(spark):
    out = pr.prescriptive_forecast(spark.createDataFrame(FC, FC_SCHEMA), spark.createDataFrame(EL, EL_SCHEMA), -0.10)
    rows = {(r.item_id, r.horizon_step): r for r in out.collect()}
    assert len(rows) == 5
    assert rows[("A", 1)].final_p50 == pytest.approx(12.0)
    assert rows[("C", 1)].final_p50 == pytest.approx(9.2)   # global mean tau -1.5
    assert rows[("C", 1)].tau_source == "global"
    assert rows[("B", 2)].final_p90 == pytest.approx(22 * 1.1)


def test_category_fallback_and_global_only(spark):
    fc = spark.createDataFrame(FC + [("D", "1", 1, 10.0, 10.0, 10.0, "Cat1")], FC_SCHEMA)
    el = spark.createDataFrame(EL, EL_SCHEMA)
    d = pr.prescriptive_forecast(fc, el, -0.10).filter("item_id = 'D'").first()
    assert d.tau == pytest.approx(-2.0) and d.tau_source == "category"
    g = pr.prescriptive_forecast(fc, el, -0.10, fallback="global_only").filter("item_id = 'D'").first()
    assert g.tau == pytest.approx(-1.5)


def test_multiplier_floor_and_null_tau(spark):
    df = spark.createDataFrame([(1, -20.0), (2, None)], "k int, tau double")
    from shelfcast.functions.expressions import demand_multiplier
    r = {x.k: x.m for x in df.select("k", demand_multiplier("tau", 0.1).alias("m")).collect()}
    assert r[1] == 0.0 and r[2] is None


def test_whatif_summary_matches_grid(spark):
    fc = spark.createDataFrame(FC, FC_SCHEMA)
    el = spark.createDataFrame(EL, EL_SCHEMA)
    bp = spark.createDataFrame([("A", "1", 2.0), ("B", "1", 3.0), ("C", "1", 4.0)],
                               "item_id string, store_id string, base_price double")
    s = pr.whatif_summary(fc, el, bp)
    g = pr.whatif_grid(fc, el).groupBy("item_id", "store_id", "delta_p").agg(
        F.sum("final_p50").alias("v"), F.min("final_p10").alias("lo"))
    j = s.join(g, ["item_id", "store_id", "delta_p"])
    assert s.count() == 3 * 61 and j.count() == 3 * 61
    for r in j.collect():
        assert r.new_volume == pytest.approx(r.v) and r.min_downside == pytest.approx(r.lo)
    a = s.filter("item_id = 'A' AND delta_p = -0.1").first()
    assert a.new_volume == pytest.approx(22 * 1.2) and a.new_price == pytest.approx(1.8)
    assert a.stockout_risk == "High" and a.elasticity_label == "Highly Elastic"


MET = [("A", "1", "Cat1", 10.0, 8.0, 10.0, 12.0, 1), ("A", "1", "Cat1", 15.0, 12.0, 14.0, 18.0, 2),
       ("B", "1", "Cat2", 20.0, 16.0, 21.0, 24.0, 1), ("B", "1", "Cat2", 25.0, 20.0, 24.0, 28.0, 2)]
MET_SCHEMA = ("item_id string, store_id string, cat_id string, sales double, p10 double, p50 double, "
              "p90 double, horizon_step int")


def _history(spark):
    rows = [("A", "1", dt.date(2020, 1, 1) + dt.timedelta(days=i), 10.0) for i in range(10)]
    rows += [("B", "1", dt.date(2020, 1, 1) + dt.timedelta(days=i), 20.0) for i in range(10)]
    return spark.createDataFrame(rows, "item_id string, store_id string, date date, sales double")


def test_metric_goldens(spark):
    f = spark.createDataFrame(MET, MET_SCHEMA)
    g = f.agg(mt.wql_expr("sales", "p10", 0.1).alias("w10"), mt.wql_expr("sales", "p50", 0.5).alias("w50"),
              mt.wql_expr("sales", "p90", 0.9).alias("w90"), mt.coverage_expr().alias("cov")).first()
    assert g.w50 == pytest.approx(3 / 70) and g.w10 == pytest.approx(0.04)
    assert g.w90 == pytest.approx(0.0342857, abs=1e-7) and g.cov == 1.0


def test_report_goldens(spark):
    f = spark.createDataFrame(MET, MET_SCHEMA)
    rep = {(r.slice_type, r.slice_value): r for r in mt.evaluation_report(f, _history(spark)).collect()}
    assert rep[("category", "Cat1")].MASE == pytest.approx(500000)
    assert rep[("category", "Cat2")].MASE == pytest.approx(1000000)
    glob = rep[("global", None)]
    assert glob.MASE == pytest.approx(750000) and glob.WQL_50 == pytest.approx(3 / 70)
    assert glob.coverage_pct == 1.0 and glob.coverage_error == pytest.approx(0.2)
    assert glob.calibration == "DRIFT"
    assert rep[("store", "1")].MASE == pytest.approx(750000)
    flat = {(r.slice_type, r.slice_value): r for r in
            mt.evaluation_report(f, _history(spark), mode="flattened").collect()}
    assert flat[("store", "1")].MASE == pytest.approx(0.1392857, abs=1e-7)
    assert flat[("category", "Cat1")].MASE == pytest.approx(500000)


def test_wql_zero_denominator(spark):
    f = spark.createDataFrame([(0.0, 1.0)], "sales double, p50 double")
    assert f.agg(mt.wql_expr("sales", "p50", 0.5).alias("w")).first().w == 0.0


def test_report_json(spark):
    import json
    f = spark.createDataFrame(MET, MET_SCHEMA)
    doc = json.loads(mt.report_json(mt.evaluation_report(f, _history(spark))).first().json)
    assert set(doc) == {"global_metrics", "by_category", "by_store"}
    assert set(doc["by_category"]) == {"Cat1", "Cat2"}
    assert doc["global_metrics"]["MASE"] == pytest.approx(750000)


def test_null_category_not_averaged(spark):
    """A NULL category forms no group in the category mean."""
    el = spark.createDataFrame(EL + [("Z", "1", None, 5.0)], EL_SCHEMA)
    got = {r.cat_id: r.cat_tau for r in pr.category_tau(el).collect()}
    assert got == {"Cat1": -2.0, "Cat2": -1.0}


def test_nan_is_missing_in_null_policy(spark):
    """NaN is treated like NULL and zero-filled by the null policy."""
    from shelfcast.config import FeatureConfig
    from shelfcast.operators import features as feat
    df = spark.createDataFrame([("i", "s", 1, float("nan")), ("i", "s", 2, 3.0)],
                               "item_id string, store_id string, t int, sales double")
    df = df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t")))
    got = {r.t: r.sales for r in feat.handle_missing_values(df, FeatureConfig(warmup_days=0)).collect()}
    assert got == {1: 0.0, 2: 3.0}


def test_report_without_category(spark):
    """Without cat_id there are no category slices and no global MASE (as in the reference)."""
    f = spark.createDataFrame(MET, MET_SCHEMA).drop("cat_id")
    rep = {(r.slice_type, r.slice_value): r for r in mt.evaluation_report(f, _history(spark)).collect()}
    assert set(rep) == {("global", None), ("store", "1")}
    assert rep[("global", None)].MASE is None
    assert rep[("global", None)].WQL_50 == pytest.approx(3 / 70)
    assert rep[("store", "1")].MASE == pytest.approx(750000)


def test_per_row_price_change(spark):
    """dP may be a column aligned with the forecast rows (a vector in the reference)."""
    fc = spark.createDataFrame(FC, FC_SCHEMA).withColumn(
        "dp", F.when(F.col("horizon_step") == 1, F.lit(-0.1)).otherwise(F.lit(0.2)))
    out = {(r.item_id, r.horizon_step): r.final_p50
           for r in pr.prescriptive_forecast(fc, spark.createDataFrame(EL, EL_SCHEMA), F.col("dp")).collect()}
    assert out[("A", 1)] == pytest.approx(12.0) and out[("A", 2)] == pytest.approx(12.0 * 0.6)
