"""Streaming fusion and the file sinks."""

import tempfile

import pytest

from shelfcast.sources import files
from shelfcast.streaming import prescriptive_stream as ps

from .test_prescriptive_metrics import EL, EL_SCHEMA, FC, FC_SCHEMA


def test_stream_matches_batch(spark):
    from shelfcast.operators.prescriptive import prescriptive_forecast
    root = tempfile.mkdtemp(prefix="shelfcast-stream-")
    fc = spark.createDataFrame(FC, FC_SCHEMA).select("item_id", "store_id", "cat_id", "horizon_step",
                                                      "p10", "p50", "p90")
    el = spark.createDataFrame(EL, EL_SCHEMA)
    fc.filter("item_id = 'A'").write.parquet(f"{root}/in/part=1")
    fc.filter("item_id != 'A'").write.parquet(f"{root}/in/part=2")
    q = ps.start(spark, f"{root}/in/*", el, f"{root}/out", f"{root}/ckpt", -0.10)
    q.awaitTermination(120)
    got = {(r.item_id, r.horizon_step): r.final_p50 for r in spark.read.parquet(f"{root}/out").collect()}
    want = {(r.item_id, r.horizon_step): r.final_p50 for r in prescriptive_forecast(fc, el, -0.10).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_split_sink_roundtrip(spark):
    from pyspark.sql import functions as F
    root = tempfile.mkdtemp(prefix="shelfcast-sink-")
    df = spark.createDataFrame([("a", "s", "2020-01-01", 1.0, "train"), ("a", "s", "2020-01-02", 2.0, "test"),
                                ("a", "s", "2020-01-03", 3.0, None)],
                               "item_id string, store_id string, d string, sales double, split string")
    df = df.withColumn("date", F.to_date("d")).drop("d")
    files.write_splits(df, f"{root}/feat")
    assert files.read_features(spark, f"{root}/feat", "test").count() == 1
    assert sorted(r.split for r in files.read_features(spark, f"{root}/feat").collect()) == ["none", "test", "train"]
    with pytest.raises(FileNotFoundError):
        files.read_features(spark, f"{root}/missing")
    files.save_predictions(df, f"{root}/pred")
    assert spark.read.parquet(f"{root}/pred").count() == 3


def test_model_persistence(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    root = tempfile.mkdtemp(prefix="shelfcast-model-")
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, y double")
    m = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"),
                         LinearRegression(featuresCol="f", labelCol="y")]).fit(df)
    files.save_model(m, f"{root}/m")
    back = files.load_pipeline_model(f"{root}/m")
    assert back.transform(df).count() == 20


def test_find_sales_file_prefers_first_candidate(spark):
    import pandas as pd
    root = tempfile.mkdtemp(prefix="shelfcast-find-")
    for name in ("sales_train_evaluation.csv", "sales_train_validation.csv"):
        pd.DataFrame({"item_id": ["a"], "d_1": [1]}).to_csv(f"{root}/{name}", index=False)
    assert files.find_sales_file(spark, root).endswith("sales_train_validation.csv")


def test_last_value(spark):
    import datetime as dt
    from shelfcast.operators.windows import last_value
    rows = [("a", "s", dt.date(2020, 1, d), float(d)) for d in (3, 1, 2)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, date date, sales double")
    r = last_value(df).first()
    assert r.last_sales == 3.0 and r.last_date == dt.date(2020, 1, 3)
