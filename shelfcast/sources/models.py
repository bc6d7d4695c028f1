"""Fitted objects on disk (K4): saved once, loaded in another session, equal scores.

A saved object is a folder: ``manifest`` (one line of JSON: kind and plain parameters), a Parquet
table per DataFrame it holds and a Spark ML folder per model.  Any file system Spark writes to
will do.  ``save_fitted`` replaces what was there; the manifest is written last, so a folder
without one is an unfinished save and ``load_fitted`` refuses it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ForecastConfig, PanelKeys
from ..functions import expressions as X
from ..operators.causal import ForestEffects, Preprocessor
from ..operators.effects import HonestForest, LinearEffects
from ..operators.quantile_model import QuantileModel, SeriesNormalizer
from ..session import cut_lineage


@dataclass(frozen=True)
class GbtForecaster:
    """The pooled tree forecaster with its table of conformal residual quantiles by step."""

    model: PipelineModel
    residuals: DataFrame
    quantiles: tuple

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` (features and horizon_step) with prediction and a column per quantile, 0 at least."""
        names = [X.quantile_name(q) for q in self.quantiles]
        out = self.model.transform(rows).join(F.broadcast(self.residuals), "horizon_step", "left")  # a row per step
        shift = lambda n: F.coalesce(F.col(f"r_{n}"), F.lit(0.0))
        return out.withColumns({n: X.clip0(F.col("prediction") + shift(n)) for n in names}).drop(*[f"r_{n}" for n in names])


def gbt_forecaster(rows: DataFrame, cfg: ForecastConfig, feature_cols: list[str]) -> GbtForecaster:
    """Fit on rows labelled by ``forecast.phase_labels``; see ``forecast.gbt_quantiles``."""
    from ..operators.forecast import gbt_quantiles
    model, _ = gbt_quantiles(rows, rows.limit(0), cfg, feature_cols)
    held = model.transform(rows.where("phase = 'calibrate'"))
    r: Column = F.col("label") - F.col("prediction")
    table = held.groupBy("horizon_step").agg(*[F.percentile_approx(r, q, 10000).alias(f"r_{X.quantile_name(q)}") for q in cfg.quantiles])
    return GbtForecaster(model, cut_lineage(table), tuple(cfg.quantiles))


# ---- plain parts ---------------------------------------------------------------------------

def _pre_out(p: Preprocessor) -> dict:
    return {"output": p.output, "numeric": p.numeric, "values": p.values, "stats": {c: list(s) for c, s in p.stats.items()},
            "feature_columns": p.feature_columns, "x_cols": p.x_cols}


def _pre_in(d: dict) -> Preprocessor:
    p = Preprocessor()
    p.output, p.numeric, p.values, p.feature_columns, p.x_cols = d["output"], d["numeric"], d["values"], d["feature_columns"], d["x_cols"]
    p.stats = {c: tuple(s) for c, s in d["stats"].items()}
    return p


def _norm_out(n: SeriesNormalizer) -> dict:
    return {"keys": vars(n.keys), "center": n.center, "scale": n.scale}


def _parts(obj) -> tuple[str, dict, dict, dict]:
    """(kind, plain parameters, tables, Spark ML models) of a fitted object."""
    if isinstance(obj, LinearEffects):
        return "linear_effects", vars(obj), {}, {}
    if isinstance(obj, Preprocessor):
        return "preprocessor", _pre_out(obj), {}, {}
    if isinstance(obj, SeriesNormalizer):
        return "normalizer", _norm_out(obj), {"params": obj.params}, {}
    if isinstance(obj, HonestForest):
        return ("honest_forest", {"pre": _pre_out(obj.preprocess), "z": obj.z, "groups": len(obj.forests)}, {"leaves": obj.leaves},
                {f"forest{g}": f for g, f in enumerate(obj.forests)})
    if isinstance(obj, ForestEffects):
        return ("forest_effects", {"pre": _pre_out(obj.preprocess), "z": obj.z, "x_cols": list(obj.x_cols), "halves": len(obj.halves)}, {},
                {"main": obj.main, **{f"half{g}": f for g, f in enumerate(obj.halves)}})
    if isinstance(obj, QuantileModel):
        plain = {k: v for k, v in vars(obj).items() if k != "normalizer"}
        return "quantile_model", {**plain, "norm": _norm_out(obj.normalizer)}, {"params": obj.normalizer.params}, {}
    if isinstance(obj, GbtForecaster):
        return "gbt_forecaster", {"quantiles": list(obj.quantiles)}, {"residuals": obj.residuals}, {"model": obj.model}
    raise TypeError(f"cannot save a {type(obj).__name__}")


def save_fitted(spark: SparkSession, obj, path: str) -> str:
    """Write a fitted object below ``path``; returns it."""
    kind, plain, tables, models = _parts(obj)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/{name}")
    line = json.dumps({"kind": kind, "plain": plain})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return path


def load_fitted(spark: SparkSession, path: str):
    """The object that ``save_fitted`` wrote; FileNotFoundError without a manifest."""
    try:
        line = spark.read.text(f"{path}/manifest").first()
    except AnalysisException as e:
        raise FileNotFoundError(f"no saved object at {path}") from e
    saved = json.loads(line[0])
    kind, p = saved["kind"], saved["plain"]
    table = lambda name: spark.read.parquet(f"{path}/{name}")
    forest = lambda name: RandomForestRegressionModel.load(f"{path}/{name}")
    norm = lambda d: SeriesNormalizer(table("params"), PanelKeys(**d["keys"]), d["center"], d["scale"])
    if kind == "linear_effects":
        return LinearEffects(tuple(p["x_cols"]), tuple(p["beta"]), tuple(map(tuple, p["cov"])), p["n"], p["z"])
    if kind == "preprocessor":
        return _pre_in(p)
    if kind == "normalizer":
        return norm(p)
    if kind == "honest_forest":
        return HonestForest(_pre_in(p["pre"]), tuple(forest(f"forest{g}") for g in range(p["groups"])), table("leaves"), p["z"])
    if kind == "forest_effects":
        return ForestEffects(_pre_in(p["pre"]), forest("main"), tuple(forest(f"half{g}") for g in range(p["halves"])), tuple(p["x_cols"]), p["z"])
    if kind == "quantile_model":
        return QuantileModel(norm(p["norm"]), tuple(p["quantiles"]), tuple(map(tuple, p["heads"])), tuple(p["levels"]), tuple(p["spreads"]),
                             p["cycle"], p["horizon"], tuple(p["losses"]))
    if kind == "gbt_forecaster":
        return GbtForecaster(PipelineModel.load(f"{path}/model"), table("residuals"), tuple(p["quantiles"]))
    raise ValueError(f"unknown kind {kind} at {path}")
