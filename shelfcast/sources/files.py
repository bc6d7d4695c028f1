"""File sources and sinks.

Readers take explicit schemas where the layout is fixed (calendar, prices) so no
inference pass runs over the data.  The wide sales file has one column per day; its
header names the columns, every day column is cast to double after the read (a header
read, not a scan).  Writers use snappy Parquet; train/test/full go to one dataset
partitioned by ``split`` so a reader of one split prunes the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..config import DAY_PREFIX, SALES_FILE_CANDIDATES
from ..operators.features import normalize_calendar

CALENDAR_SCHEMA = ("date DATE, wm_yr_wk INT, weekday STRING, wday INT, month INT, year INT, d STRING, "
                   "event_name_1 STRING, event_type_1 STRING, event_name_2 STRING, event_type_2 STRING, "
                   "snap_CA INT, snap_TX INT, snap_WI INT")
PRICES_SCHEMA = "store_id STRING, item_id STRING, wm_yr_wk INT, sell_price DOUBLE"
CALENDAR_SCHEMA_COLUMNS = [c.split()[0] for c in CALENDAR_SCHEMA.split(", ")]


def load_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar CSV with a typed date, events filled with 'NoEvent', ``has_event``."""
    cal = spark.read.schema(CALENDAR_SCHEMA).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return normalize_calendar(cal)


def load_prices(spark: SparkSession, path: str) -> DataFrame:
    """Weekly price CSV."""
    return spark.read.schema(PRICES_SCHEMA).option("header", True).csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("text").load(path)  # path existence is checked at analysis
        return True
    except AnalysisException:
        return False


def find_sales_file(spark: SparkSession, data_dir: str, candidates=SALES_FILE_CANDIDATES) -> str:
    """First existing candidate file in ``data_dir``; else FileNotFoundError naming all."""
    paths = [f"{data_dir.rstrip('/')}/{c}" for c in candidates]
    for p in paths:
        if _exists(spark, p):
            return p
    raise FileNotFoundError("No sales file found; looked for: " + ", ".join(paths))


def load_wide_sales(spark: SparkSession, data_dir: str) -> DataFrame:
    """Wide sales CSV from the first existing candidate (S3); day columns as double."""
    path = find_sales_file(spark, data_dir)
    raw = spark.read.option("header", True).csv(path)
    days = [c for c in raw.columns if c.startswith(DAY_PREFIX)]
    other = [c for c in raw.columns if not c.startswith(DAY_PREFIX)]
    return raw.selectExpr(*[f"`{c}`" for c in other], *[f"CAST(`{d}` AS DOUBLE) AS `{d}`" for d in days])


def read_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Feature table written by ``write_splits`` (S5); ``split`` prunes partitions.
    Raises FileNotFoundError when the table is absent."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"Feature table not found at {path}; run the feature pipeline first") from e
    return df.filter(F.col("split") == split) if split else df


def write_splits(labelled: DataFrame, path: str, series=("item_id", "store_id"), date: str = "date") -> None:
    """Write the labelled feature table (train / test / other rows) as one snappy Parquet
    dataset partitioned by ``split`` (K1).  Rows are clustered by series and sorted by
    date within each file, so per-series readers scan contiguous row groups."""
    out = labelled.withColumn("split", F.coalesce(F.col("split"), F.lit("none")))
    (out.repartition("split", *series).sortWithinPartitions(*series, date)
        .write.mode("overwrite").option("compression", "snappy").partitionBy("split").parquet(path))


def save_predictions(predictions: DataFrame, path: str) -> str:
    """Write forecasts as snappy Parquet (K2); returns the path."""
    predictions.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def save_model(model, path: str) -> str:
    """Persist a fitted Spark ML model / pipeline for later phases (K4)."""
    model.write().overwrite().save(path)
    return path


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


# ---- narrowed tables that grow (P12) --------------------------------------------------------

def narrow_types(spark: SparkSession, path: str) -> dict[str, str]:
    """{column: type} of a table written by ``append_narrow``; empty where there is none."""
    import json
    try:
        return json.loads(spark.read.text(f"{path}/types").first()[0])
    except AnalysisException:
        return {}


def append_narrow(df: DataFrame, path: str) -> dict[str, str]:
    """Append ``df`` in the smallest types that hold it and do not fall behind the table's own.  The
    types go to a side file first: files written before keep their narrower ones, which
    ``read_narrow`` reads as the widest; returns the types."""
    import json

    from ..operators.panel import widened
    spark = df.sparkSession
    out = widened(df, narrow_types(spark, path))
    types = dict(out.dtypes)
    spark.createDataFrame([(json.dumps(types),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/types")
    out.write.mode("append").option("compression", "snappy").parquet(f"{path}/data")
    return types


def read_narrow(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table written by ``append_narrow`` under its widest types."""
    types = narrow_types(spark, path)
    if not types:
        raise FileNotFoundError(f"no narrowed table at {path}")
    return spark.read.schema(", ".join(f"`{c}` {t}" for c, t in types.items())).parquet(f"{path}/data")
