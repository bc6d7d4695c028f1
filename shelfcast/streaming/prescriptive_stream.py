"""Incremental prescriptive fusion (R1 on a stream).

The reference computes its price-adjusted forecasts in batch.  When forecast files keep
arriving (one batch per model run or per store), the same fusion runs as a Structured
Streaming query: forecast files are the streaming source, the elasticity table is a
static side (stream-static left joins), and the output is appended to a Parquet sink.
The fusion is stateless per row, so the query keeps no state besides source offsets;
the checkpoint location (in the shared checkpoint folder) makes restarts exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import expressions as X
from ..operators.prescriptive import Q, category_tau

FORECAST_SCHEMA = ("item_id string, store_id string, cat_id string, horizon_step int, "
                   "p10 double, p50 double, p90 double")


def fuse(stream: DataFrame, elasticities: DataFrame, delta_p: float) -> DataFrame:
    """Stream-static version of the fallback tiers (series -> category -> global)."""
    e = elasticities.select("item_id", "store_id", "tau")
    cats = category_tau(elasticities)
    # the global mean tau is one number of the static side
    global_tau = elasticities.agg(F.avg("tau")).first()[0]
    out = (stream.join(e, ["item_id", "store_id"], "left").join(cats, "cat_id", "left")
                 .withColumn("tau", F.coalesce("tau", "cat_tau", F.lit(global_tau))).drop("cat_tau"))
    m = X.demand_multiplier("tau", delta_p)
    return out.withColumns({f"final_{q}": F.col(q) * m for q in Q})


def start(spark: SparkSession, forecast_dir: str, elasticities: DataFrame, out_dir: str,
          checkpoint: str, delta_p: float = -0.10, available_now: bool = True) -> StreamingQuery:
    """Start the query; with ``available_now`` it processes every file present and stops."""
    src = spark.readStream.schema(FORECAST_SCHEMA).parquet(forecast_dir)
    w = (fuse(src, elasticities, delta_p).writeStream.format("parquet")
         .option("path", out_dir).option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
