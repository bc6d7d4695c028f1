"""Window samples without copies.

``window_samples`` copies up to E + H rows into every sample.  Here a series is cut into chunks of
``chunk`` decision rows; a chunk keeps its rows once, with the E - 1 before and H after them that its
samples need, and a sample is an offset into them.  What is written grows with the rows,
``1 + (E + H) / chunk`` times at most, and a chunk bounds the array whatever the series' length.
``read_samples`` cuts the samples when they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ForecastConfig
from .features import series_window

CHUNK = 1024


def sample_slices(df: DataFrame, cfg: ForecastConfig = ForecastConfig(), known=("day_of_week", "sell_price"), unknown=("sales",),
                  time_idx: str = "time_idx", chunk: int = CHUNK) -> DataFrame:
    """(series, chunk, first, rows, samples): ``rows`` are structs of date, time index, known and unknown columns in
    order, ``first`` the place of the chunk's first row in the series (from 1), and ``samples`` structs of ``at``
    (1-based place of the decision row in ``rows``) and ``encoder_length``.  Decision rows with fewer than
    ``min_encoder_length`` rows of history (their own included) or fewer than ``horizon`` rows ahead have no sample;
    chunks without samples are left out."""
    k = cfg.keys
    e, h = cfg.max_encoder_length, cfg.horizon
    rows = df.select(*k.series, k.date, time_idx, *known, *unknown).withColumns({
        "_rn": F.row_number().over(series_window(k)), "_n": F.count(F.lit(1)).over(Window.partitionBy(*k.series))})
    # the chunks whose samples use a row: decisions from rn - h to rn + e - 1
    low = F.floor(F.greatest(F.col("_rn") - h - 1, F.lit(0)) / chunk)
    high = F.floor(F.least(F.col("_rn") + e - 2, F.col("_n") - 1) / chunk)
    rows = rows.withColumn("chunk", F.explode(F.sequence(low, high)))
    per = rows.groupBy(*k.series, "chunk").agg(
        F.max("_n").alias("_n"), F.min("_rn").alias("first"),
        F.array_sort(F.collect_list(F.struct("_rn", k.date, time_idx, *known, *unknown))).alias("_rows"))
    start = F.greatest(F.col("chunk") * chunk + 1, F.lit(cfg.min_encoder_length))
    end = F.least((F.col("chunk") + 1) * chunk, F.col("_n") - h)
    place = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<bigint>"))
    sample = F.transform(place, lambda t: F.struct((t - F.col("first") + 1).cast("int").alias("at"), F.least(t, F.lit(e)).cast("int").alias("encoder_length")))
    kept = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in (k.date, time_idx, *known, *unknown)]))
    return (per.withColumn("samples", sample).where(F.size("samples") > 0)
               .select(*k.series, "chunk", "first", kept.alias("rows"), "samples"))


def read_samples(slices: DataFrame, cfg: ForecastConfig = ForecastConfig(), known=("day_of_week", "sell_price"), unknown=("sales",),
                 time_idx: str = "time_idx") -> DataFrame:
    """The samples of ``sample_slices`` as ``window_samples`` gives them: encoder with known and unknown columns,
    decoder with known ones only, relative indices, no exchange."""
    k = cfg.keys
    s = slices.select(*k.series, "rows", F.explode("samples").alias("_s"))
    here = F.element_at("rows", F.col("_s.at"))
    enc = F.slice("rows", F.col("_s.at") - F.col("_s.encoder_length") + 1, F.col("_s.encoder_length"))
    dec = F.slice("rows", F.col("_s.at") + 1, F.lit(cfg.horizon))
    pick = lambda a, cols: F.transform(a, lambda r: F.struct(*[r[c].alias(c) for c in cols]))
    out = s.select(*k.series, here[k.date].alias(k.date), here[time_idx].alias(time_idx), pick(enc, (time_idx, *known, *unknown)).alias("encoder"),
                   pick(dec, (time_idx, *known)).alias("decoder"), F.col("_s.encoder_length").alias("encoder_length"))
    return out.withColumns({f"{p}_relative_idx": F.transform(p, lambda r: r[time_idx] - F.col(time_idx)) for p in ("encoder", "decoder")})
