"""Forecast dataset preparation.

A training sample of the reference's sequence model is an encoder history of
``min..max_encoder_length`` rows followed by ``horizon`` decoder rows.  Here a sample is
one row per decision point t with the encoder and decoder as arrays of structs, built
by bounded window frames over the series window -- no Python, no driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ColumnTaxonomy, ForecastConfig, PanelKeys
from ..functions import expressions as X
from .features import forward_fill, series_window


def add_time_index(df: DataFrame, day_key: str = "d", date: str = "date") -> DataFrame:
    """``time_idx`` from the day key ('d_31' -> 31); without a day key, days since the
    first date of the table (the first date is a scalar subquery, computed once)."""
    if day_key in df.columns:
        return df.withColumn("time_idx", X.day_key_index(day_key))
    first = df.select(F.min(date)).scalar()
    return df.withColumn("time_idx", F.datediff(F.col(date), first))


def cast_for_model(df: DataFrame, categoricals=(), reals=()) -> DataFrame:
    """Categoricals to string, reals to float."""
    cols = {c: F.col(c).cast("string") for c in categoricals if c in df.columns}
    cols.update({c: F.col(c).cast("float") for c in reals if c in df.columns})
    return df.withColumns(cols)


def densify(df: DataFrame, keys: PanelKeys = PanelKeys(), fill_zero=("sales",), carry=()) -> DataFrame:
    """Insert the missing days of every series between its first and last day.

    Every row is followed by the days up to its successor's (``lead`` over the series, then a
    ``sequence``), so the series are exchanged once and nothing is joined.  ``fill_zero``
    columns get 0 on inserted days, ``carry`` columns (constant per series) are copied, every
    other column stays NULL there (forward-fill reals with ``forward_fill``).  Rows that share
    a day stay as they are: only the last of them opens the gap after it."""
    s, d = keys.series, keys.date
    w = Window.partitionBy(*s).orderBy(d)
    last = F.coalesce(F.greatest(F.date_sub(F.lead(d).over(w), 1), F.col(d)), F.col(d))
    rows = df.withColumn("_last", last).withColumn("_day", F.explode(F.sequence(F.col(d), F.col("_last"))))
    seen = F.col("_day") == F.col(d)
    own = [c for c in df.columns if c not in {*s, d, *carry}]
    return rows.select(*s, *carry, F.col("_day").alias(d), *[
        F.when(seen, F.coalesce(F.col(c), F.lit(0.0)) if c in fill_zero else F.col(c))
         .otherwise(F.lit(0.0) if c in fill_zero else F.lit(None)).alias(c) for c in own])


def fit_validate_cut(df: DataFrame, horizon: int, time_idx: str = "time_idx") -> DataFrame:
    """Label rows ``fit`` when time_idx <= max(time_idx) - horizon, else ``validate``.
    The global max is one scalar aggregate."""
    cutoff = df.select(F.max(time_idx)).scalar() - F.lit(horizon)
    return df.withColumn("phase", F.when(F.col(time_idx) <= cutoff, F.lit("fit"))
                                   .otherwise(F.lit("validate")))


def group_normalizer(df: DataFrame, keys: PanelKeys = PanelKeys(), value: str = "sales",
                     transform: str = "softplus") -> DataFrame:
    """Per-series centre/scale of the (transformed) target, plus the global pair for
    series not seen when fitting (D3).  Returns (item, store, center, scale)."""
    t = X.inverse_softplus(F.greatest(F.col(value), F.lit(1e-6))) if transform == "softplus" \
        else F.col(value)
    return (df.groupBy(*keys.series)
              .agg(F.avg(t).alias("center"), F.stddev_pop(t).alias("scale")))


def apply_group_normalizer(df: DataFrame, params: DataFrame, keys: PanelKeys = PanelKeys(),
                           value: str = "sales", transform: str = "softplus") -> DataFrame:
    """Normalised target with the series' pair or, for unseen series, the global mean pair.
    The global pair is a one-row aggregate of the parameter table (scalar subqueries)."""
    g = params.select(F.struct(F.avg("center").alias("c"), F.avg("scale").alias("s"))).scalar()
    g_center, g_scale = g["c"], g["s"]
    t = X.inverse_softplus(F.greatest(F.col(value), F.lit(1e-6))) if transform == "softplus" \
        else F.col(value)
    center = F.coalesce(F.col("center"), g_center)
    scale = F.coalesce(F.nullif(F.col("scale"), F.lit(0.0)), F.nullif(g_scale, F.lit(0.0)), F.lit(1.0))
    return (df.join(params, keys.series, "left")
              .withColumn("target_norm", (t - center) / scale)
              .withColumn("target_center", center).withColumn("target_scale", scale)
              .drop("center", "scale"))


def samples_from_taxonomy(df: DataFrame, cfg: ForecastConfig = ForecastConfig(),
                          taxonomy: ColumnTaxonomy = ColumnTaxonomy(), time_idx: str = "time_idx") -> DataFrame:
    """``window_samples`` with the column roles of a taxonomy (D8): known columns go to
    encoder and decoder, unknown ones (target, lags, rolling stats) to the encoder only;
    columns absent from ``df`` are skipped."""
    known = [c for c in taxonomy.known if c in df.columns]
    unknown = [c for c in taxonomy.unknown if c in df.columns]
    return window_samples(df, cfg, known=known, unknown=unknown, time_idx=time_idx)


def window_samples(df: DataFrame, cfg: ForecastConfig = ForecastConfig(),
                   known=("day_of_week", "sell_price"), unknown=("sales",),
                   time_idx: str = "time_idx", normalizer: DataFrame | None = None) -> DataFrame:
    """One sample per decision row t with at least ``min_encoder_length`` rows of history
    (t included) and exactly ``horizon`` future rows (D4, D5, D8).

    ``encoder`` holds known + unknown columns of rows t-E+1..t; ``decoder`` holds only
    the known columns of rows t+1..t+H -- unknown columns are masked by construction.
    Also emitted: ``encoder_length`` and ``encoder_relative_idx`` /
    ``decoder_relative_idx`` (each element's time index minus t's), and with a fitted
    ``normalizer`` (``group_normalizer``) the series' ``target_center`` and ``target_scale``,
    the mean pair for series it has not seen."""
    keys = cfg.keys
    w = series_window(keys)
    enc_cols = [time_idx, *known, *unknown]
    dec_cols = [time_idx, *known]
    enc = F.collect_list(F.struct(*enc_cols)).over(w.rowsBetween(-(cfg.max_encoder_length - 1), 0))
    dec = F.collect_list(F.struct(*dec_cols)).over(w.rowsBetween(1, cfg.horizon))
    out = (df.select(*keys.series, keys.date, time_idx, enc.alias("encoder"), dec.alias("decoder"))
             .withColumn("encoder_length", F.size("encoder"))
             .filter((F.col("encoder_length") >= cfg.min_encoder_length)
                     & (F.size("decoder") == cfg.horizon)))
    # Time index of every element relative to the decision row t, as int arrays
    # aligned with encoder / decoder (no struct is rebuilt; unused arrays are pruned)
    rel = {f"{part}_relative_idx": F.transform(part, lambda e: e[time_idx] - F.col(time_idx))
           for part in ("encoder", "decoder")}
    out = out.withColumns(rel)
    return out if normalizer is None else with_target_scale(out, normalizer, keys)


def with_target_scale(df: DataFrame, normalizer: DataFrame, keys: PanelKeys = PanelKeys()) -> DataFrame:
    """Join the fitted centre and scale of each series (one row per series)."""
    g = normalizer.select(F.struct(F.avg("center").alias("c"), F.avg("scale").alias("s"))).scalar()
    return (df.join(normalizer.select(*keys.series, "center", "scale"), keys.series, "left")
              .withColumn("target_center", F.coalesce("center", g["c"]))
              .withColumn("target_scale", F.coalesce(F.nullif(F.col("scale"), F.lit(0.0)), F.nullif(g["s"], F.lit(0.0)), F.lit(1.0)))
              .drop("center", "scale"))


def prediction_windows(rows: DataFrame, cfg: ForecastConfig = ForecastConfig(), known=("day_of_week",), unknown=("sales",),
                       time_idx: str = "time_idx") -> DataFrame:
    """One sample per series for prediction (D7) from the tagged rows of ``encoder_context``:
    ``encoder`` holds known and unknown columns of the last ``max_encoder_length`` context rows,
    ``decoder`` the known columns of the first ``horizon`` test rows.  Series with fewer than
    ``min_encoder_length`` context rows or without test rows have none.  Both arrays are
    bounded, so one aggregate by series builds them."""
    k = cfg.keys
    of_part = Window.partitionBy(*k.series, "part")
    back = F.count(F.lit(1)).over(of_part) - F.row_number().over(of_part.orderBy(k.date)) + 1
    placed = rows.withColumns({"_back": back, "_n": F.row_number().over(of_part.orderBy(k.date))})
    enc = F.when((F.col("part") == "context") & (F.col("_back") <= cfg.max_encoder_length), F.struct(time_idx, *known, *unknown))
    dec = F.when((F.col("part") == "test") & (F.col("_n") <= cfg.horizon), F.struct(time_idx, *known))
    return (placed.groupBy(*k.series)
                  .agg(F.array_sort(F.collect_list(enc)).alias("encoder"), F.array_sort(F.collect_list(dec)).alias("decoder"))
                  .withColumns({"encoder_length": F.size("encoder"), "decoder_length": F.size("decoder")})
                  .where((F.col("encoder_length") >= cfg.min_encoder_length) & (F.col("decoder_length") > 0)))


def encoder_context(train: DataFrame, test: DataFrame, encoder_length: int,
                    time_idx: str = "time_idx") -> DataFrame:
    """Training tail + test rows (D7, W15, U1): rows of ``train`` with time_idx greater
    than max(train time_idx) - encoder_length (global max, as in the reference), then the
    test rows, tagged by ``part``."""
    cut = train.select(F.max(time_idx)).scalar() - F.lit(encoder_length)
    tail = train.filter(F.col(time_idx) > cut).withColumn("part", F.lit("context"))
    return tail.unionByName(test.withColumn("part", F.lit("test")), allowMissingColumns=True)


def last_value(df: DataFrame, keys: PanelKeys = PanelKeys(), value: str = "sales") -> DataFrame:
    """Last observed value per series (W14): ``max_by(value, date)`` -- a hash
    aggregate with map-side combine, no sort of the series."""
    return df.groupBy(*keys.series).agg(F.max_by(value, keys.date).alias(f"last_{value}"),
                                        F.max(keys.date).alias("last_date"))


__all__ = ["add_time_index", "cast_for_model", "densify", "fit_validate_cut", "group_normalizer",
           "apply_group_normalizer", "window_samples", "with_target_scale", "prediction_windows", "samples_from_taxonomy", "encoder_context", "last_value",
           "forward_fill", "Window"]
