"""Learned quantile forecast on normalised targets (M1, D3).

One pooled linear model per quantile head over features in units of the series: the target and
its lags are centred and scaled per series by a fitted ``SeriesNormalizer``, which travels with the
model and turns forecasts back.  The median is one head; every other quantile is its inner
neighbour plus or minus softplus of its own head, so quantiles are ordered whatever the input.

All heads are fitted together by the smoothed pinball loss

    rho(r) = (sqrt(r^2 + EPS^2) + (2 q - 1) r) / 2

with damped Gauss-Newton steps: one aggregate of loss, gradient and curvature per step, whose
size depends on the number of features only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ForecastConfig, PanelKeys
from ..functions import expressions as X
from ..session import cut_lineage

EPS = 0.02        # width of the loss's round bottom, in normalised units
STEPS = 40        # at most
GAIN = 1e-5       # least relative gain of a step that is followed by another


@dataclass(frozen=True)
class SeriesNormalizer:
    """Centre and scale of the target per series (``params``: series, center, scale), with the mean
    pair for series it has not seen or whose target never varied."""

    params: DataFrame
    keys: PanelKeys
    center: float
    scale: float

    @staticmethod
    def fit(df: DataFrame, keys: PanelKeys = PanelKeys()) -> SeriesNormalizer:
        params = cut_lineage(df.groupBy(*keys.series).agg(F.avg(keys.target).alias("center"), F.stddev_pop(keys.target).alias("scale")))
        c, s = params.agg(F.avg("center"), F.avg(F.nullif("scale", F.lit(0.0)))).first()
        return SeriesNormalizer(params, keys, c or 0.0, s or 1.0)

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_center`` and ``_scale`` of its series."""
        p = self.params.select(*self.keys.series, F.col("center").alias("_center"),
                               F.coalesce(F.nullif("scale", F.lit(0.0)), F.lit(self.scale)).alias("_scale"))
        return (df.join(p, self.keys.series, "left")
                  .withColumns({"_center": F.coalesce("_center", F.lit(self.center)), "_scale": F.coalesce("_scale", F.lit(self.scale))}))

    @staticmethod
    def level(c) -> Column:
        """A value in the target's units, normalised."""
        return (F.col(c) - F.col("_center")) / F.col("_scale")

    @staticmethod
    def spread(c) -> Column:
        """A difference in the target's units, normalised."""
        return F.col(c) / F.col("_scale")

    @staticmethod
    def inverse(c: Column) -> Column:
        return c * F.col("_scale") + F.col("_center")


def heads_to_quantiles(eta: np.ndarray, middle: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of head values -> rows of ordered quantiles, and each head's slope (1 or that of softplus)."""
    slope = 1 / (1 + np.exp(-eta))
    step = np.logaddexp(0, eta)
    slope[:, middle] = 1
    q = np.empty_like(eta)
    q[:, middle] = eta[:, middle]
    for k in range(middle + 1, eta.shape[1]):
        q[:, k] = q[:, k - 1] + step[:, k]
    for k in range(middle - 1, -1, -1):
        q[:, k] = q[:, k + 1] - step[:, k]
    return q, slope


def step_sums(x: np.ndarray, y: np.ndarray, theta: np.ndarray, taus: np.ndarray, middle: int) -> np.ndarray:
    """Loss, rows, gradient and Gauss-Newton curvature of all heads as one flat vector."""
    heads, p = theta.shape
    q, slope = heads_to_quantiles(x @ theta.T, middle)
    r = y[:, None] - q
    root = np.sqrt(r * r + EPS * EPS)
    loss = 0.5 * (root + (2 * taus - 1) * r).sum()
    g = -0.5 * (r / root + 2 * taus - 1)     # by quantile
    h = 0.5 / root                            # majorises the loss's curvature
    # quantile k moves with head j: the middle one always, others from j outwards
    moves = np.array([[1.0 if j == middle or (middle < j <= k) or (k <= j < middle) else 0.0 for j in range(heads)] for k in range(heads)])
    sign = np.array([-1.0 if j < middle else 1.0 for j in range(heads)])
    jac = moves[None] * (slope * sign)[:, None, :]            # rows, quantile, head
    grad = np.einsum("nk,nkj,np->jp", g, jac, x, optimize=True)
    curve = np.einsum("nk,nkj,nki->nji", h, jac, jac, optimize=True)
    hess = np.empty((heads, p, heads, p))
    for i in range(heads):
        for j in range(heads):
            hess[i, :, j, :] = (x * curve[:, i, j][:, None]).T @ x
    return np.concatenate([[loss, len(y)], grad.ravel(), hess.ravel()])


def fit_heads(rows: DataFrame, taus: tuple, width: int) -> tuple[np.ndarray, list[float]]:
    """Heads (quantiles x features) for ``rows`` of ``x`` (array) and ``y``, and the mean loss of each
    accepted step.  Rows with a NULL or NaN in x or y must be gone."""
    order = np.array(taus)
    middle = int(np.argmin(np.abs(order - 0.5)))
    heads = len(taus)

    def sums(theta):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 + heads * width + (heads * width) ** 2)
            for b in batches:
                for s in range(0, b.num_rows, 4096):
                    part = b.slice(s, 4096)
                    x = part.column(0).flatten().to_numpy().reshape(-1, width)
                    total += step_sums(x, part.column(1).to_numpy(), theta, order, middle)
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "v"])

        out = rows.select("x", "y").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        flat = np.zeros(2 + heads * width + (heads * width) ** 2)
        flat[out["i"].to_numpy()] = out["v"].to_numpy()
        n = max(flat[1], 1.0)
        size = heads * width
        return flat[0] / n, flat[2:2 + size] / n, flat[2 + size:].reshape(size, size) / n

    theta = np.zeros((heads, width))
    theta[:, 0] = [0.0 if k == middle else 0.5 for k in range(heads)]
    loss, grad, hess = sums(theta)
    damp, losses = 1e-3, [loss]
    for _ in range(STEPS):
        # damping by the diagonal; unused features keep their 0
        a = hess + damp * np.diag(np.diag(hess) + 1e-9)
        trial = theta - np.linalg.lstsq(a, grad, rcond=None)[0].reshape(theta.shape)
        new = sums(trial)
        if new[0] < loss:
            gain = (loss - new[0]) / max(loss, 1e-12)
            theta, (loss, grad, hess) = trial, new
            losses.append(loss)
            damp = max(damp / 10, 1e-9)
            if gain < GAIN:
                break
        else:
            damp *= 10
            if damp > 1e6:
                break
    return theta, losses


@dataclass(frozen=True)
class QuantileModel:
    """Fitted heads with what prediction needs."""

    normalizer: SeriesNormalizer
    quantiles: tuple
    heads: tuple             # per quantile its coefficients
    levels: tuple            # feature columns in the target's units
    spreads: tuple           # feature columns that are differences in those units
    cycle: str               # column of the target day's weekday, 0..6
    horizon: int
    losses: tuple = ()

    @property
    def width(self) -> int:
        return 1 + len(self.levels) + len(self.spreads) + 6 + 1

    def vector(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_center``, ``_scale`` and the feature array ``x``; NULL features of a level are the
        centre, of a spread 0."""
        out = self.normalizer.attach(rows)
        n = self.normalizer
        x = [F.lit(1.0), *[F.coalesce(n.level(c), F.lit(0.0)) for c in self.levels], *[F.coalesce(n.spread(c), F.lit(0.0)) for c in self.spreads],
             *[(F.col(self.cycle) == d).cast("double") for d in range(6)], F.col("horizon_step") / F.lit(float(self.horizon))]
        return out.withColumn("x", F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in x]))

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` (features and horizon_step) with a column per quantile, in the target's units, 0 at least."""
        out = self.vector(rows)
        eta = [F.aggregate(F.zip_with("x", F.array(*map(F.lit, h)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) for h in self.heads]
        middle = min(range(len(self.quantiles)), key=lambda k: abs(self.quantiles[k] - 0.5))
        soft = lambda e: F.greatest(e, F.lit(0.0)) + F.log1p(F.exp(-F.abs(e)))
        q = {middle: eta[middle]}
        for k in range(middle + 1, len(eta)):
            q[k] = q[k - 1] + soft(eta[k])
        for k in range(middle - 1, -1, -1):
            q[k] = q[k + 1] - soft(eta[k])
        names = [X.quantile_name(t) for t in self.quantiles]
        return (out.withColumns({names[k]: X.clip0(self.normalizer.inverse(q[k])) for k in range(len(eta))})
                   .drop("x", "_center", "_scale"))


def fit_quantiles(rows: DataFrame, cfg: ForecastConfig = ForecastConfig(), levels=("sales", "sales_lag_1", "sales_rmean_7", "sales_rmean_30"),
                  spreads=("sales_rstd_7",), cycle: str = "day_of_week_h", normalizer: SeriesNormalizer | None = None) -> QuantileModel:
    """Fit on direct multi-horizon rows (``forecast.direct_training_rows``): features at the decision, the
    weekday of the target day, ``horizon_step`` and ``label``.  The normaliser is fitted on the decisions' own
    target unless one is given."""
    levels, spreads = (tuple(c for c in cs if c in rows.columns) for cs in (levels, spreads))
    taus = tuple(sorted(cfg.quantiles))
    norm = normalizer or SeriesNormalizer.fit(rows.where("horizon_step = 1"), cfg.keys)
    blank = QuantileModel(norm, taus, (), levels, spreads, cycle, cfg.horizon)
    data = blank.vector(rows.where(F.col("label").isNotNull())).select("x", norm.level("label").alias("y"))
    data = cut_lineage(data.where(F.col("y").isNotNull() & ~F.isnan("y")))  # read once a step
    theta, losses = fit_heads(data, taus, blank.width)
    return QuantileModel(norm, taus, tuple(tuple(map(float, h)) for h in theta), levels, spreads, cycle, cfg.horizon, tuple(losses))
