"""Join helpers shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side we broadcast: rows, and bytes as estimated from the columns' types.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
STRING_BYTES = 64  # a string key counts as so many bytes


def row_bytes(df: DataFrame) -> int:
    """About how wide a row is in memory; arrays, maps and structs count as a string per field."""
    width = {"byte": 8, "short": 8, "integer": 8, "long": 8, "float": 8, "double": 8, "boolean": 8, "date": 8, "timestamp": 8}
    return sum(width.get(f.dataType.typeName(), STRING_BYTES) for f in df.schema.fields) + 16


def key_bound(df: DataFrame, keys, multiplier: int = 1) -> int:
    """Upper bound on the rows of a table keyed by ``keys`` derived from ``df``: the
    number of distinct key tuples (one aggregate over the key columns only; partial
    aggregation keeps the shuffle to distinct keys per task)."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1))).first()[0] * multiplier


def checked_broadcast(small: DataFrame, bound_rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint on ``small`` only when its proven row bound fits, in rows and in bytes;
    otherwise the join stays a shuffle join (sort-merge, AQE may still convert it at run time)."""
    fits = bound_rows <= max_rows and bound_rows * row_bytes(small) <= MAX_BROADCAST_BYTES
    return F.broadcast(small) if fits else small


def numbered(df: DataFrame, keys: list[str], name: str, size: str | None = None) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the order of ``keys`` (nulls first), or with ``size`` the
    running sum of that column over the rows before.  One range exchange, materialised; the
    driver sees one total per partition; no global window.  Ties of all keys are numbered in
    any order, so ``keys`` must make rows unique (or equal)."""
    from pyspark.sql import Window

    from ..session import cut_lineage
    spark = df.sparkSession
    order = [F.col(k).asc_nulls_first() for k in keys]
    step = F.col(size) if size else F.lit(1).cast("long")
    ranged = cut_lineage(df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
                           .sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    total, bases = 0, []
    for part, n in sorted(ranged.groupBy("_part").agg(F.sum(step)).collect()):
        bases.append((part, total))
        total += n
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    base = spark.createDataFrame(bases, "_part int, _base long")  # one row per partition
    return (ranged.join(F.broadcast(base), "_part")
            .withColumn(name, F.col("_base") + F.coalesce(F.sum(step).over(w), F.lit(0)))
            .drop("_part", "_base"))


FEW_VALUES = 10_000   # values of an open bracket that may be listed on the driver


def _value_of_rank(v: DataFrame, rank: int, accuracy: int) -> float:
    """The value of 0-based ``rank`` among the ``_v`` in ascending order.

    A bracket of two values closes in on the rank by sketches of what lies strictly inside
    it; ties at an end of the bracket answer at once.  Each step is one aggregate; only when
    at most FEW_VALUES values are left inside are they listed, with their counts."""
    lo, hi = v.agg(F.min("_v"), F.max("_v")).first()
    while True:
        c = v.agg(F.count_if(F.col("_v") < lo), F.count_if(F.col("_v") <= lo), F.count_if(F.col("_v") < hi)).first()
        below, upto, under = c
        if rank < upto or lo == hi:
            return lo
        if rank >= under:
            return hi
        inside = v.where((F.col("_v") > lo) & (F.col("_v") < hi))
        n, at = under - upto, rank - upto
        if n <= FEW_VALUES:
            for value, count in sorted(inside.groupBy("_v").count().collect()):
                if at < count:
                    return value
                at -= count
        eps = 2.0 / accuracy
        a, b = inside.agg(F.percentile_approx("_v", [max(at / n - eps, 0.0), min((at + 1) / n + eps, 1.0)], accuracy)).first()[0]
        # the ends must stay around the rank; a sketch that fails to move them is left out
        a_below = inside.agg(F.count_if(F.col("_v") < a), F.count_if(F.col("_v") <= b)).first()
        new_lo = a if a_below[0] <= at else lo
        new_hi = b if a_below[1] > at else hi
        if (new_lo, new_hi) == (lo, hi):
            accuracy *= 10
        lo, hi = new_lo, new_hi


def exact_quantile(df: DataFrame, column: str, q: float, accuracy: int = 100_000):
    """Exact linear-interpolated quantile (same definition as ``percentile`` /
    ``quantile_cont``) of the non-null, non-NaN values as a literal Column; NULL for none.
    The two neighbouring ranks are found by :func:`_value_of_rank`; no column is gathered."""
    v = df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    n = v.count()
    if not n:
        return F.lit(None).cast("double")
    pos = q * (n - 1)
    k = math.floor(pos)
    a = _value_of_rank(v, k, accuracy)
    b = _value_of_rank(v, k + 1, accuracy) if pos > k else a
    return F.lit(float(a + (pos - k) * (b - a)))
