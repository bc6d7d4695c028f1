"""Packing: optimal length buckets and token-budget batches.

Texts are cut into pieces of at most MAX_LENGTH words.  Dynamic programming over the global
histogram of piece lengths chooses the BUCKETS padded lengths with the least padding in all;
inside a bucket, pieces fill batches whose padded size stays within BUDGET.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import cut_lineage, numbered

MAX_LENGTH, BUCKETS, BUDGET = 2048, 16, 16384
FAR = np.iinfo(np.int64).max // 4
WORD = r"[^\x20\x09-\x0D]+"


def optimal_buckets(histogram: dict[int, int], k: int) -> list[int]:
    """At most ``k`` ascending upper bounds such that rounding every length up to the next
    bound adds the least; the last is the largest length."""
    length = np.array(sorted(histogram), np.int64)
    m = len(length)
    if not m:
        return []
    n = np.concatenate([[0], np.cumsum([histogram[x] for x in length.tolist()])])
    total = np.concatenate([[0], np.cumsum([x * histogram[x] for x in length.tolist()])])
    # cost[i, j]: lengths i..j-1 padded to length[j-1]
    cost = np.full((m + 1, m + 1), FAR)
    for j in range(1, m + 1):
        cost[:j, j] = length[j - 1] * (n[j] - n[:j]) - (total[j] - total[:j])
    best = np.full(m + 1, FAR)
    best[0] = 0
    back = []
    for _ in range(min(k, m)):
        sums = best[:, None] + cost
        back.append(sums.argmin(0))
        best = np.append(FAR, sums.min(0)[1:])
    bounds, j = [], m
    for choice in reversed(back):
        bounds.append(int(length[j - 1]))
        j = int(choice[j])
    return bounds[::-1]


def pieces(docs: DataFrame, max_length: int = MAX_LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``piece``, ``start`` (word offset) and ``n_tokens`` (words): texts in pieces of
    at most ``max_length``; a text without words, or null, is one piece of none."""
    n = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    last = F.greatest(F.floor((F.col("words") + (max_length - 1)) / max_length), F.lit(1)).cast("int") - 1
    return (docs.select(F.col(key).cast("long").alias(key), n.alias("words"))
            .select(key, "words", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
            .select(key, "piece", (F.col("piece") * F.lit(max_length).cast("long")).alias("start"),
                    F.least(F.lit(max_length).cast("long"), F.col("words") - F.col("piece") * F.lit(max_length).cast("long")).alias("n_tokens")))


def pack(docs: DataFrame, k: int = BUCKETS, budget: int = BUDGET, max_length: int = MAX_LENGTH,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: ``key``, ``piece``, ``start``, ``n_tokens``, ``bucket`` (padded length),
    ``padding``, ``batch`` (number within the bucket) and ``slot`` (row of the batch).

    Pieces of no words have no bucket, batch or slot.  In a bucket, batches fill in order of
    key, piece (nulls first, equal keys by length).  The driver gets the histogram, at most
    ``max_length`` rows; places in a bucket come from global numbering, so a hot bucket is
    spread over tasks like any other rows."""
    rows = cut_lineage(pieces(docs, max_length, key, text))
    histogram = {r[0]: r[1] for r in rows.where("n_tokens > 0").groupBy("n_tokens").count().collect()}
    bounds = optimal_buckets(histogram, k)
    empty = rows.where("n_tokens = 0").withColumns({
        "bucket": F.lit(None).cast("long"), "padding": F.lit(0).cast("long"),
        "batch": F.lit(None).cast("long"), "slot": F.lit(None).cast("long")})
    if not bounds:
        return empty
    bucket, first, count = F.lit(bounds[-1]), F.lit(0), 0
    before = {}
    for low, b in zip([0, *bounds], bounds):
        before[b] = count
        count += sum(n for x, n in histogram.items() if low < x <= b)
    for b in reversed(bounds[:-1]):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(bucket)
    for b in bounds:
        first = F.when(F.col("bucket") == b, F.lit(before[b])).otherwise(first)
    full = rows.where("n_tokens > 0").withColumn("bucket", bucket.cast("long"))
    room = F.greatest(F.floor(F.lit(budget) / F.col("bucket")), F.lit(1)).cast("long")
    at = F.col("_at") - first
    packed = (numbered(full, ["bucket", key, "piece", "n_tokens"], "_at")
              .withColumns({"padding": F.col("bucket") - F.col("n_tokens"),
                            "batch": F.floor(at / room).cast("long"), "slot": (at % room).cast("long")}).drop("_at"))
    return packed.unionByName(empty).select(key, "piece", "start", "n_tokens", "bucket", "padding", "batch", "slot")
