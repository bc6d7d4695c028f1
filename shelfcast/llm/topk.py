"""Exact top-k by inner product with a pivot-distance index.

Vectors are lifted by one coordinate so that all have the length M of the longest; the
largest inner product with a query is then the smallest distance.  Each vector is keyed by
its nearest pivot and its distance to it and stored in blocks sorted by that key, so a block
is a ring (annulus) around a pivot.  A query looks first at the ring nearest to its own
distance; its k-th best there bounds the rings it still has to see by the triangle
inequality.  Inside a block, rings are taken outwards while the bound shrinks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.common import cut_lineage, shuffle_partitions

PIVOTS, SAMPLE = 32, 2000  # pivots are chosen among this many vectors (lowest id hashes)
BLOCK, QUERY_BLOCK, RING = 1024, 1024, 128
SLACK = 1e-9  # relative room for rounding in the bounds; scores themselves are exact


def quantized(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``id``, ``v`` (int64 bytes of floor(scale * x)) and ``sq`` (squared length, double).

    Rows without a key, with a null vector, or with a null or non-finite component take no
    part; repeated rows count once.  Shorter vectors are as if filled up with zeros."""
    x = F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))))
    fine = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(
        F.col(vector).cast("array<double>"),
        lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = [np.array(v, np.int64) for v in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([v.astype("<i8").tobytes() for v in vs], pa.binary()),
                                   pa.array([float((v.astype(float) ** 2).sum()) for v in vs], pa.float64())],
                                  ["id", "v", "sq"])

    return (rows.where(fine).select(F.col(key).cast("long").alias("id"), x.alias("x"))
            .mapInArrow(pack, "id long, v binary, sq double").dropDuplicates(["id", "v"]))


def matrix(blobs: list[bytes], dims: int = 0) -> np.ndarray:
    d = max([dims, *(len(b) // 8 for b in blobs)])
    out = np.zeros((len(blobs), d), np.int64)
    for i, b in enumerate(blobs):
        out[i, :len(b) // 8] = np.frombuffer(b, "<i8")
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(a.shape[1], b.shape[1])
    return np.pad(a, ((0, 0), (0, d - a.shape[1]))), np.pad(b, ((0, 0), (0, d - b.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows; saturated at 64 bits."""
    a, b = same_width(a, b)
    bound = int(abs(a).max(initial=0)) * int(abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    wide = a.astype(object) @ b.T.astype(object)
    return np.clip(wide, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Pivots:
    """Pivots with the lifted distance to data vectors and to queries."""

    def __init__(self, sample: np.ndarray, top: float, n: int = PIVOTS):
        self.top = top  # the largest squared length
        chosen = [0] if len(sample) else []
        far = np.full(len(sample), np.inf)
        while chosen and len(chosen) < min(n, len(sample)):  # farthest first
            far = np.minimum(far, ((sample - sample[chosen[-1]]).astype(float) ** 2).sum(1))
            if far.max() <= 0:
                break
            chosen.append(int(far.argmax()))
        self.v = sample[chosen]
        self.sq = (self.v.astype(float) ** 2).sum(1)
        self.lift = np.sqrt(np.maximum(top - self.sq, 0))

    def distances(self, v: np.ndarray, queries: bool) -> np.ndarray:
        a, b = same_width(v, self.v)
        a, b = a.astype(float), b.astype(float)
        sq = (a * a).sum(1)
        lift = np.zeros(len(a)) if queries else np.sqrt(np.maximum(self.top - sq, 0))
        d = (sq + lift ** 2)[:, None] + (self.sq + self.lift ** 2)[None] - 2 * (a @ b.T + lift[:, None] * self.lift[None])
        return np.sqrt(np.maximum(d, 0))


def keyed(rows: DataFrame, pivots, queries: bool) -> DataFrame:
    """Add the nearest pivot, the distance to it, and to every pivot for queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = pivots.value.distances(matrix(b.column(1).to_pylist()), queries)
                near = d.argmin(1)
                yield pa.record_batch([*b.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]),
                                       pa.array([x.tobytes() for x in d], pa.binary())],
                                      ["id", "v", "sq", "pivot", "dist", "all"])

    return rows.mapInArrow(run, "id long, v binary, sq double, pivot int, dist double, all binary")


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows in order of (pivot, distance) packed in blocks of at most ``size`` rows of one
    pivot.  Equal keys spread over as many blocks as they need."""
    spark = rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "pivot", "lo", "hi", "ids", "vs", "dists", "alls"]
        kinds = [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.binary()),
                 pa.list_(pa.float64()), pa.list_(pa.binary())]

        def packed(rs, i):
            d = [r["dist"] for r in rs]
            vals = [f"{rs[0]['part']}-{i}", rs[0]["pivot"], d[0], d[-1], [r["id"] for r in rs], [r["v"] for r in rs], d,
                    [r["all"] for r in rs]]
            return pa.record_batch([pa.array([v], k) for v, k in zip(vals, kinds)], names)

        held, n = [], 0
        for b in batches:
            for r in b.to_pylist():
                if held and (r["pivot"] != held[-1]["pivot"] or len(held) == size):
                    yield packed(held, n)
                    held, n = [], n + 1
                held.append(r)
        if held:
            yield packed(held, n)

    order = ["pivot", "dist", "id", "v"]
    return cut_lineage(
        rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(run, "block string, pivot int, lo double, hi double, ids array<long>, vs array<binary>, "
                         "dists array<double>, alls array<binary>"))


def best(q_ids, q, q_all, pivot, radius, v_ids, v, dists, k: int, top: float):
    """The k best rows of one block for each query of a block of queries: (query index, ids,
    scores).  Rings of the block are taken by their gap to the queries' own distances."""
    nq = len(q_ids)
    score = np.full((nq, k), np.iinfo(np.int64).min)
    who = np.full((nq, k), np.iinfo(np.int64).max)
    own = q_all[:, pivot]
    q_sq = (q.astype(float) ** 2).sum(1)
    radius = radius.copy()
    edges = list(range(0, len(v_ids), RING))
    gaps = np.stack([np.maximum(np.maximum(dists[s] - own, own - dists[min(s + RING, len(v_ids)) - 1]), 0) for s in edges])
    scale = SLACK * (1 + np.sqrt(top) + np.sqrt(q_sq))
    for c in np.argsort(gaps.min(1), kind="stable"):
        live = np.flatnonzero(gaps[c] <= radius + scale)
        if not len(live):
            continue
        rows = slice(edges[c], edges[c] + RING)
        s = products(q[live], v[rows])
        ids = np.broadcast_to(v_ids[rows], s.shape)
        skip = ids == q_ids[live][:, None]
        s = np.where(skip, np.iinfo(np.int64).min, s)
        ids = np.where(skip, np.iinfo(np.int64).max, ids)
        s, ids = np.hstack([score[live], s]), np.hstack([who[live], ids])
        at = np.lexsort((ids, np.where(s == np.iinfo(np.int64).min, np.iinfo(np.int64).max, -s)), axis=-1)[:, :k]
        score[live], who[live] = np.take_along_axis(s, at, 1), np.take_along_axis(ids, at, 1)
        full = who[live, k - 1] != np.iinfo(np.int64).max
        d = np.sqrt(np.maximum(q_sq[live] + top - 2 * score[live, k - 1].astype(float), 0))
        radius[live] = np.where(full, np.minimum(radius[live], d * (1 + SLACK)), radius[live])
    return score, who, radius


def search(rows: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding",
           scale: int = 256) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each vector that ``is_query`` (a
    column expression on the key) the k largest inner products with other rows, all if there
    are fewer, ties to the smaller id.  Rows with the query's own id are left out.  An empty
    table gives no row.

    Each block of queries meets, pivot by pivot, the blocks whose ring its bounds reach."""
    spark = rows.sparkSession
    data = cut_lineage(quantized(rows, key, vector, scale))
    top = data.agg(F.max("sq")).first()[0] or 0.0
    sample = [r.v for r in data.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).select("v").collect()]
    pivots = spark.sparkContext.broadcast(Pivots(matrix(sample), top))  # PIVOTS rows
    vb = blocks(keyed(data, pivots, False), BLOCK)
    wanted = data.withColumnRenamed("id", key).where(is_query).withColumnRenamed(key, "id")
    qb = blocks(keyed(wanted, pivots, True), QUERY_BLOCK)
    directory = vb.select(F.col("block").alias("vblock"), F.col("pivot").alias("vpivot"), "lo", "hi")

    def load(b, i):
        at = lambda n: b.column(n)[i].as_py()
        q = matrix(at("q_vs"))
        return np.array(at("q_ids"), np.int64), q, np.stack([np.frombuffer(x) for x in at("q_alls")])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, q, q_all = load(b, i)
                radius = np.frombuffer(b.column("radius")[i].as_py()) if b.column("radius")[i].is_valid else np.full(len(ids), np.inf)
                v_ids = np.array(b.column("ids")[i].as_py(), np.int64)
                score, who, radius = best(ids, q, q_all, b.column("pivot")[i].as_py(), radius, v_ids,
                                          matrix(b.column("vs")[i].as_py()), np.array(b.column("dists")[i].as_py()), k, top)
                has = who != np.iinfo(np.int64).max
                j = np.nonzero(has)[0]
                yield pa.record_batch([
                    pa.array([b.column("qblock")[i].as_py()] * len(j), pa.string()), pa.array(j.astype(np.int32)),
                    pa.array(ids[j]), pa.array(who[has]), pa.array(score[has])],
                    ["qblock", "place", "query_id", "vec_id", "score"])

    found = "qblock string, place int, query_id long, vec_id long, score long"
    payload = vb.select(F.col("block").alias("vblock"), "pivot", "ids", "vs", "dists")
    queries = qb.select(F.col("block").alias("qblock"), F.col("pivot").alias("q_pivot"), F.col("lo").alias("q_lo"),
                        F.col("hi").alias("q_hi"), F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"), F.col("alls").alias("q_alls"))

    # the ring nearest to a query block's own ring gives the first bounds
    gap = F.greatest(F.col("lo") - F.col("q_hi"), F.col("q_lo") - F.col("hi"), F.lit(0.0))
    nearest = (queries.select("qblock", "q_pivot", "q_lo", "q_hi")
               .join(directory, F.col("q_pivot") == F.col("vpivot"))
               .groupBy("qblock").agg(F.min_by("vblock", F.struct(gap, "vblock")).alias("vblock")))
    first = cut_lineage(
        queries.join(nearest, "qblock").join(payload, "vblock").withColumn("radius", F.lit(None).cast("binary"))
        .select("qblock", "q_ids", "q_vs", "q_alls", "radius", "pivot", "ids", "vs", "dists").mapInArrow(meet, found))
    kth = (first.groupBy("qblock", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
           .where(F.col("n") == k).groupBy("qblock").agg(F.collect_list(F.struct("place", "score")).alias("kth")))  # at most QUERY_BLOCK

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each query block: every query's bound, and per pivot the distances it reaches."""
        for b in batches:
            for i in range(b.num_rows):
                ids, q, q_all = load(b, i)
                radius = np.full(len(ids), np.inf)
                sq = (q.astype(float) ** 2).sum(1)
                for x in b.column("kth")[i].as_py() or []:
                    radius[x["place"]] = np.sqrt(max(sq[x["place"]] + top - 2 * float(x["score"]), 0)) * (1 + SLACK)
                room = radius + SLACK * (1 + np.sqrt(top) + np.sqrt(sq))
                n = q_all.shape[1]
                yield pa.record_batch([
                    pa.array([b.column("qblock")[i].as_py()] * n, pa.string()), pa.array(np.arange(n, dtype=np.int32)),
                    pa.array((q_all - room[:, None]).min(0)), pa.array((q_all + room[:, None]).max(0)),
                    pa.array([radius.tobytes()] * n, pa.binary())], ["qblock", "vpivot", "low", "high", "radius"])

    spans = cut_lineage(queries.join(kth, "qblock", "left").select("qblock", "q_ids", "q_vs", "q_alls", "kth")
                        .mapInArrow(reach, "qblock string, vpivot int, low double, high double, radius binary"))
    pairs = (spans.join(directory, "vpivot").where((F.col("hi") >= F.col("low")) & (F.col("lo") <= F.col("high")))
             .select("qblock", "vblock", "radius"))
    rest = (pairs.join(queries, "qblock").join(payload, "vblock")
            .select("qblock", "q_ids", "q_vs", "q_alls", "radius", "pivot", "ids", "vs", "dists").mapInArrow(meet, found))
    w = Window.partitionBy("qblock", "place", "query_id").orderBy(F.desc("score"), "vec_id")
    return (rest.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
