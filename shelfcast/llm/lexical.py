"""Ranked lexical search with hashed max-sketches.

A term's impact in a document is ``10**9 tf div (1000 tf + 20 m)``, m growing with the
document's length; a score sums weight times impact over the item's terms.  Terms are hashed
into buckets and a document's impacts fold into the maxima of their buckets, rounded up to one
byte each: its sketch.  For a batch of documents one product of the sketches with the items'
bucket weights bounds every score from above.  Each item then rescores documents exactly, in
descending order of their bounds, until the next bound is below its 50th best score.

Items are taken in blocks of bounded bytes, so what is broadcast does not grow with their
number.  A block reads the documents' text once, into a table of the occurrences of the block's
terms; statistics and scores come from that table.

Cases: null or empty texts have no terms, match nothing and count nowhere; items without terms
return no rows; equal scores go by ascending ``doc_id``, null ids last; repeated documents count
and rank as documents of their own, repeated items return their rows again; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import cut_lineage, numbered, slices, text_or_empty

TOP = 50
BUCKETS = 512      # coordinates of a sketch
STEP = 3922        # of an impact (at most 10**6) to one byte's step, rounded up
BATCH = 4096       # documents whose bounds are looked up together
PROBE = 64         # documents rescored between two looks at the threshold
BLOCK_BYTES = 1 << 20  # text of the items that are searched together
SALT = 32          # partial rankings per item before the last one

# every byte that is no part of a term becomes a space; A-Z become a-z
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, with repeats."""
    return text.translate(FOLD).split()


def occurrences(docs: DataFrame, ids: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Per document with terms: ``key``, ``n`` (terms with repeats), and its terms in ``ids`` as
    ``at`` (their numbers) with ``tf``, both little-endian 32-bit arrays."""
    known = docs.sparkSession.sparkContext.broadcast(ids)  # terms of one block: at most BLOCK_BYTES and one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for b in slices(batches):
            keys, ns, ats, tfs = [], [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                found = terms(t)
                if not found:
                    continue
                at, tf = np.unique(np.fromiter((i for i in map(get, found) if i is not None), np.int32), return_counts=True)
                keys.append(k)
                ns.append(len(found))
                ats.append(at.astype("<i4").tobytes())
                tfs.append(tf.astype("<i4").tobytes())
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(ns, pa.int64()), pa.array(ats, pa.binary()),
                                   pa.array(tfs, pa.binary())], ["key", "n", "at", "tf"])

    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "key long, n long, at binary, tf binary")


def statistics(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and per numbered term the documents that hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(at), pa.array(df[at])], ["at", "df"])

    n, length = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    out = np.zeros(size, np.int64)
    held = index.select("at").mapInArrow(run, "at long, df long").groupBy("at").agg(F.sum("df").alias("df")).toArrow()
    out[held.column("at").to_numpy()] = held.column("df").to_numpy()
    return n, length, out


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Best:
    """The best documents of one item so far."""

    def __init__(self):
        self.score = self.key = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def floor(self, top: int) -> int:
        """A score below this one can't enter."""
        return int(self.score[-1]) if len(self.score) == top else 1

    def add(self, score: np.ndarray, key: np.ndarray, null: np.ndarray, top: int) -> None:
        ok = score > 0
        s, k, z = np.r_[self.score, score[ok]], np.r_[self.key, key[ok]], np.r_[self.null, null[ok]]
        by = np.lexsort((k, z, -s))[:top]
        self.score, self.key, self.null = s[by], k[by], z[by]


class Batch:
    """Some documents with their impacts, sketches and exact scores."""

    def __init__(self, at: list[bytes], tf: list[bytes], n: np.ndarray, docs: int, length: int):
        self.size = np.fromiter((len(a) // 4 for a in at), np.int64, len(at))
        self.first = np.cumsum(self.size) - self.size
        self.at = np.frombuffer(b"".join(at), "<i4")
        count = np.frombuffer(b"".join(tf), "<i4").astype(np.int64)
        m = 50 + 50 * n * docs // length
        self.impact = 1_000_000_000 * count // (1000 * count + 20 * np.repeat(m, self.size))

    def sketches(self, bucket: np.ndarray) -> np.ndarray:
        """Per document the rounded-up maxima of the impacts in each bucket."""
        code = (-(-self.impact // STEP)).astype(np.uint8)
        by = np.argsort(code, kind="stable")  # the last write of a place is its maximum
        out = np.zeros((len(self.size), BUCKETS), np.uint8)
        out[np.repeat(np.arange(len(self.size)), self.size)[by], bucket[self.at[by]]] = code[by]
        return out

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of some documents for the item whose terms have ``weight`` (else 0)."""
        size = self.size[rows]
        start = np.cumsum(size) - size
        at = np.repeat(self.first[rows] - start, size) + np.arange(size.sum())
        total = np.r_[0, np.cumsum(weight[self.at[at]] * self.impact[at])]
        return total[start + size] - total[start]


def ranked(index: DataFrame, items: list[np.ndarray], weight: np.ndarray, docs: int, length: int, top: int) -> DataFrame:
    """``item`` (its place in ``items``), ``key``, ``score``: of each task's documents the best
    ``top`` per item."""
    shared = index.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        number = np.arange(len(weight), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (number >> np.uint64(40)).astype(np.int64) % BUCKETS
        lookup = np.zeros((BUCKETS, len(items)))  # sums of integers below 2**53: exact
        for i, t in enumerate(items):
            np.add.at(lookup[:, i], bucket[t], weight[t])
        best = [Best() for _ in items]
        own = np.zeros(len(weight), np.int64)
        for whole in batches:
            for s in range(0, whole.num_rows, BATCH):
                b = whole.slice(s, BATCH)
                keys = b.column(0)
                null = keys.is_null().to_numpy(zero_copy_only=False)
                key = keys.fill_null(0).to_numpy()
                batch = Batch(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(1).to_numpy(), docs, length)
                bound = (batch.sketches(bucket).astype(np.float64) @ lookup) * STEP
                for i, t in enumerate(items):
                    may = np.flatnonzero(bound[:, i] >= best[i].floor(top))
                    may = may[np.argsort(-bound[may, i], kind="stable")]
                    own[t] = weight[t]
                    for p in range(0, len(may), PROBE):
                        rows = may[p:p + PROBE]
                        if bound[rows[0], i] < best[i].floor(top):
                            break
                        best[i].add(batch.scores(rows, own), key[rows], null[rows], top)
                    own[t] = 0
        for i, x in enumerate(best):
            if len(x.score):
                yield pa.record_batch([pa.array(np.full(len(x.score), i)), pa.array(x.key, mask=x.null), pa.array(x.score)],
                                      ["item", "key", "score"])

    return index.select("key", "n", "at", "tf").mapInArrow(run, "item long, key long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per item its ``top`` documents: ``item``, ``rank``, ``key``, ``score``."""
    spark = docs.sparkSession
    asked = items.select(F.col(item).cast("long").alias("_item"), text_or_empty(item_text).alias("_text"))
    asked = numbered(asked.withColumn("_bytes", F.octet_length("_text") + 1), ["_item", "_text"], "_before", size="_bytes")
    asked = cut_lineage(asked.withColumn("_block", F.floor(F.col("_before") / block_bytes)))
    blocks = asked.agg(F.max("_block")).first()[0]
    out = spark.createDataFrame([], "item long, rank int, key long, score long")
    for block in range(0 if blocks is None else blocks + 1):
        here = asked.where(F.col("_block") == block).orderBy("_before").select("_item", "_text").collect()  # at most block_bytes and one item
        names = [r[0] for r in here]
        texts = [terms(r[1].encode()) for r in here]
        ids = {t: i for i, t in enumerate(sorted({t for x in texts for t in x}))}
        if not ids:
            continue
        index = cut_lineage(occurrences(docs, ids, key, text))
        n, length, df = statistics(index, len(ids))
        wanted = [np.array(sorted({ids[t] for t in x}), np.int64) for x in texts]
        found = ranked(index, wanted, weights(n, df), n, length, top)
        order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
        # an item's partial rankings meet in SALT groups first, then in one of at most SALT * top rows
        some = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
        part = found.withColumn("salt", F.spark_partition_id() % SALT).withColumn("rank", some).where(F.col("rank") <= top)
        last = F.row_number().over(Window.partitionBy("item").orderBy(*order))
        named = spark.createDataFrame(list(enumerate(names)), "item long, _name long")
        out = out.unionByName(part.drop("rank", "salt").withColumn("rank", last).where(F.col("rank") <= top)
                              .join(F.broadcast(named), "item")  # names of one block
                              .select(F.col("_name").alias("item"), F.col("rank").cast("int").alias("rank"), "key", "score"))
    return out.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
