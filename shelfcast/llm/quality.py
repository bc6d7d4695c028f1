"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every word has a fixed sparse random index vector given by its hash.  A word's vector is the
sum of the index vectors of its neighbours over the whole corpus (left and right neighbours
use different places).  Words share a hashed table of ``BUCKETS`` rows, so the model has the
same size for any corpus.  A document is the mean and the spread of its words' vectors; a
two-layer numpy network scores it and a temperature, fitted on rows apart, calibrates it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import cut_lineage, slices, text_or_empty
from shelfcast.llm.spans import BYTE_VALUE, mix, prefix_sums, runs, span_hashes, utf8

BUCKETS, DIMS, NONZERO = 1 << 14, 32, 2
BLOCK = 256  # rows of the table that are added up together
MAX_LABELLED = 20_000  # the network is fitted on so many labelled rows at most, chosen by key hash
HIDDEN, EPOCHS, RATE, DECAY = 16, 400, 0.01, 1e-4

# 1: letters, digits, other scripts; 2: any other visible byte; 0: white space
KIND = np.full(256, 2, np.int8)
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts and the row each belongs to."""
    data, off = utf8(column)
    kind = KIND[data]
    row = np.zeros(len(data) + 1, np.int64)
    np.add.at(row, off[1:-1], 1)
    row = np.cumsum(row)[:-1].astype(np.int32)
    # a row's border ends a run too
    s, e, _ = runs(np.where(kind > 0, row * 2 + kind, 0))
    return span_hashes(prefix_sums(BYTE_VALUE[data]), s, e), row[s]


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.int64) % BUCKETS


def index_places(h: np.ndarray, side: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and signs of the non-zero entries of a word's index vector on one side."""
    own = mix(h + np.uint64(side + 1))
    out = []
    for i in range(NONZERO):
        bits = own >> np.uint64(8 * i)
        out.append(((bits & np.uint64(DIMS - 1)).astype(np.int64), 1 - 2 * ((bits >> np.uint64(6)) & np.uint64(1)).astype(np.int64)))
    return out


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of word vectors (BUCKETS x DIMS, rows of unit length or zero), counted over
    every whole text.  Each task sums its own table; tables are added by block of rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS * DIMS, np.int64)
        for b in slices(batches):
            h, row = tokens(b.column(0))
            if len(h) < 2:
                continue
            near = row[1:] == row[:-1]
            left, right = h[:-1][near], h[1:][near]
            for word, other, side in ((bucket(left), right, 0), (bucket(right), left, 1)):
                for place, sign in index_places(other, side):
                    at = word * DIMS + place
                    table += (np.bincount(at[sign > 0], minlength=len(table))
                              - np.bincount(at[sign < 0], minlength=len(table)))
        blocks = table.reshape(-1, BLOCK * DIMS)
        used = np.flatnonzero(blocks.any(1))
        yield pa.record_batch([pa.array(used.astype(np.int32)),
                               pa.array([blocks[i].astype("<i8").tobytes() for i in used], pa.binary())],
                              ["block", "sums"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BLOCK * DIMS, np.int64)
        for b in batches:
            for x in b.column("sums"):
                total += np.frombuffer(x.as_buffer(), "<i8")
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype("<i8").tobytes()], pa.binary())],
                              ["block", "sums"])

    rows = (docs.select(text_or_empty(text).alias("text")).mapInArrow(count, "block int, sums binary")
            .groupBy("block").applyInArrow(add, "block int, sums binary").collect())
    table = np.zeros((BUCKETS // BLOCK, BLOCK * DIMS))
    for block, sums in rows:
        table[block] = np.frombuffer(sums, "<i8")
    table = table.reshape(BUCKETS, DIMS)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(norm, 1e-9)).astype(np.float32)


def pool(column, table: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the word vectors of each text, and the log of its number
    of words; zeros for a text without words."""
    n = len(column)
    h, row = tokens(column)
    out = np.zeros((n, 2 * DIMS + 1), np.float32)
    if not len(h):
        return out
    v = table[bucket(h)]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    rows, count = row[first], np.diff(np.append(first, len(h)))[:, None]
    mean = np.add.reduceat(v, first, axis=0, dtype=np.float64) / count
    square = np.add.reduceat(v * v, first, axis=0, dtype=np.float64) / count
    out[rows, :DIMS] = mean
    out[rows, DIMS:2 * DIMS] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[rows, -1] = np.log1p(count[:, 0]) / 10
    return out


class Network:
    """Two layers (tanh, logistic) on standardised inputs, with a temperature."""

    def fit(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray, seed: int = 7) -> Network:
        """Full-batch Adam on the rows not ``apart``; the temperature on those that are."""
        fit = ~apart if (~apart).any() and len(set(y[~apart])) > 1 else np.ones(len(y), bool)
        self.mean = x[fit].mean(0) if len(x) else np.zeros(x.shape[1])
        self.scale = np.maximum(x[fit].std(0), 1e-6) if len(x) else np.ones(x.shape[1])
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        rate = y.mean() if len(y) else 0.5
        prior = np.log(max(rate, 1e-3) / max(1 - rate, 1e-3))
        self.w = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, 1)), np.array([prior])]
        self.temperature = 1.0
        if len(set(y)) < 2:
            return self
        self.w[2] = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 1))
        z, t = (x[fit] - self.mean) / self.scale, y[fit][:, None]
        m = [np.zeros_like(p) for p in self.w]
        v = [np.zeros_like(p) for p in self.w]
        for step in range(1, EPOCHS + 1):
            a = np.tanh(z @ self.w[0] + self.w[1])
            p = 1 / (1 + np.exp(-np.clip(a @ self.w[2] + self.w[3], -30, 30)))
            g = (p - t) / len(t)
            ga = (g @ self.w[2].T) * (1 - a * a)
            grads = [z.T @ ga + DECAY * self.w[0], ga.sum(0), a.T @ g + DECAY * self.w[2], g.sum(0)]
            for i, gr in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * gr
                v[i] = 0.999 * v[i] + 0.001 * gr * gr
                self.w[i] = self.w[i] - RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        if apart.any() and len(set(y[apart])) > 1:
            logit, t = self.logits(x[apart]), y[apart]
            loss = [np.logaddexp(0, -np.where(t > 0, 1, -1) * logit / k).mean() for k in TEMPERATURES]
            self.temperature = float(TEMPERATURES[int(np.argmin(loss))])
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        a = np.tanh((x - self.mean) / self.scale @ self.w[0] + self.w[1])
        return (a @ self.w[2] + self.w[3])[:, 0]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


TEMPERATURES = np.exp(np.linspace(np.log(0.25), np.log(8), 60))


def held_out(key: str = "doc_id") -> Column:
    """Rows whose crc32 of the key's text is divisible by 5, and rows without a key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def features(docs: DataFrame, table, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``x`` (pooled vector as float32 bytes) of each row, written as a table.
    ``table`` is a broadcast of :func:`word_vectors`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = pool(b.column(1), table.value)
            yield pa.record_batch([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["key", "x"])

    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    return cut_lineage(rows.mapInArrow(run, "key long, x binary").withColumnRenamed("key", key))


def fit(pooled: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Network:
    """Fit on at most MAX_LABELLED labelled rows that are not held out, repeated rows once; among them, remainder 1
    of the same checksum is kept for the temperature.  Rows without a label take no part; a
    key labelled more than once counts by its largest label."""
    known = (labels.select(F.col(key).cast("long").alias(key), F.col(label).cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & ~held_out(key)).groupBy(key).agg(F.max("y").alias("y")))
    share = min(1.0, 0.97 * MAX_LABELLED / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 40)) < int(share * (1 << 40)))
    rows = (pooled.join(chosen, key).dropDuplicates([key, "x"])
            .select("x", "y", (F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 1).alias("apart"))
            .limit(MAX_LABELLED).collect())
    rows.sort(key=lambda r: (r.x, r.y))  # the fit does not depend on the order of tasks
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows]).reshape(len(rows), 2 * DIMS + 1)
    return Network().fit(x.astype(float), np.array([r.y for r in rows], float), np.array([r.apart for r in rows], bool))


def score(pooled: DataFrame, model: Network, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score``: the probability of label 1 for every row, empty texts too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array([np.frombuffer(r.as_buffer(), np.float32) for r in b.column(1)])
                yield pa.record_batch([b.column(0), pa.array(model.predict(x.astype(float)))], ["key", "score"])

    return (pooled.select(F.col(key).alias("key"), "x")
            .mapInArrow(run, "key long, score double").withColumnRenamed("key", key))


def keep(docs: DataFrame, table, model: Network, least: float, text: str = "text") -> DataFrame:
    """The rows whose text scores ``least`` or more, all columns as they are; null texts are
    scored as empty ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            x = pool(b.column(b.schema.get_field_index(text)).fill_null(""), table.value)
            yield b.filter(pa.array(model.predict(x.astype(float)) >= least))

    return docs.mapInArrow(run, docs.schema)


def shared_vectors(docs: DataFrame, text: str = "text"):
    """The word vectors as a broadcast; BUCKETS x DIMS floats for any corpus."""
    return docs.sparkSession.sparkContext.broadcast(word_vectors(docs, text))
