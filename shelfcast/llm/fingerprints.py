"""Document fingerprints from prefix polynomial hashes.

A text's prefix arrays hold, modulo two primes, the hash of each of its prefixes.  Any span's
hash follows from two entries, so spans compare in constant time and the longest common
extension of two places is found by binary search.  A fingerprint joins the length and the
hash of the whole text with the smallest hashes among all its spans of ``WINDOW`` characters;
the share of these that two fingerprints have in common is their likeness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import shuffle_partitions, slices, text_or_empty
from shelfcast.llm.spans import mix

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 69069421)
WINDOW, SKETCH = 16, 32
_tables: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo ``prime``; grown by doubling, as long as the longest text."""
    got = _tables.get((base, prime))
    if got is None or len(got) < n:
        size, k = max(4096, 1 << max(n - 1, 1).bit_length()), 1
        got = np.ones(size, np.uint64)
        while k < size:
            got[k:2 * k] = got[:k] * np.uint64(pow(base, k, prime)) % np.uint64(prime)
            k *= 2
        _tables[base, prime] = got
    return got[:n]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)


class PrefixHashes:
    """Prefix arrays of one text (as code points)."""

    def __init__(self, c: np.ndarray):
        self.n = len(c)
        self.sums = []
        for base, prime in zip(BASES, PRIMES):
            h = np.zeros(self.n + 1, np.uint64)
            # each term is below 2**31, so sums stay exact for 2**33 characters
            np.cumsum(c * powers(base, prime, self.n) % np.uint64(prime), out=h[1:])
            self.sums.append(h % np.uint64(prime))

    def span(self, s, e) -> np.ndarray:
        """Hashes (both moduli in one 64-bit word) of the spans [s, e), arrays or scalars."""
        s, e = np.asarray(s, np.int64), np.asarray(e, np.int64)
        out = np.zeros(np.broadcast(s, e).shape, np.uint64)
        for h, base, prime in zip(self.sums, BASES, PRIMES):
            p = np.uint64(prime)
            back = powers(pow(base, -1, prime), prime, self.n + 1)
            out = (out << np.uint64(32)) | ((h[e] + p - h[s]) % p * back[s] % p)
        return out

    def equal(self, i: int, other: PrefixHashes, j: int, n: int) -> bool:
        """Whether the spans of ``n`` characters at i here and at j there are equal."""
        return bool(i + n <= self.n and j + n <= other.n and self.span(i, i + n) == other.span(j, j + n))

    def extension(self, i: int, other: PrefixHashes, j: int) -> int:
        """Length of the longest common extension of place i here and place j there."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.equal(i, other, j, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def windows(self, s: int = 0, e: int | None = None) -> np.ndarray:
        """Hashes of all spans of WINDOW characters that start in [s, e)."""
        last = self.n - WINDOW + 1
        at = np.arange(s, min(last, self.n if e is None else e))
        return (mix(self.span(at, at + WINDOW)) >> np.uint64(32)) if len(at) else np.empty(0, np.uint64)


def smallest(h: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct hashes."""
    k = SKETCH
    while True:
        low = np.unique(np.partition(h, k)[:k] if len(h) > k else h)
        if len(low) >= SKETCH or len(h) <= k:
            return low[:SKETCH]
        k *= 4  # many repeats


def render(n: int, whole: int, sketch: np.ndarray) -> str:
    return f"{n:x}:{whole:016x}:" + "".join(f"{x:08x}" for x in sketch.tolist())


def fingerprint(text: str) -> str:
    c = codes(text)
    p = PrefixHashes(c)
    low = smallest(p.windows()) if p.n >= WINDOW else mix(p.span([0], [p.n]))[:p.n] >> np.uint64(32)
    return render(p.n, int(p.span(0, p.n)), low)


def sketch_of(fp: str) -> list[str]:
    tail = fp.rpartition(":")[2]
    return [tail[i:i + 8] for i in range(0, len(tail), 8)]


def likeness(a: str, b: str) -> float:
    """0 to 1: the estimated share (Dice) of spans that the two texts have in common; 1 for equal
    fingerprints, 0 if only one text is empty."""
    if a == b:
        return 1.0
    x, y = set(sketch_of(a)), set(sketch_of(b))
    union = sorted(x | y)[:SKETCH]
    if not union:
        return 0.0
    j = sum(h in x and h in y for h in union) / len(union)
    return 2 * j / (1 + j)


def edit_of(text: str, after: str) -> tuple[str, int]:
    """The text with its last quarter replaced by as much of ``after``; how much it keeps."""
    k = len(text) // 4
    return text[:len(text) - k] + after[:k], len(text) - k


def edited_fingerprint(p: PrefixHashes, text: str, edited: str, keep: int) -> str:
    """The fingerprint of ``edited`` from the prefix arrays of ``text``, whose first ``keep``
    characters it shares: only spans that reach past them are hashed anew."""
    n = len(edited)
    if n < WINDOW or keep == len(text):
        return fingerprint(edited)
    s = max(0, keep - WINDOW + 1)
    tail = PrefixHashes(codes(edited[s:]))
    low = smallest(np.concatenate([p.windows(0, s), tail.windows()]))
    whole = 0
    for h, t, base, prime in zip(p.sums, tail.sums, BASES, PRIMES):
        shift = int(powers(base, prime, s + 1)[s])
        whole = (whole << 32) | ((int(h[s]) + shift * int(t[-1])) % prime)
    return render(n, whole, low)


# ---- successive documents -------------------------------------------------------------
def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in ranges of the key: ``bucket``, ``key``, ``tie``, ``text`` and ``guest``.

    The first document of each range also goes, as a guest, to the end of the range before
    it (that of the first to the last), so that every document meets its successor in one
    task.  Bounds come from approximate quantiles of the key: one number a range."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    n = 2 * shuffle_partitions(spark)
    bounds = sorted({int(x) for x in rows.stat.approxQuantile("key", [i / n for i in range(1, n)], 0.2 / n)})
    cuts = np.array(bounds, np.int64)

    def place(col) -> np.ndarray:
        k = col.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)  # nulls first
        return np.searchsorted(cuts, k, "right").astype(np.int32)

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[bool, int]] = {}
        for b in batches:
            at = place(b.column(0))
            for i in np.unique(at).tolist():
                own = b.column(0).filter(pa.array(at == i))
                low = (False, 0) if own.null_count else (True, int(own.to_numpy().min()))
                least[i] = min(least.get(i, low), low)
        yield pa.record_batch([pa.array([*least], pa.int32()), pa.array([v if ok else None for ok, v in least.values()], pa.int64())],
                              ["bucket", "key"])

    firsts = (rows.select("key").mapInArrow(lowest, "bucket int, key long").groupBy("bucket")
              .agg(F.min("key").alias("key"), F.max(F.col("key").isNull()).alias("null")).orderBy("bucket").collect())
    used = [r.bucket for r in firsts]
    before = {b: used[i - 1] for i, b in enumerate(used)}
    # a range holds a null key only if it is the first
    first = {r.bucket: None if r.null else r.key for r in firsts}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at = place(b.column(0))
            keys = b.column(0).to_pylist()
            lead = np.array([k == first[i] for k, i in zip(keys, at.tolist())], bool)
            yield pa.record_batch([*b.columns, pa.array(at), pa.array(np.zeros(len(at), np.int8))], ["key", "text", "bucket", "guest"])
            if lead.any():
                own = b.filter(pa.array(lead))
                to = [before[i] for i in at[lead].tolist()]
                yield pa.record_batch([*own.columns, pa.array(to, pa.int32()), pa.array(np.ones(len(to), np.int8))],
                                      ["key", "text", "bucket", "guest"])

    return (rows.mapInArrow(route, "key long, text string, bucket int, guest byte")
            .repartition(shuffle_partitions(spark), "bucket")
            .withColumn("tie", F.xxhash64("text"))
            .sortWithinPartitions("bucket", "guest", F.col("key").asc_nulls_first(), "tie", "text"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_chars``, ``edited`` (the text whose last quarter is replaced by the
    start of the next document's), ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next`` and ``common_prefix`` (of text and edited text, by longest common extension).

    The next document is the next by key (nulls first, equal keys by text), after the last the
    first; a single document is its own next.  Null texts are empty; equal texts have equal
    fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[list] = []

        def prepared(row: dict) -> tuple:
            p = PrefixHashes(codes(row["text"]))
            low = smallest(p.windows()) if p.n >= WINDOW else mix(p.span([0], [p.n]))[:p.n] >> np.uint64(32)
            return row, p, render(p.n, int(p.span(0, p.n)), low)

        def finish(a: tuple, b: tuple) -> list:
            (row, p, fp), (after, _, next_fp) = a, b
            t = row["text"]
            edited, keep = edit_of(t, after["text"])
            edited_fp = edited_fingerprint(p, t, edited, keep)
            tail = PrefixHashes(codes(edited[keep:]))
            return [row["key"], len(t), edited, fp, edited_fp, likeness(fp, edited_fp), likeness(fp, next_fp),
                    keep + p.extension(keep, tail, 0)]

        def ready():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
            names = ["key", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for b in slices(batches, "text", 4 << 20):
            for row in b.to_pylist():
                if held and row["bucket"] != held[0][0]["bucket"]:
                    held = []
                if row["guest"] and not held:
                    continue  # a second guest with the same key
                now = prepared(row)
                if held:
                    out.append(finish(held[0], now))
                held = [] if row["guest"] else [now]
            if out:
                yield ready()
                out = []

    return with_next(docs, key, text).mapInArrow(
        run, "key long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, common_prefix long").withColumnRenamed("key", key)
