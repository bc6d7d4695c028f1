"""Spelling variant grouping by Bloom-guided neighbourhoods.

Words are counted over whole texts; those that are long and frequent enough form the
vocabulary.  Its words go into blocked Bloom filters, one or more for each word length, built
by grouped bitwise ors.  Filters are broadcast a bounded number of bytes at a time; every word
that could have a neighbour there generates its edits as hashes and probes them.  Only edits that a filter may
hold become strings and meet the vocabulary in an exact join, which removes false positives.

Being near is symmetric: a word that arises from another by an insertion has that other as a
deletion, and of two words that differ in one place either replaces the other's code point.
So deletions, and replacements by larger code points of the vocabulary, find every pair once.

Cases: null and empty texts have no words; a null id counts as an empty one in the edit rule;
repeated rows count as often as they occur; ties of n go to the smaller word in code-point
order; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import cut_lineage, give_back, slices, text_or_empty
from shelfcast.llm.spans import BASE, INVERSE, mix, powers

RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
EVERY = 199        # one in so many (document, run) pairs loses a code point
LEAST_LENGTH = 6   # code points of a word
LEAST_COUNT = 5    # occurrences of a word
RATIO = 5          # a form has so many times its word's occurrences
HELD = 100_000     # distinct words a task counts before it hands them on
BITS = 20          # filter bits per word
PROBES = 6         # bits a word sets in its block of 512
FILTER_BYTES = 32 << 20  # of filters that are broadcast at a time
LONG = 64          # lengths from here on share filters
TABLE = 1 << 19    # edits that are probed at a time


# ---- words ------------------------------------------------------------------------------
def words(key, text: bytes) -> Counter:
    """The words of one text with their occurrences, after the edit rule."""
    out = Counter()
    head = zlib.crc32(b":" if key is None else b"%d:" % key)
    for run, n in Counter(RUN.findall(text.translate(LOWER).decode())).items():
        if len(run) >= LEAST_LENGTH:
            h = zlib.crc32(run.encode(), head)
            if h % EVERY == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
                if len(run) < LEAST_LENGTH:
                    continue
            out[run] += n
    return out


def vocabulary(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``word``, ``n``: the words of LEAST_COUNT occurrences or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()

        def hand_on():
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in slices(batches):
            for k, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                held.update(words(k, t))
            if len(held) > HELD:
                yield hand_on()
                held = Counter()
        if held:
            yield hand_on()

    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# ---- filters ----------------------------------------------------------------------------
def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the words of an Arrow column, and where each word starts."""
    texts = column.to_pylist()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    return points, np.r_[0, np.cumsum(sizes)]


def value(points: np.ndarray) -> np.ndarray:
    return mix((points + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))


def places(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and its PROBES bits in 9-bit fields."""
    h = mix(h)
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), mix(h ^ np.uint64(0xA0761D6478BD642F))


def hashes(points: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of each word's code points (its own powers from 0), one more than code
    points per word, and the words' hashes."""
    size = np.diff(start)
    at = np.arange(len(points)) - np.repeat(start[:-1], size)
    total = np.r_[np.uint64(0), np.cumsum(value(points) * powers(BASE, int(size.max(initial=0)) + 1)[at])]
    return total, total[start[1:]] - total[start[:-1]]


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return (mix(h ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(parts)).astype(np.int64)


def filters(spark, vocab: DataFrame, units: list[tuple[int, int, int, int]]) -> dict:
    """{(shard, part): bits} of ``units`` (shard, part, parts, blocks); a shard is a length."""
    plan = {}
    for shard, part, parts, blocks in units:
        plan.setdefault(shard, (parts, blocks, set()))[2].add(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points, start = code_points(b.column(0))
            _, h = hashes(points, start)
            shard = np.minimum(np.diff(start), LONG)
            for s, (parts, blocks, mine) in plan.items():
                own = h[shard == s]
                p = part_of(own, parts)
                ok = np.isin(p, list(mine))
                block, bits = places(own[ok], blocks)
                p, bit = p[ok], [(bits >> np.uint64(9 * i)) & np.uint64(511) for i in range(PROBES)]
                lanes = np.zeros((8, len(p)), np.uint64)
                for x in bit:
                    lanes[(x >> np.uint64(6)).astype(np.int64), np.arange(len(p))] |= np.uint64(1) << (x & np.uint64(63))
                yield pa.record_batch([pa.array(np.full(len(p), s)), pa.array(p), pa.array(block.astype(np.int64)),
                                       *[pa.array(x.view(np.int64)) for x in lanes]],
                                      ["shard", "part", "block", *[f"m{i}" for i in range(8)]])

    lanes = [f"m{i}" for i in range(8)]
    set_bits = (vocab.select("word").mapInArrow(run, "shard long, part long, block long, " + ", ".join(f"{m} long" for m in lanes))
                .groupBy("shard", "part", "block").agg(*[F.bit_or(m).alias(m) for m in lanes]).toArrow())  # FILTER_BYTES at most
    out = {(s, p): np.zeros((b, 8), np.uint64) for s, p, _, b in units}
    shard, part, block = (set_bits.column(c).to_numpy() for c in ("shard", "part", "block"))
    masks = np.stack([set_bits.column(m).to_numpy().view(np.uint64) for m in lanes], 1) if len(shard) else None
    for (s, p), bits in out.items():
        here = np.flatnonzero((shard == s) & (part == p))
        if len(here):
            bits[block[here]] = masks[here]
    return {"plan": {s: (parts, blocks, mine) for s, (parts, blocks, mine) in plan.items()},
            "bits": {k: v.ravel() for k, v in out.items()}}


def may_hold(bank: dict, shard: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filters of their shards may hold."""
    found = []
    for s, (parts, blocks, mine) in bank["plan"].items():
        at = np.flatnonzero(shard == s)
        part = part_of(h[at], parts) if parts > 1 else np.zeros(len(at), np.int64)
        for p in mine:
            left = at[part == p] if parts > 1 else at
            if not len(left):
                continue
            bits = bank["bits"][s, p]
            block, fields = places(h[left], blocks)
            for i in range(PROBES):
                x = (fields >> np.uint64(9 * i)) & np.uint64(511)
                lane = bits[(block * np.uint64(8) + (x >> np.uint64(6))).astype(np.int64)]
                ok = (lane >> (x & np.uint64(63))) & np.uint64(1) == 1
                left, block, fields = left[ok], block[ok], fields[ok]
            found.append(left)
    return np.concatenate(found) if found else np.empty(0, np.int64)


# ---- neighbourhoods ---------------------------------------------------------------------
def edits(column: pa.Array, alphabet: np.ndarray, bank: dict) -> Iterator[tuple[int, int, int]]:
    """(word's place in the column, position, code point or -1 for a deletion) of the edits that
    the filters may hold."""
    points, start = code_points(column)
    size = np.diff(start)
    if not len(points):
        return
    total, whole = hashes(points, start)
    word = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(points)) - start[word]
    # deletions: of a run of one code point, only its first
    first = np.flatnonzero((at == 0) | (points != np.r_[np.uint64(0), points[:-1]]))
    w = word[first]
    inverse = np.uint64(INVERSE)
    h = total[first] - total[start[w]] + (total[start[w + 1]] - total[first + 1]) * inverse
    for i in may_hold(bank, np.minimum(size[w] - 1, LONG), h).tolist():
        yield int(w[i]), int(at[first[i]]), -1
    # replacements by larger code points
    power = powers(BASE, int(size.max()) + 1)
    values = value(alphabet)
    step = max(1, TABLE // max(1, len(alphabet)))
    shards = np.minimum(size, LONG)
    for s in range(0, len(points), step):
        here = np.arange(s, min(s + step, len(points)))
        r, c = np.nonzero(alphabet[None, :] > points[here][:, None])
        p = here[r]
        h = whole[word[p]] + (values[c] - value(points[p])) * power[at[p]]
        for i in may_hold(bank, shards[word[p]], h).tolist():
            yield int(word[p[i]]), int(at[p[i]]), int(alphabet[c[i]])


def near_words(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: every pair of words one edit apart, both ways round."""
    spark = vocab.sparkSession
    shard = F.least(F.char_length("word"), F.lit(LONG))
    sizes = [tuple(r) for r in vocab.groupBy(shard.alias("s")).count().collect()]  # at most LONG rows

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.empty(0, np.uint64)
        for b in batches:
            seen = np.union1d(seen, code_points(b.column(0))[0])
        yield pa.record_batch([pa.array(seen.astype(np.int64))], ["c"])

    # at most 90 code points
    alphabet = np.array(sorted(r[0] for r in vocab.select("word").mapInArrow(letters, "c long").distinct().collect()), np.uint64)
    rounds, room = [[]], filter_bytes
    for s, words_here in sorted(sizes):
        blocks = -(-words_here * BITS // 512)
        parts = max(1, -(-blocks * 64 // filter_bytes))
        blocks = -(-blocks // parts) + 1
        for part in range(parts):
            if blocks * 64 > room and rounds[-1]:
                rounds.append([])
                room = filter_bytes
            room -= blocks * 64
            rounds[-1].append((s, part, parts, blocks))

    def probe(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "word", 1 << 17):
                held, n, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
                for i, p, c in edits(b.column(0), alphabet, shared.value):
                    t = held[i]
                    out.append((t[:p] + ("" if c < 0 else chr(c)) + t[p + 1:], t, n[i]))
                yield pa.record_batch([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()),
                                       pa.array([x[2] for x in out], pa.int64())], ["edit", "word", "n"])
                give_back()
        return run

    pairs = None
    for units in rounds:
        if not units:
            continue
        lengths = sorted({s for s, *_ in units})
        shared = spark.sparkContext.broadcast(filters(spark, vocab, units))  # at most filter_bytes and one block a unit
        mine = vocab.where(shard.isin(sorted({*lengths, *[s + 1 for s in lengths]})))
        found = mine.select("word", "n").mapInArrow(probe(shared), "edit string, word string, n long")
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        return vocab.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    known = vocab.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    true = cut_lineage(pairs.join(known, "edit"))
    return (true.select("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n"))
            .unionByName(true.select(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"),
                                     F.col("n").alias("near_n"))))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``form`` -> ``word``, ``root``: the last of the forms that follow.  Each step
    doubles the way; n grows with every form, so there is no circle."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        nxt = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = cut_lineage(now.join(nxt, "root", "left")
                          .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        now = now.drop("moved")


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per word of the vocabulary: ``word``, ``n``, ``form``, ``form_n``, ``root``, ``n_near``."""
    vocab = cut_lineage(vocabulary(docs, key, text))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near")))
    near = near_words(vocab, filter_bytes).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.minus") >= RATIO * F.col("n")
    named = cut_lineage(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n")))
    last = roots(named.where("form is not null"))
    return named.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
