"""Token ids as flat binary files with 64-bit document offsets.

``part-N.tok``: the ids of one range of documents, unsigned 16 or 32 bits little-endian by
the vocabulary's size.  ``part-N.off``: signed 64-bit offsets into the whole corpus, one per
document and one end.  ``part-N.doc``: the documents' 64-bit ids, preceded by the number of
rows whose id is null (they sort first).  Partition bases are prefix sums of token counts.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from operator import attrgetter
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import (cut_lineage, fresh_folder, order_bases, read_range,
                                  shuffle_partitions, slices, text_or_empty, write_file)


BEYOND = re.compile("[^\x00-\xff]")


LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), 170, 181, 186, *range(192, 215), *range(216, 247), *range(248, 256)]))
ID = attrgetter("id")
WORD = re.compile(f"([{LETTERS}]+)([{re.escape(punctuation)}]*)").fullmatch  # Latin-1 letters, then ASCII marks


class ChunkEncoder:
    """The library's encoder behind a bounded cache.  White space separates tokens in the
    word vocabulary and never composes with what follows, so texts may be cut at spaces."""

    def __init__(self, path: str, cache_size: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.vocabulary = self.lib.get_vocab_size(with_added_tokens=True)
        ids = lambda t: self.lib.encode(t, add_special_tokens=False).ids
        self.cut = ids(" a\nb ") == ids("a") + ids("b") and not ids(" ")  # drops white space
        letters = "".join(map(chr, [*range(65, 91), *range(192, 215), *range(216, 223)]))
        self.lower = all(ids(c) == ids(c.lower()) for c in letters)  # folds case
        self.letters = self.model_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.known_as = ""  # the type of the ids in it
        self.cache_size = cache_size

    def model_letters(self) -> dict[int, str] | None:
        """How the library writes each letter and mark of ``WORD`` for its model; None unless a
        run of letters and the marks after it reach the model as one piece each."""
        norm, pre = self.lib.normalizer, self.lib.pre_tokenizer
        if not self.cut or norm is None or pre is None:
            return None
        table = {}
        for c in LETTERS + punctuation:
            pieces = pre.pre_tokenize_str(norm.normalize_str(c))
            if len(pieces) != 1:
                return None
            table[ord(c)] = pieces[0][0]
        ids = lambda t: self.lib.encode(t, add_special_tokens=False).ids
        own = lambda t: [x.id for x in self.lib.model.tokenize(t.translate(table))]
        runs = [LETTERS, *(f"{x}{c}{y}" for c in LETTERS for x, y in (("", ""), ("", "a"), ("e", ""), ("n", "t")))]
        marks = [punctuation, punctuation[::-1], *punctuation, *(f"{c}{d}" for c in punctuation for d in "'.*")]
        same = all(ids(r) == own(r) for r in runs) and all(ids(f"a{m}") == own("a") + own(m) for m in marks)
        return table if same else None

    def learn(self, new: list[str], dtype: str) -> None:
        """Encode chunks not met before.  Runs of Latin-1 letters, and ASCII marks after them, go
        to the library's model directly: normalising and splitting them changes no more than
        ``model_letters`` says, and costs more than the model."""
        words, pairs, other = set(), [], new
        if self.letters is not None:
            other = []
            for w in new:
                m = WORD(w)
                if m is None:
                    other.append(w)
                elif m[2]:
                    pairs.append((w, m[1], m[2]))
                    words.update(m.groups())
                else:
                    words.add(w)
        own = [w for w in words if w not in self.known]
        tokenize, letters = self.lib.model.tokenize, self.letters
        for i in range(0, len(own), 4096):
            found = [[*map(ID, tokenize(w.translate(letters)))] for w in own[i:i + 4096]]
            flat = np.fromiter(chain.from_iterable(found), dtype).tobytes()
            cut = [0, *accumulate(len(f) * int(dtype[2]) for f in found)]
            self.known.update(zip(own[i:i + 4096], [flat[s:e] for s, e in zip(cut[:-1], cut[1:])]))
        self.known.update((w, self.known[a] + self.known[b]) for w, a, b in pairs)
        found = self.lib.encode_batch_fast(other, add_special_tokens=False)
        self.known.update((w, np.array(e.ids, dtype).tobytes()) for w, e in zip(other, found))

    def chunks(self, text: str) -> list[str]:
        """The text cut at spaces and line ends; in lower case where that changes nothing."""
        if self.lower and "<" not in text and (text.isascii() or not BEYOND.search(text)):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def encode_batch(self, texts: list[str], dtype: str) -> list[bytes]:
        if not self.cut:
            return [np.array(e.ids, dtype).tobytes()
                    for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        collects = gc.isenabled()
        gc.disable()  # nothing below makes cycles, and each collection would walk every word
        try:
            split = [self.chunks(t) for t in texts]
            if len(self.known) > self.cache_size or self.known_as != dtype:
                self.known, self.known_as = {"": b""}, dtype
            seen: set[str] = set()
            for ws in split:
                seen.update(ws)
            self.learn([w for w in seen if w not in self.known], dtype)
            get = self.known.__getitem__
            return [b"".join(map(get, ws)) for ws in split]
        finally:
            if collects:
                gc.enable()


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def write(docs: DataFrame, path: str, end_id: int, folder: str | None = None,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode the texts with the tokenizer file ``path``, append ``end_id`` to each, and write
    the part files in ascending ``key`` order (nulls first, equal keys by text).

    Returns one row per part: ``part``, ``uri``, ``width`` (bytes an id), ``n_docs``,
    ``n_tokens``, ``base`` (tokens of all parts before).  A null text has the end id alone;
    an empty table gives no part.  The texts cross one range exchange; the driver sees one
    count per part."""
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "tokens")

    def encode_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, dtype = None, b"", "<u4"
        ids: list[np.ndarray] = []
        lengths: list[int] = []
        part, nulls = -1, 0

        def encoded():
            nonlocal enc, end, dtype, part, nulls
            for b in slices(batches, "text", 8 << 20):
                if enc is None:
                    enc = encoder(path)
                    dtype = "<u2" if max(enc.vocabulary - 1, end_id) < 1 << 16 else "<u4"
                    end = np.array([end_id], dtype).tobytes()
                    part = b.column("part")[0].as_py()
                nulls += b.column("key").null_count
                ids.append(pc.fill_null(b.column("key"), 0).to_numpy(zero_copy_only=False))
                for x in enc.encode_batch(b.column("text").to_pylist(), dtype):
                    lengths.append(len(x) // int(dtype[2]) + 1)
                    yield x + end

        first = next(chunks := encoded(), None)
        if first is None:
            return

        def all_chunks():
            yield first
            yield from chunks

        uri = f"{folder}/part-{part:06d}"
        write_file(f"{uri}.tok", all_chunks())
        write_file(f"{uri}.doc", [np.array([nulls], "<i8").tobytes(), np.concatenate(ids).astype("<i8").tobytes()])
        n = np.array(lengths, "<i8")
        write_file(f"{uri}.len", [n.tobytes()])
        yield pa.record_batch([pa.array([v], t) for v, t in (
            (part, pa.int32()), (uri, pa.string()), (int(dtype[2]), pa.int32()),
            (len(n), pa.int64()), (int(n.sum()), pa.int64()))],
            ["part", "uri", "width", "n_docs", "n_tokens"])

    order = [F.col("key").asc_nulls_first(), F.col("tie"), F.col("text")]
    parts = cut_lineage(
        docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
        .repartitionByRange(shuffle_partitions(spark), F.col("key").asc_nulls_first())
        .withColumn("tie", F.xxhash64("text"))
        .sortWithinPartitions(*order).drop("tie")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(encode_part, "part int, uri string, width int, n_docs long, n_tokens long"))
    bases = order_bases([tuple(r) for r in parts.select("part", "n_tokens").collect()])
    based = parts.join(F.broadcast(spark.createDataFrame(list(bases.items()), "part int, base long")), "part")

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, base in zip(b.column("uri").to_pylist(), b.column("base").to_pylist()):
                n = np.asarray(read_range(f"{uri}.len")).view("<i8")
                write_file(f"{uri}.off", [(base + np.concatenate([[0], np.cumsum(n)])).astype("<i8").tobytes()])
            yield b

    done = based.select("part", "uri", "width", "n_docs", "n_tokens", "base")
    return cut_lineage(done.mapInArrow(offsets, done.schema))


class TokenFile:
    """One part, memory-mapped: document ids, global offsets and token ids by position."""

    def __init__(self, uri: str, width: int):
        self.tokens = read_range(f"{uri}.tok").view(f"<u{width}")
        self.offsets = read_range(f"{uri}.off").view("<i8")
        head = read_range(f"{uri}.doc").view("<i8")
        self.nulls, self.keys = int(head[0]), head[1:]

    def __len__(self) -> int:
        return len(self.keys)

    def ids(self, i: int) -> np.ndarray:
        s, e = self.offsets[i:i + 2] - self.offsets[0]
        return self.tokens[s:e]


def read(spark: SparkSession, parts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Read the parts that :func:`write` lists: ``key``, ``start`` (global), ``n_tokens`` and
    ``ids`` (little-endian unsigned 32-bit bytes) per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, width in zip(b.column("uri").to_pylist(), b.column("width").to_pylist()):
                f = TokenFile(uri, width)
                sizes = np.diff(f.offsets)
                step = np.flatnonzero(np.diff(np.cumsum(sizes) // (1 << 20), prepend=-1))
                for s, e in zip(step, [*step[1:], len(f)]):
                    at = range(s, e)
                    yield pa.record_batch([
                        pa.array([int(f.keys[i]) if i >= f.nulls else None for i in at], pa.int64()),
                        pa.array(np.asarray(f.offsets[s:e])), pa.array(sizes[s:e]),
                        pa.array([f.ids(i).astype("<u4").tobytes() for i in at], pa.binary())],
                        ["key", "start", "n_tokens", "ids"])

    n = max(1, min(shuffle_partitions(spark), parts.count()))
    return (parts.select("uri", "width").repartition(n)
            .mapInArrow(run, "key long, start long, n_tokens long, ids binary")
            .withColumnRenamed("key", key))

