"""Byte-level BPE by a pair occurrence index.

The new words of a partition's slice are laid out in one symbol array.  An index maps each
merge rank to all positions where its pair stands; ranks become active when a position is
listed, are taken in ascending order from a heap, and each merge updates the lists of the
neighbouring pairs it changes.  All occurrences of a rank merge in one vectorised step.
Chunks of words seen before come from a bounded cache.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import slices, text_or_empty

NONE = np.iinfo(np.int32).max

# fixed by the vocabulary's format: the split before the merges
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+"
                   r"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
# a space before more white space or the end
LOOSE = re.compile(r" (?:\s|\Z)")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where it is a visible Latin-1 character,
    else the next code point from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairIndexBPE:
    """Encoder and decoder for a byte-level BPE vocabulary file."""

    def __init__(self, path: str, cache_size: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.token_bytes = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        size = max(self.token_bytes) + 1
        self.byte_id = np.zeros(256, np.int32)
        for c, b in back.items():
            self.byte_id[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = np.array([[vocab[a], vocab[b]] for a, b in merges], np.int64).reshape(-1, 2)
        self.size = size
        keys = pairs[:, 0] * size + pairs[:, 1]
        self.order = np.argsort(keys).astype(np.int32)
        self.keys = np.append(keys[self.order], np.iinfo(np.int64).max)
        self.left, self.right = pairs[:, 0], pairs[:, 1]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.text_of = [self.token_bytes.get(i, b"") for i in range(size)]
        self.digits_of = [str(i) for i in range(size)]
        self.cuts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}  # chunk of pre-tokens -> ids
        self.cache_size = cache_size

    # -- splitting
    @staticmethod
    def _split(text: str) -> list[str]:
        return ASCII.findall(text) if text.isascii() else PATTERN.findall(text)

    # -- merging
    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.keys, key)
        found = self.keys[at] == key
        return np.where(found, self.order[np.minimum(at, len(self.order) - 1)], NONE)

    def merge(self, words: list[str], counts: np.ndarray) -> list[bytes]:
        """Token ids, as little-endian uint32 bytes, of groups of ``counts`` words each."""
        if not len(counts):
            return []
        text = "".join(words)
        data = np.frombuffer(text.encode(), np.uint8)
        width = np.fromiter(map(len, words), np.int64, len(words))
        if len(data) != len(text):
            width = np.fromiter((len(w.encode()) for w in words), np.int64, len(words))
        ends = np.cumsum(width)
        ids, alive = self._merge(self.byte_id[data], ends, len(data))
        before = np.concatenate([[0], np.cumsum(alive)])
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        cuts = (4 * before[cuts]).tolist()
        flat = ids[alive].astype("<u4").tobytes()
        return [flat[s:e] for s, e in zip(cuts[:-1], cuts[1:])]

    def _merge(self, ids: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Apply the merges to the symbols ``ids`` of words that end at ``ends``; returns the
        symbols and which of their places are left."""
        nxt = np.arange(1, n + 2, dtype=np.int32)  # n: no neighbour
        prv = np.arange(-1, n, dtype=np.int32)
        nxt[ends[ends > 0] - 1] = n
        prv[ends] = n
        prv[0] = nxt[n] = prv[n] = n
        alive = np.ones(n, bool)
        merged = np.zeros(n + 1, bool)
        merged[n] = True  # no neighbour, never touched
        rank = np.full(n + 1, NONE, np.int32)
        has = np.flatnonzero(nxt[:n] < n)
        rank[has] = self.rank_of(ids[has], ids[nxt[has]])
        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enlist(pos: np.ndarray) -> None:
            r = rank[pos]
            pos, r = pos[r != NONE], r[r != NONE]
            if not len(pos):
                return
            by = np.argsort(r, kind="stable")
            pos, r = pos[by], r[by]
            cut = np.flatnonzero(r[1:] != r[:-1]) + 1
            at = [0, *cut.tolist(), len(r)]
            for i, key in enumerate(r[at[:-1]].tolist()):
                got = lists.get(key)
                if got is None:
                    lists[key] = [pos[at[i]:at[i + 1]]]
                    heapq.heappush(heap, key)
                else:
                    got.append(pos[at[i]:at[i + 1]])

        enlist(has)
        while heap:
            r = heapq.heappop(heap)
            parts = lists.pop(r)
            pos = parts[0] if len(parts) == 1 else np.concatenate(parts)
            pos = pos[rank[pos] == r]
            if not len(pos):
                continue
            if self.left[r] == self.right[r] and len(pos) > 1:
                pos = np.unique(pos)
                # in a run of one symbol every second pair merges, from the left
                new_run = np.concatenate([[True], nxt[pos[:-1]] != pos[1:]])
                first = np.flatnonzero(new_run)
                place = np.arange(len(pos)) - first[np.cumsum(new_run) - 1]
                pos = pos[place % 2 == 0]
            gone = nxt[pos]
            after = nxt[gone]
            ids[pos] = self.made[r]
            alive[gone] = False
            rank[gone] = NONE
            nxt[pos] = after
            prv[after] = pos
            nxt[n] = prv[n] = n
            before = prv[pos]
            merged[pos] = True
            touched = np.concatenate([pos, before[~merged[before]]])
            merged[pos] = False
            rank[touched] = NONE
            touched = touched[nxt[touched] < n]
            rank[touched] = self.rank_of(ids[touched], ids[nxt[touched]])
            enlist(touched)
        return ids, alive

    # -- whole texts
    def chunks(self, text: str) -> list[str]:
        """Cut before each single space that a visible character follows: no pre-token
        crosses such a place, so chunks encode apart.  Texts with longer white space after
        a space are one chunk."""
        if LOOSE.search(text):
            return [text]
        head, *rest = text.split(" ")
        return [head, *[" " + c for c in rest]]

    def learn(self, new: list[str]) -> None:
        """Encode chunks not met before, all in one index, and keep their ids."""
        odd = [c for c in new if c[:1] != " " or LOOSE.search(c)]
        if self.special:
            marked = re.compile("|".join(map(re.escape, self.special)))
            odd += [c for c in new if marked.search(c)]
        odd = list(dict.fromkeys(odd))
        apart = set(odd)
        groups: list[str] = []
        words: list[str] = []
        counts = [np.empty(0, np.int64)]
        for pattern, own in ((ASCII, [c for c in new if c.isascii() and c not in apart]),
                             (PATTERN, [c for c in new if not c.isascii() and c not in apart])):
            got = pattern.findall("".join(own))
            places = np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))
            ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)))
            counts.append(np.diff(np.searchsorted(places, ends, "right"), prepend=0))
            groups += own
            words += got
        pieces: list[tuple[str, int]] = []  # of odd chunks: special ids and plain groups
        for c in odd:
            parts = self.cuts.split(c) if self.cuts is not None else [c]
            for part in parts:
                if part in self.special:
                    pieces.append((c, self.special[part]))
                elif part:
                    own = self._split(part)
                    words += own
                    counts.append(np.array([len(own)]))
                    pieces.append((c, -1))
        done = self.merge(words, np.concatenate(counts))
        self.known.update(zip(groups, done))
        self.known.update(dict.fromkeys(odd, b""))
        rest = iter(done[len(groups):])
        for c, special in pieces:
            self.known[c] += next(rest) if special < 0 else np.array([special], "<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian uint32 bytes."""
        split = [self.chunks(t) for t in texts]
        if len(self.known) > self.cache_size:
            self.known.clear()
        seen: set[str] = set()
        for cs in split:
            seen.update(cs)
        self.learn([c for c in seen if c not in self.known])
        get = self.known.__getitem__
        return [b"".join(map(get, cs)) for cs in split]

    def decode(self, ids) -> str:
        """Text of the ids, special tokens kept; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(path: str) -> PairIndexBPE:
    """One coder per Python worker and vocabulary file."""
    return PairIndexBPE(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (token ids as little-endian uint32 bytes) of each whole text.

    A null text is empty and gives no ids; repeated rows give repeated rows; other columns
    are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for b in slices(batches, max_bytes=6 << 20):
            out = bpe.encode_batch(b.column(1).to_pylist())
            yield pa.record_batch([b.column(0), pa.array(out, pa.binary())], ["key", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "key long, ids binary").withColumnRenamed("key", key)


def decode(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``text`` decoded from the ``ids`` bytes; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for b in slices(batches, "ids"):
            texts = [bpe.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], ["key", "text"])

    return (rows.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
            .mapInArrow(run, "key long, text string").withColumnRenamed("key", key))


def with_ids_and_text(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` (decimal, comma-joined) and ``decoded``: both directions in
    one pass over the texts, so ids need not leave the worker between them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        digits = bpe.digits_of.__getitem__
        for b in slices(batches, max_bytes=6 << 20):
            ids = [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_batch(b.column(1).to_pylist())]
            yield pa.record_batch(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([",".join(map(digits, x)) for x in ids], pa.string()),
                 pa.array([bpe.decode(x) for x in ids], pa.string())],
                ["key", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    return (rows.mapInArrow(run, "key long, n_tokens long, ids string, decoded string")
            .withColumnRenamed("key", key))
