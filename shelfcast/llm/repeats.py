"""Suffix-array dedup: remove every byte of a LENGTH-byte string that occurs earlier.

Candidate search.  A window of LENGTH bytes is represented by its anchor, the leftmost of its
K-byte grams with the smallest hash; equal windows have equal anchors at equal offsets.  The
consecutive windows of one anchor form a run of up to LENGTH - K + 1 windows.  Only runs whose
anchor occurs twice can hold repeats; all others are left out, none by a cap.

Runs of equal bytes are merged into their first occurrence (the later ones are repeats as a
whole).  The suffixes of all distinct runs that share an anchor are then sorted blockwise
with a difference cover, one range of anchors a task; neighbours with LENGTH equal leading
bytes are one string, and all but its first place are removed.  An anchor with very many
distinct runs is not kept together: each of its windows goes by its own hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import cut_lineage, give_back, shuffle_partitions, slices, stored, text_or_empty
from shelfcast.llm.spans import BYTE_VALUE, prefix_sums, share, span_hashes, utf8
from shelfcast.llm.suffix_order import PAD, leading_words, sorted_blocks

LENGTH, K = 100, 40
GRAMS = LENGTH - K + 1
PIECE = 1 << 20  # windows of a text handled at a time
WIDE = 512  # distinct runs of an anchor from which its windows are dealt out one by one
BLOCK_BYTES = 1 << 20  # run bytes sorted at a time: about 200 MB of keys and ranks
FIRST, COPY, SPREAD = 1, 2, 3
NO_KEY = -(1 << 63)  # stands for a null key, which comes first


# ---- runs -----------------------------------------------------------------------------
def runs_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in the rows of ``data`` that start at ``off``: row, first
    window (place in data), number of windows, anchor hash and run hash."""
    n = len(data)
    empty = np.empty(0, np.int64)
    if n < LENGTH:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    p = prefix_sums(BYTE_VALUE[data])
    at = np.arange(n - K + 1)
    gram = span_hashes(p, at, at + K)
    # upper hash bits first, then the place: the leftmost of equal grams
    low = np.uint64((1 << 24) - 1)
    v = (gram & ~low) | at.astype(np.uint64)
    m = -(-len(v) // GRAMS) * GRAMS
    grid = np.concatenate([v, np.full(m - len(v), np.iinfo(np.uint64).max)]).reshape(-1, GRAMS)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - LENGTH + 1
    anchor = (np.minimum(behind[:count], ahead[GRAMS - 1:GRAMS - 1 + count]) & low).astype(np.int64)
    # windows that cross a row's end are none
    size = np.diff(off)
    row = np.repeat(np.arange(len(size)), np.maximum(size - LENGTH + 1, 0))
    start = np.repeat(off[:-1], np.maximum(size - LENGTH + 1, 0))
    if not len(row):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(np.maximum(size - LENGTH + 1, 0))[:-1]])
    window = start + np.arange(len(row)) - first[row]
    own = anchor[window]
    cut = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (row[1:] != row[:-1])]))
    lo = window[cut]
    length = np.diff(np.append(cut, len(own)))
    return row[cut], lo, length, gram[own[cut]], span_hashes(p, lo, lo + length + LENGTH - 1)


def pieces(column) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The texts' bytes in groups: data, row offsets in it, row numbers and places of the rows'
    first bytes in their texts.  Long texts are cut into overlapping pieces, so that each
    window is in one of them."""
    data, off = utf8(column)
    size = np.diff(off)
    i, n = 0, len(size)
    while i < n:
        if size[i] > PIECE + LENGTH - 1:
            for s in range(0, int(size[i]) - LENGTH + 1, PIECE):
                part = data[off[i] + s:min(off[i] + s + PIECE + LENGTH - 1, off[i + 1])]
                yield part, np.array([0, len(part)]), np.array([i]), np.array([s])
            i += 1
            continue
        j = i
        while j < n and off[j + 1] - off[i] <= PIECE + LENGTH - 1:
            j += 1
        yield data[off[i]:off[j]], off[i:j + 1] - off[i], np.arange(i, j), np.zeros(j - i, np.int64)
        i = j


def wide6(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h).astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def from6(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view("<u8")[:, 0]


def marked_runs(rows: DataFrame, parts: int) -> DataFrame:
    """``doc``, ``tie``, ``marks``: runs whose anchor occurs more than once, per document and
    range of anchors, as arrays of (place int64, windows uint8, mark uint8).

    A run is marked COPY if equal bytes occur earlier; else, if its anchor has other runs,
    FIRST, or SPREAD where there are more than WIDE of these.  Each task sends 6 bytes of
    anchor and of run hash, the place and the length for every run."""
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            doc, tie = b.column("doc").to_numpy(), b.column("tie").to_numpy()
            out = []
            for data, off, number, place in pieces(b.column("text")):
                row, lo, length, anchor, run = runs_of(data, off)
                if not len(row):
                    continue
                part = share(anchor, parts)  # anchors are the smallest of many hashes
                by = np.argsort(part, kind="stable")
                cut = np.flatnonzero(np.diff(part[by], prepend=-1))
                where = lo - off[row] + place[row]
                for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(by)]):
                    at = by[s:e]
                    own, local = np.unique(number[row[at]], return_inverse=True)
                    out.append((int(part[at[0]]), wide6(anchor[at]), wide6(run[at]), local.astype("<i4").tobytes(),
                                where[at].astype("<u4").tobytes(), length[at].astype(np.uint8).tobytes(),
                                doc[own].astype("<i8").tobytes(), tie[own].astype("<i8").tobytes()))
            if out:
                kinds = [pa.int32()] + [pa.binary()] * 7
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                      ["part", "anchor", "run", "who", "place", "windows", "docs", "ties"])

    def gather(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts_, base = [[] for _ in range(7)], 0
        for b in batches:
            for a, r, w, p, n, d, t in zip(*(b.column(c).to_pylist() for c in ("anchor", "run", "who", "place", "windows", "docs", "ties"))):
                d = np.frombuffer(d, "<i8")
                got = (from6(a), from6(r), np.frombuffer(w, "<i4") + base, np.frombuffer(p, "<u4").astype(np.int64), np.frombuffer(n, np.uint8), d, np.frombuffer(t, "<i8"))
                for x, y in zip(parts_, got):
                    x.append(y)
                base += len(d)
        anchor, run, who, place, windows, docs, ties = map(np.concatenate, parts_)
        by = np.argsort(anchor)
        again = np.zeros(len(by), bool)
        again[1:] = anchor[by[1:]] == anchor[by[:-1]]
        again[:-1] |= again[1:].copy()
        by = by[again]
        anchor, run, place, windows, doc, tie = anchor[by], run[by], place[by], windows[by], docs[who[by]], ties[who[by]]
        by = np.lexsort((place, tie, doc, run, anchor))
        anchor, run, place, windows, doc, tie = (x[by] for x in (anchor, run, place, windows, doc, tie))
        differ = lambda *xs: np.concatenate([[True], np.any([x[1:] != x[:-1] for x in xs], axis=0)])
        if not len(anchor):
            return
        once = differ(anchor, run, doc, tie, place)  # rows repeated as a whole
        anchor, run, place, windows, doc, tie = (x[once] for x in (anchor, run, place, windows, doc, tie))
        new_run, new_anchor = differ(anchor, run), differ(anchor)
        first = np.flatnonzero(new_anchor)
        size = np.diff(np.append(first, len(anchor)))
        distinct = np.repeat(np.add.reduceat(new_run.astype(np.int64), first), size)
        mark = np.where(~new_run, COPY, np.where(distinct > WIDE, SPREAD, np.where(distinct > 1, FIRST, 0))).astype(np.uint8)
        keep = mark > 0
        place, windows, doc, tie, mark = (x[keep] for x in (place, windows, doc, tie, mark))
        by = np.lexsort((place, tie, doc))
        place, windows, doc, tie, mark = (x[by] for x in (place, windows, doc, tie, mark))
        if not len(doc):
            return
        cut = np.flatnonzero(differ(doc, tie))
        for g in range(0, len(cut), 4096):
            own = cut[g:g + 4096]
            ends = np.append(cut[g + 1:g + 4096], cut[g + 4096] if g + 4096 < len(cut) else len(doc))
            blobs = [pack(place[s:e], windows[s:e], mark[s:e]) for s, e in zip(own, ends)]
            yield pa.record_batch([pa.array(doc[own]), pa.array(tie[own]), pa.array(blobs, pa.binary())], ["doc", "tie", "marks"])

    return (rows.select("doc", "tie", "text")
            .mapInArrow(scatter, "part int, anchor binary, run binary, who binary, place binary, windows binary, docs binary, ties binary")
            .repartition(parts, "part").groupBy("part").applyInArrow(gather, "doc long, tie long, marks binary"))


MARK = np.dtype([("place", "<i8"), ("windows", "u1"), ("mark", "u1")])


def pack(place, windows, mark) -> bytes:
    out = np.empty(len(place), MARK)
    out["place"], out["windows"], out["mark"] = place, windows, mark
    return out.tobytes()


def marks_of(blobs: list[bytes] | None) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(blobs or []), MARK), order="place")


# ---- sorting ------------------------------------------------------------------------------
def repeated_windows(work: DataFrame, parts: int) -> DataFrame:
    """``doc``, ``tie``, ``ranges`` (int64 pairs of bytes): what the sorted suffixes of FIRST and
    SPREAD runs show to occur earlier."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            groups: dict[int, list[tuple]] = {}
            for doc, tie, text, blobs in zip(*(b.column(c).to_pylist() for c in ("doc", "tie", "text", "marks"))):
                m = marks_of(blobs)
                m = m[(m["mark"] == FIRST) | (m["mark"] == SPREAD)]
                if not len(m):
                    continue
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                p = prefix_sums(BYTE_VALUE[data])
                # a FIRST run goes by its anchor, a SPREAD run's windows by their own hashes
                for place, windows, mark in m.tolist():
                    e = place + windows + LENGTH - 1
                    if mark == FIRST:
                        at = np.arange(place, place + GRAMS)
                        h = span_hashes(p, at, at + K)
                        part = int(share(h[[int(np.argmin(h >> np.uint64(24)))]], parts)[0])
                        groups.setdefault(part, []).append((doc, tie, place, raw[place:e]))
                    else:
                        at = np.arange(place, place + windows)
                        for i, part in zip(at.tolist(), share(span_hashes(p, at, at + LENGTH), parts).tolist()):
                            groups.setdefault(part, []).append((doc, tie, i, raw[i:i + LENGTH]))
            rows = []
            for part, own in groups.items():
                kept, late = split_repeats(own)
                rows.append((part, *columns(kept), b"".join(x[3] for x in kept)))
                if late:  # decided here; -1 - part keeps such rows apart from the suffixes
                    rows.append((-1 - part, *columns(late), b""))
            if rows:
                kinds = [pa.int32()] + [pa.binary()] * 5
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "doc", "tie", "place", "size", "runs"])

    return work.select("doc", "tie", "text", "marks").mapInArrow(
        emit, "part int, doc binary, tie binary, place binary, size binary, runs binary")


def columns(own: list[tuple]) -> list[bytes]:
    doc, tie, place, raw = zip(*own)
    return [np.array(x, "<i8").tobytes() for x in (doc, tie, place, [len(r) for r in raw])]


def split_repeats(own: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Runs (document, tie, place, bytes): the first of equal bytes, and all others."""
    least: dict[bytes, tuple] = {}
    for x in own:
        if x[3] not in least or x[:3] < least[x[3]][:3]:
            least[x[3]] = x
    return [*least.values()], [x for x in own if x[:3] != least[x[3]][:3]]


def earlier_windows(blocks: DataFrame, parts: int) -> DataFrame:
    def sort(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[] for _ in range(5)]
        for b in batches:
            for x, y in zip(got, ("doc", "tie", "place", "size", "runs")):
                x += b.column(y).to_pylist()
        doc, tie, place, size = (np.frombuffer(b"".join(x), "<i8") for x in got[:4])
        if key[0].as_py() < 0:  # decided before
            yield from ranges(doc, tie, place, place + size)
            return
        raw = np.frombuffer(b"".join(got[4]), np.uint8)
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        # runs lie in the order of their places in the corpus, so the least place comes first
        by = np.lexsort((place, tie, doc))
        doc, tie, place, size, begin = doc[by], tie[by], place[by], size[by], begin[by]
        once = np.concatenate([[True], (place[1:] != place[:-1]) | (tie[1:] != tie[:-1]) | (doc[1:] != doc[:-1])])
        doc, tie, place, size, begin = doc[once], tie[once], place[once], size[once], begin[once]  # repeated rows
        start = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(begin - start[:-1], size) + np.arange(start[-1])
        text = np.concatenate([raw[take], np.zeros(PAD + LENGTH, np.uint8)])
        windows = size - LENGTH + 1
        owner = np.repeat(np.arange(len(size)), windows)
        places = start[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        words = leading_words(text)
        late = []
        for order in sorted_blocks(text, places, LENGTH + GRAMS):
            same = np.ones(len(order) - 1, bool)
            for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):
                same &= words[order[1:] + k] == words[order[:-1] + k]
                if not same.any():
                    break
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            least = np.repeat(np.minimum.reduceat(order, first), np.diff(np.append(first, len(order))))
            late.append(order[order != least])
        late = np.sort(np.concatenate(late))
        run = np.searchsorted(start, late, "right") - 1
        at = place[run] + late - start[run]
        del text, words, places, owner, take, raw, order
        give_back()
        yield from ranges(doc[run], tie[run], at, at + LENGTH)

    return blocks.groupBy("part").applyInArrow(sort, "doc long, tie long, ranges binary")


def ranges(doc, tie, s, e) -> Iterator[pa.RecordBatch]:
    """One row a document: its byte ranges, united."""
    if not len(doc):
        return
    by = np.lexsort((s, tie, doc))
    doc, tie, s, e = doc[by], tie[by], s[by], e[by]
    cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]))
    blobs = [united(s[i:j], e[i:j]).astype("<i8").tobytes() for i, j in zip(cut, [*cut[1:], len(doc)])]
    for g in range(0, len(cut), 4096):
        own = cut[g:g + 4096]
        yield pa.record_batch([pa.array(doc[own]), pa.array(tie[own]), pa.array(blobs[g:g + 4096], pa.binary())], ["doc", "tie", "ranges"])


def united(s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Rows (start, end) of the union of ranges; touching ranges join."""
    if not len(s):
        return np.empty((0, 2), np.int64)
    by = np.argsort(s, kind="stable")
    s, e = s[by], np.maximum.accumulate(e[by])
    cut = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
    return np.stack([s[cut], e[np.append(cut[1:], len(s)) - 1]], axis=1)


# ---- the operator -----------------------------------------------------------------------
def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: ``key``, ``n_bytes``, ``spans`` (start, end of each maximal removed run of bytes),
    ``kept`` (the remaining bytes) and ``carry`` (struct of other columns, if asked for).

    A byte goes if a LENGTH-byte string that covers it also starts earlier: in a document with
    a smaller key, or in the same at a smaller place; judged on the input.  Null keys come
    first, rows with equal keys in the order of their texts' hashes; rows repeated as a whole
    are one document, and each returns its result.  Null and empty texts, and texts shorter
    than LENGTH, keep all."""
    spark = docs.sparkSession
    parts = max(shuffle_partitions(spark), 1)
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("int")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc"),
                       text_or_empty(text).alias("text"), rest.alias("carry")).withColumn("tie", F.xxhash64("text"))
    marks = (cut_lineage(marked_runs(rows, parts)).groupBy("doc", "tie")
             .agg(F.collect_list("marks").alias("marks")))  # one document's runs
    work = stored(rows.join(marks, ["doc", "tie"], "left"))
    blocks = max(1, -(-marked_totals(work) // BLOCK_BYTES))  # by their bytes alone: a document gives a row per block
    shown = repeated_windows(work.where("marks is not null"), blocks).repartition(parts, "part")
    late = cut_lineage(earlier_windows(shown, blocks))
    late = late.groupBy("doc", "tie").agg(F.collect_list("ranges").alias("ranges"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches, "text"):
            spans, kept, sizes = [], [], []
            for t, blobs, found in zip(*(b.column(c).to_pylist() for c in ("text", "marks", "ranges"))):
                raw = t.encode()
                m = marks_of(blobs)
                m = m[m["mark"] == COPY]
                more = np.frombuffer(b"".join(found or []), "<i8").reshape(-1, 2)
                gone = united(np.concatenate([m["place"], more[:, 0]]),
                              np.concatenate([m["place"] + m["windows"].astype(np.int64) + LENGTH - 1, more[:, 1]]))
                at, out = 0, []
                for s, e in gone.tolist():
                    out.append(raw[at:s])
                    at = e
                out.append(raw[at:])
                sizes.append(len(raw))
                kept.append(b"".join(out))
                spans.append([{"start": s, "end": e} for s, e in gone.tolist()])
            yield pa.record_batch([b.column("key"), pa.array(sizes, pa.int64()), pa.array(spans, kind),
                                   pa.array(kept, pa.binary()), b.column("carry")], ["key", "n_bytes", "spans", "kept", "carry"])

    touched = work.where("marks is not null").join(late, ["doc", "tie"], "left").select("key", "text", "marks", "ranges", "carry")
    clean = work.where("marks is null").select("key", "text", "marks", F.lit(None).cast("array<binary>").alias("ranges"), "carry")
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType()), T.StructField("carry", work.schema["carry"].dataType)])
    out = touched.unionByName(clean).mapInArrow(finish, schema)
    return out.withColumnRenamed("key", key)


def marked_totals(work: DataFrame) -> int:
    """About how many bytes of runs the sort will see."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            for blobs in b.column(0).to_pylist():
                m = marks_of(blobs)
                w = m["windows"].astype(np.int64)
                total += int((w[m["mark"] == FIRST] + LENGTH).sum() + w[m["mark"] == SPREAD].sum() * LENGTH)
        yield pa.record_batch([pa.array([total], pa.int64())], ["bytes"])

    got = work.where("marks is not null").select("marks").mapInArrow(count, "bytes long").agg(F.sum("bytes")).first()[0]
    return got or 0


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` and ``length`` set to the new number of
    code points where it changed.  Code points cut in two go as a whole.  No row is dropped,
    null texts stay null, other columns are as they are."""
    others = [c for c in docs.columns if c != text]
    flagged = docs.withColumn("_null", F.col(f"`{text}`").isNull())
    found = remove_repeats(flagged, key, text, [*others, "_null"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "kept"):
            texts = [x.decode("utf-8", "ignore") for x in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(texts, pa.string()), b.column(1), b.column(2)], ["kept", "changed", "carry"])

    kind = found.schema["carry"].dataType
    schema = T.StructType([T.StructField("kept", T.StringType()), T.StructField("changed", T.BooleanType()), T.StructField("carry", kind)])
    rows = found.select("kept", (F.size("spans") > 0).alias("changed"), "carry").mapInArrow(decode, schema)
    new = F.when(~F.col("carry._null"), F.col("kept"))

    def column(c: str):
        if c == text:
            return new.alias(c)
        old = F.col(f"carry.`{c}`")
        if c == length:
            kind = docs.schema[c].dataType
            return F.when(F.col("changed"), F.length("kept").cast(kind)).otherwise(old).alias(c)
        return old.alias(c)

    return rows.select(*[column(c) for c in docs.columns])
