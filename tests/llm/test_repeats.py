"""Suffix order and repeat removal against brute force."""

import random

import numpy as np
import pytest

from shelfcast.llm import repeats
from shelfcast.llm import suffix_order as so
from shelfcast.llm.queries import op7_repeats
from tests.llm.conftest import DOCS, words


def plain(rows, length=None):
    """(doc_id, text) -> removed bytes as a boolean array."""
    length = length or repeats.LENGTH
    seen, out = set(), {}
    for k, t in rows:
        b = (t or "").encode()
        mark = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                mark[p] += 1
                mark[p + length] -= 1
            seen.add(w)
        out[k, t] = np.cumsum(mark[:-1]) > 0
    return out


def check(spark, rows):
    df = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], DOCS)
    want = plain(sorted(rows, key=lambda r: (r[0] is not None, r[0])))
    for r in repeats.remove_repeats(df, carry=["text"]).collect():
        gone = want[r.doc_id, r.carry.text]
        raw = np.frombuffer((r.carry.text or "").encode(), np.uint8)
        assert r.n_bytes == len(raw)
        got = np.zeros(len(raw), bool)
        for s in r.spans:
            got[s.start:s.end] = True
        assert np.array_equal(got, gone), r.doc_id
        assert bytes(r.kept) == raw[~gone].tobytes()
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_the_cover_covers_every_difference():
    d, shift = so.cover()
    assert all((i + shift[i, j]) % so.V in d and (j + shift[i, j]) % so.V in d for i in range(so.V) for j in range(so.V))
    assert {(a - b) % so.V for a in d for b in d} == set(range(so.V))


@pytest.mark.parametrize("letters", [1, 2, 3, 200])
def test_blocks_are_in_suffix_order(letters):
    rng = np.random.default_rng(letters)
    for n in (0, 1, 2, 31, 33, 100, 900):
        for text in (rng.integers(1, 1 + letters, n), np.tile(rng.integers(1, 9, 7), n)[:n]):
            text = text.astype(np.uint8)
            b = text.tobytes()
            padded = np.concatenate([text, np.zeros(so.PAD, np.uint8)])
            for bucket in (256, 1 << 19):
                got = [x for block in so.sorted_blocks(padded, np.arange(n), max(n, 1), bucket) for x in block.tolist()]
                assert got == sorted(range(n), key=lambda i: b[i:])


def test_op7_equals_brute_force(spark):
    import hashlib
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    want = {}
    for (k, t), gone in plain(rows).items():
        raw = np.frombuffer((t or "").encode(), np.uint8)
        want[k] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
                   hashlib.sha256(raw[~gone].tobytes()).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op7_repeats(spark, sf).collect()}
    assert got == want


@pytest.mark.parametrize("wide", [512, 1])
def test_overlaps_periods_and_frequent_lines(spark, monkeypatch, wide):
    monkeypatch.setattr(repeats, "WIDE", wide)  # 1: windows of shared anchors are dealt out one by one
    monkeypatch.setattr(repeats, "PIECE", 700)  # long texts in pieces
    rng = random.Random(4)
    line, passage, long = words(rng, 25), words(rng, 70), words(rng, 900)
    rows = [(i, words(rng, rng.randint(0, 20)) + line + words(rng, rng.randint(0, 20))) for i in range(40)]
    rows += [(50, passage), (51, passage), (52, passage[7:]), (53, passage[:-9] + "x"), (54, "é" + passage + "é" + passage)]
    rows += [(60, "ab" * 300), (61, "abc " * 200), (62, "a" * 99), (63, "a" * 100), (64, "a" * 400), (65, "ß" * 120)]
    rows += [(70, long), (71, long[1000:3000] + long[500:1500]), (72, long + long), (80, None), (81, ""), (None, passage + "z")]
    rng.shuffle(rows)
    check(spark, rows)


def test_a_byte_string_one_short_of_the_length_stays(spark):
    rng = random.Random(6)
    s = "".join(rng.choice("abcdefghijklmnop") for _ in range(100))
    check(spark, [(1, "x" + s[:99] + "y"), (2, "z" + s[:99] + "w"), (3, "q" + s), (4, "r" + s + "t")])


def test_awkward_rows(spark, awkward, nothing):
    got = repeats.remove_repeats(awkward, carry=["lang", "tie"])
    assert got.count() == awkward.count()
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(bytes(r.kept).decode("utf-8", "replace"))
    texts = {}
    for r in awkward.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    assert set(by[5]) <= {texts[5][0], next(t for t in texts[5] if t != texts[5][0])} and len(by[5]) == 4  # repeats of a row are one document
    assert by[6] == [""] and by[0] == [""] and by[9] == texts[9]
    clean = repeats.clean(awkward)
    assert clean.columns == awkward.columns and clean.dtypes == awkward.dtypes and clean.count() == awkward.count()
    rows = {r.doc_id: r for r in clean.collect()}
    assert rows[0].text is None and rows[6].text == "" and rows[6].n_chars == 0
    assert repeats.remove_repeats(nothing).count() == 0 and repeats.clean(nothing).count() == 0
