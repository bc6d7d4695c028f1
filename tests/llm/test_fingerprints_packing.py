"""Fingerprints and packing against plain versions."""

import hashlib
import itertools
import random

import numpy as np

from shelfcast.llm import fingerprints as fp
from shelfcast.llm import packing
from shelfcast.llm.queries import op4_fingerprints, op8_packing

SF = "/root/testdata/sf0.001"


def test_spans_and_extensions_equal_plain_comparison():
    rng = random.Random(1)
    a = "".join(rng.choice("ab") for _ in range(300))
    b = a[50:120] + "x" + a[130:260]
    p, q = fp.PrefixHashes(fp.codes(a)), fp.PrefixHashes(fp.codes(b))
    for _ in range(3000):
        i, j = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
        n = rng.randrange(30)
        assert p.equal(i, q, j, n) == (i + n <= len(a) and j + n <= len(b) and a[i:i + n] == b[j:j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert p.extension(i, q, j) == k


def test_edited_fingerprint_equals_that_of_the_edited_text():
    rng = random.Random(2)
    for n, m in itertools.product((0, 1, 3, 4, 15, 16, 17, 63, 64, 400), (0, 2, 20, 500)):
        t, u = ("".join(rng.choice("abé ") for _ in range(k)) for k in (n, m))
        edited, keep = fp.edit_of(t, u)
        assert len(edited) == n - n // 4 + min(m, n // 4)
        assert fp.edited_fingerprint(fp.PrefixHashes(fp.codes(t)), t, edited, keep) == fp.fingerprint(edited)


def test_likeness():
    rng = random.Random(3)
    t = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    u = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    f = fp.fingerprint
    assert fp.likeness(f(t), f(t)) == 1 and fp.likeness(f(""), f("")) == 1 and fp.likeness(f(""), f(t)) == 0
    assert fp.likeness(f(t), f(u)) < 0.1
    assert 0.85 < fp.likeness(f(t), f(t[:1500] + "#" + t[1500:])) <= 1
    assert 0.5 < fp.likeness(f(t), f(t[:2250] + u[:750])) < 0.95
    assert len(fp.sketch_of(f("a" * 1000))) == 1  # many repeats


def plain(rows):
    order = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in rows), key=lambda x: x[:2])
    out = {}
    for k, (_, i, t) in enumerate(order):
        edited, _ = fp.edit_of(t, order[(k + 1) % len(order)][2])
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), fp.fingerprint(t), fp.fingerprint(edited))
    return out


def test_op4_equals_a_plain_loop(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in op4_fingerprints(spark, SF).collect()}
    assert got == plain(rows)


def test_fingerprints_of_awkward_rows(spark, awkward, nothing):
    got = fp.fingerprints(awkward).collect()
    assert len(got) == awkward.count()
    by = {}
    for r in awkward.collect():
        by.setdefault(r.doc_id, set()).add(fp.fingerprint(r.text or ""))
    assert all(r.fingerprint in by[r.doc_id] for r in got)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = awkward.where("doc_id = 9")
    r = fp.fingerprints(one).collect()
    t = one.first().text
    assert len(r) == 1 and r[0].edited == fp.edit_of(t, t)[0] and r[0].near_next == 1
    assert fp.fingerprints(nothing).count() == 0


# ---- packing ----------------------------------------------------------------------------
def test_buckets_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        lengths = rng.sample(range(1, 40), rng.randint(1, 8))
        h = {x: rng.randint(1, 9) for x in lengths}
        k = rng.randint(1, 5)
        pad = lambda bounds: sum(n * (min(b for b in bounds if b >= x) - x) for x, n in h.items())
        best = min(pad([*c, max(h)]) for m in range(min(k, len(h))) for c in itertools.combinations(sorted(h)[:-1], m))
        bounds = packing.optimal_buckets(h, k)
        assert bounds == sorted(set(bounds)) and len(bounds) <= k and pad(bounds) == best
    assert packing.optimal_buckets({}, 3) == []


def check_pack(rows, k, budget, max_length, got):
    words = {}
    for r in rows:
        n = len(__import__("re").findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        words.setdefault(r.doc_id, []).append(n)
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append(r)
    for i, ns in words.items():
        assert sum(r.n_tokens for r in per[i]) == sum(ns)
        assert all(r.start == r.piece * max_length and r.n_tokens <= max_length for r in per[i])
    h = {}
    for r in got:
        if r.n_tokens:
            h[r.n_tokens] = h.get(r.n_tokens, 0) + 1
    bounds = packing.optimal_buckets(h, k)
    batches = {}
    for r in got:
        if not r.n_tokens:
            assert r.bucket is None and r.batch is None and r.slot is None
            continue
        assert r.bucket == min(b for b in bounds if b >= r.n_tokens) and r.padding == r.bucket - r.n_tokens
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (b, n), rs in batches.items():
        room = max(1, budget // b)
        last = n == max(m for c, m in batches if c == b)
        assert sorted(r.slot for r in rs) == list(range(len(rs))) and (len(rs) == room or last and len(rs) <= room)
        assert b * len(rs) <= max(budget, b)


def test_op8_packs_every_word(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check_pack(rows, packing.BUCKETS, packing.BUDGET, packing.MAX_LENGTH, op8_packing(spark, SF).collect())


def test_pack_awkward_rows(spark, awkward, nothing):
    got = packing.pack(awkward, k=3, budget=100, max_length=64).collect()
    check_pack(awkward.collect(), 3, 100, 64, got)
    assert packing.pack(nothing).count() == 0
    assert [r.bucket for r in packing.pack(awkward.where("doc_id < 2")).collect()] == [None, None]


def test_order_of_places(spark, awkward):
    got = packing.pack(awkward.where("doc_id > 2"), k=1, budget=10 ** 9, max_length=10 ** 6).orderBy("slot").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids) and np.all(np.diff([r.slot for r in got]) == 1)
