"""Spelling variants against comparing all words with each other."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import variants


def count_words(docs):
    out = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(docs):
    n = count_words(docs)
    by = {}
    for w in n:
        by.setdefault(len(w), []).append(w)
    close = {w: [x for k in (-1, 0, 1) for x in by.get(len(w) + k, []) if near(w, x)] for w in n}
    form = {}
    for w, xs in close.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n.get(form[w])))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def spelled():
    """Words with chains of rarer variants, long ones, repeated letters, accents and ties."""
    rng = random.Random(8)
    base = ["".join(rng.choice("aabeéÀ") for _ in range(rng.randint(6, 8))) for _ in range(60)]
    base += ["qx" * 200, "qx" * 200 + "q", "qx" * 199 + "qy", "aaaaaaaa", "aaaaaaa", "z" * 63, "z" * 64, "z" * 65]
    rows = []
    for w in base:
        for times in (130, 26, 5):
            rows += [w] * rng.choice([times, 5])
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice(["", "b", w[i] + "é"]) + w[i + 1:]
    rng.shuffle(rows)
    return [(None if i % 50 == 7 else i % 40, " ".join(rows[i:i + 9]).upper() if i % 4 else "-".join(rows[i:i + 9]))
            for i in range(0, len(rows), 9)] + [(1, None), (2, ""), (3, " . ")]


@pytest.mark.parametrize("filter_bytes", [variants.FILTER_BYTES, 128])
def test_equals_comparing_all_words(spark, awkward, monkeypatch, filter_bytes):
    monkeypatch.setattr(variants, "TABLE", 256)
    monkeypatch.setattr(variants, "HELD", 10)
    docs = spelled()
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    table = table.withColumns({c: F.lit("x") for c in ("word", "n", "near", "root", "edit")})
    found = got(variants.group(table, filter_bytes=filter_bytes))
    assert found == plain(docs)
    assert sum(r[1] is not None for r in found) > 20 and any(r[2] not in (r[0], r[1]) for r in found)


def test_awkward_and_empty(awkward, nothing):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert got(variants.group(awkward)) == plain(docs)
    assert variants.group(nothing).count() == 0


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = got(variants.group(df))
    assert found == plain([(r.doc_id, r.text) for r in df.collect()]) and len(found) > 500
