"""Exact top-k and WARC archives against plain versions."""

import gzip
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import topk, warc
from shelfcast.llm.common import fresh_folder, make_folder, ship, write_file
from shelfcast.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int"


def plain_topk(rows, every, k):
    v = {}
    for i, e, *_ in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            v[i, tuple(math.floor(256 * float(np.float32(x))) for x in e)] = True
    out = []
    for i, a in v:
        if i % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in v if j != i)
            out += [(i, n + 1, j, -d) for n, (d, j) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("name", ["op6_topk", "op10_warc"])
def test_query_equals_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    cols = ", ".join(sorted(got.columns))
    want = con.execute(f"select {cols} from ({ORACLES[name]})").fetchall()
    order = lambda rows: sorted(rows, key=lambda r: [(x is not None, x) for x in r])
    assert order(tuple(r) for r in got.select(*sorted(got.columns)).collect()) == order(want)


def test_topk_with_ties_hot_vectors_and_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "RING", 4)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    ship(spark)
    rng = random.Random(1)
    hot = [rng.uniform(-1, 1) for _ in range(6)]
    rows = [(i, hot if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(6)], None) for i in range(300)]
    rows += [(1000, None, 1), (1001, [1.0, None, 2.0, 0.0, 0.0, 0.0], 1), (1002, [float("nan")] * 6, 1), (1005, [float("inf")] * 6, 1),
             (None, hot, 1), (1010, [0.0] * 6, 1), (1015, [5.0, -5.0], 1), (1020, [], 1), (0, hot, 2), (7, rows[7][1], 2)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"id": F.lit("x"), "v": F.lit(1), "block": F.lit(2)})
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 5 == 0).collect())
    assert got == plain_topk(rows, 5, 5)


def test_topk_of_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1), (2, [3.0], 1)], VECTORS)
    assert sorted(tuple(r) for r in topk.search(few, F.col("vec_id") % 50 == 0).collect()) == [(0, 1, 2, 256 * 768), (0, 2, 1, 256 * 512)]
    assert topk.search(few.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.search(few.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_products_stay_exact_for_large_components():
    rng = np.random.default_rng(1)
    for top in (1 << 10, 1 << 28, 1 << 40):
        a, b = rng.integers(-top, top, (5, 8)), rng.integers(-top, top, (7, 6))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        want = np.clip(np.array(want, object), -(1 << 63), (1 << 63) - 1).astype(np.int64)
        assert np.array_equal(topk.products(a, b), want)


# ---- WARC -------------------------------------------------------------------------------
PAGES = "page_id long, url string, html string"


def rows_of(spark):
    big, other = "<p>é</p>" * 200, "<b>x</b>" * 300
    return [(1, "http://a/ b\r\nX: y", big), (2, None, big), (3, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"),
            (8, None, other), (None, None, other), (None, "n", "n" * 2000), (None, "m", "n" * 2000), (9, "u", "y" * 999), (10, "u", "y" * 999),
            (11, "u", "z" * 1000), (12, "u", "z" * 1000), (3, "u", big), (20, "long", "<i>" * 2_000_000)]


def test_archive_round_trip(spark):
    ship(spark)
    rows = rows_of(spark)
    pages = spark.createDataFrame(rows, PAGES).withColumns({"key": F.lit("x"), "payload": F.lit("y"), "head": F.lit(0)})
    back = warc.read(spark, warc.archive(warc.with_revisits(pages)))
    got = sorted((warc_key(r.record_id), r.record_type, r.refers_to, r.payload_digest, r.payload_length,
                  None if r.payload is None else hashlib.sha1(r.payload).hexdigest()) for r in back.collect())
    want = []
    for k, _, h in rows:
        b = (h or "").encode()
        heads = [x for x, _, y in rows if (y or "").encode() == b and x is not None] if len(b) >= 1000 else []
        again = bool(heads) and k != max(heads)
        sha = hashlib.sha1(b).hexdigest()
        want.append((str(k) if k is not None else "", "revisit" if again else "response", f"<urn:x-row:{max(heads)}>" if again else None,
                     sha, len(b), None if again else sha))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def warc_key(record_id):
    return record_id.removeprefix("<urn:x-row:").removesuffix(">")


def test_predicates_are_pushed_and_payloads_skipped(spark, monkeypatch):
    ship(spark)
    folder = warc.archive(warc.with_revisits(spark.createDataFrame(rows_of(spark), PAGES)))
    back = warc.read(spark, folder)
    only = back.where("record_type = 'revisit'")
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert only.count() == 4 and "Filter (record_type" not in plan.replace("isnotnull(record_type", "")
    assert back.where("target_uri is null").count() == sum(r[1] is None for r in rows_of(spark))
    assert back.where("record_type <> 'response'").count() == 4
    assert back.where("record_id in ('<urn:x-row:6>', '<urn:x-row:7>')").count() == 2
    assert back.where("target_uri like 'lo%' and payload_length > 10").count() == 1
    assert warc.read(spark, folder, payload=False).where("payload is not null").count() == 0
    # an unwanted record's body is not inflated
    uri = next(u for u in warc.files(folder) if any(h["warc-record-id"].endswith(":20>") for h, _ in warc.records(memoryview(warc.read_range(u)), lambda h: True, False)))
    calls = []
    real = warc.zlib.decompressobj
    class Counting:
        def __init__(self, *a):
            self.z = real(*a)
        def __getattr__(self, n):
            return getattr(self.z, n)
        def decompress(self, *a):
            out = self.z.decompress(*a)
            calls.append(len(out))
            return out
    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    assert list(warc.records(memoryview(warc.read_range(uri)), lambda h: False, True)) == []
    assert max(calls) <= 4096


def test_files_of_other_writers(spark):
    ship(spark)
    def rec(kind, uri, body):
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: {uri}\r\n"
                f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    bodies = [("warcinfo", "i", b"software: x\r\n"), ("resource", "r", b"raw \x00 bytes" * 900), ("resource", "e", b"")]
    folder = fresh_folder(spark, "foreign")
    make_folder(folder)
    write_file(f"{folder}/a.warc", [rec(*b) for b in bodies])
    write_file(f"{folder}/b.warc.gz", [gzip.compress(rec(*b)) for b in bodies])
    got = warc.read(spark, folder)
    assert got.count() == 6 and got.where("record_type = 'resource'").count() == 4
    assert {bytes(r.payload) for r in got.where("target_uri = 'r'").collect()} == {bodies[1][2]}
    write_file(f"{folder}/c.warc", [rec(*bodies[1])[:60]])
    with pytest.raises(Exception, match="truncated"):
        warc.read(spark, folder).count()


def test_no_pages(spark):
    ship(spark)
    empty = spark.createDataFrame([], PAGES)
    assert warc.read(spark, warc.archive(warc.with_revisits(empty))).count() == 0
