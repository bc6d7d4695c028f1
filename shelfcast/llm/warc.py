"""WARC archives as a Python data source, ``format("warc")``.

Files hold one gzip member a record.  A member's extra field gives its compressed size, so a
reader can inflate the record's headers alone, test the pushed predicates on them, and step
over the rest.  Files of other writers (no such field, or not compressed) are read as well.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, IsNull, Not, StringStartsWith, WriterCommitMessage)

from shelfcast.llm.common import _local, fresh_folder, make_folder, read_range, write_file

# fixed by the format: header names behind the columns
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
LENGTH = "X-Payload-Length"  # of the full payload, which a revisit does not hold
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ("record_type string, record_id string, target_uri string, date string, payload_digest string, "
          "refers_to string, payload_length long, payload binary")
FIELD = b"WL"  # gzip extra subfield: the member's compressed size
ROLL = 64 << 20  # compressed bytes after which a task starts another file


# ---- records -------------------------------------------------------------------------
def record(row: dict, level: int) -> bytes:
    """One record; control characters and spaces in header values are percent-encoded."""
    def clean(v: str) -> bytes:
        return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in v).encode()

    http = row["payload"] is not None
    block = b""
    if http:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                 % len(row["payload"])) + row["payload"]
    lines = [b"WARC/1.1"]
    lines += [name.encode() + b": " + clean(row[c]) for c, name in HEADERS.items() if row.get(c) is not None]
    lines.append(b"%s: %d" % (LENGTH.encode(), row["payload_length"]))
    if row["record_type"] == "revisit":
        lines.append(b"WARC-Profile: " + PROFILE.encode())
    if http:
        lines.append(b"Content-Type: application/http;msgtype=response")
    lines.append(b"Content-Length: %d" % len(block))
    raw = b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(raw) + z.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + FIELD + struct.pack("<H", 8)
    return head + struct.pack("<Q", len(head) + 16 + len(body)) + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def member(buf, at: int) -> tuple[int, int | None]:
    """Start of the deflated data of the gzip member at ``at``, and the member's size if its
    extra field tells."""
    flags, p, size = buf[at + 3], at + 10, None
    if flags & 4:
        end = p + 2 + struct.unpack_from("<H", buf, p)[0]
        p += 2
        while p + 4 <= end:
            n = struct.unpack_from("<H", buf, p + 2)[0]
            if bytes(buf[p:p + 2]) == FIELD and n == 8:
                size = struct.unpack_from("<Q", buf, p + 4)[0]
            p += 4 + n
        p = end
    for bit in (8, 16):  # a name, a comment
        if flags & bit:
            while buf[p]:
                p += 1
            p += 1
    return p + 2 * bool(flags & 2), size


def parse(head: bytes) -> dict[str, str]:
    """Header names (lower case) and values of a record's head."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    pairs = (x.partition(":") for x in lines[1:] if x)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def records(buf, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers and block of the records whose headers pass ``wanted``.  Of the others, and
    without ``payloads`` of all, nothing past the headers is inflated where sizes are known."""
    at, n = 0, len(buf)
    while at < n:
        if buf[at] == 0x1F:
            start, size = member(buf, at)
            z, raw, p = zlib.decompressobj(-15), b"", start
            while (cut := raw.find(b"\r\n\r\n")) < 0:
                if z.eof or p >= n:
                    raise ValueError(f"truncated record at byte {at}")
                raw += z.decompress(z.unconsumed_tail + bytes(buf[p:p + 2048]), 4096)
                p += 2048
            headers = parse(raw[:cut])
            keep = wanted(headers)
            block = raw[cut + 4:] if keep and payloads else None
            if block is not None or size is None:
                parts = [raw[cut + 4:]]
                tail = z.unconsumed_tail
                while not z.eof:
                    if not tail and p >= n:
                        raise ValueError(f"truncated record at byte {at}")
                    more = z.decompress(tail + bytes(buf[p:p + (1 << 16)]))
                    p, tail = p + (1 << 16), b""
                    if block is not None:
                        parts.append(more)
                end = min(p, n) - len(z.unused_data) + 8
                if block is not None:
                    block = b"".join(parts)[:int(headers["content-length"])]
            at = at + size if size is not None else end
        else:
            head = bytes(buf[at:at + 2048])
            while (cut := head.find(b"\r\n\r\n")) < 0:
                if at + len(head) >= n:
                    raise ValueError(f"truncated record at byte {at}")
                head = bytes(buf[at:at + 2 * len(head)])
            headers = parse(head[:cut])
            keep, s = wanted(headers), at + cut + 4
            e = s + int(headers["content-length"])
            block = bytes(buf[s:e]) if keep and payloads else None
            at = e + 4
        if keep:
            yield headers, block


def payload_of(headers: dict[str, str], block: bytes | None) -> bytes | None:
    """What follows the HTTP head of a block; a block of another type is its own payload."""
    if block is None or headers.get("warc-type") == "revisit":
        return None
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


# ---- the data source -------------------------------------------------------------------
@dataclass
class WarcFile(InputPartition):
    uri: str


class WarcReader(DataSourceReader):
    """One partition a file.  Predicates on record type and other header columns are tested
    on the parsed headers; option ``payload=false`` leaves payloads out."""

    def __init__(self, options):
        self.path = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() != "false"
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            inner, no = (f.child, True) if isinstance(f, Not) else (f, False)
            column = inner.attribute[0] if getattr(inner, "attribute", None) and len(inner.attribute) == 1 else None
            if column in HEADERS and isinstance(inner, (EqualTo, In, IsNull, IsNotNull, StringStartsWith)):
                self.tests.append((HEADERS[column].lower(), type(inner).__name__, getattr(inner, "value", None), no))
            else:
                yield f

    def partitions(self):
        return [WarcFile(u) for u in files(self.path)]

    def wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value, no in self.tests:
            got = headers.get(name)
            if kind in ("IsNull", "IsNotNull"):
                ok = (got is None) == (kind == "IsNull")
            elif got is None:
                return False  # a comparison with null is not true, negated or not
            else:
                ok = got == value if kind == "EqualTo" else got in value if kind == "In" else got.startswith(value)
            if ok == no:
                return False
        return True

    def read(self, partition):
        if partition is None:  # no files
            return
        rows, size = [], 0
        for h, block in records(memoryview(read_range(partition.uri)), self.wanted, self.payloads):
            payload = payload_of(h, block)
            n = int(h[LENGTH.lower()]) if LENGTH.lower() in h else None if payload is None else len(payload)
            rows.append([*(h.get(x.lower()) for x in HEADERS.values()), n, payload])
            size += len(payload or b"") + 200
            if size > 4 << 20:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)


def batch(rows: list[list]) -> pa.RecordBatch:
    types = [pa.string()] * len(HEADERS) + [pa.int64(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*HEADERS, "payload_length", "payload"])


@dataclass
class Written(WriterCommitMessage):
    uris: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files named by its partition, through temporary names: a repeated
    attempt replaces them by the same content."""

    def __init__(self, options):
        self.path = options["path"]
        self.level = int(options.get("level", "1"))

    def write(self, iterator):
        from pyspark import TaskContext
        part, uris = TaskContext.get().partitionId(), []
        rows = (r for b in iterator for r in b.to_pylist())
        pending = next(rows, None)

        def some():
            nonlocal pending
            size = 0
            while pending is not None and size < ROLL:
                raw = record(pending, self.level)
                size += len(raw)
                yield raw
                pending = next(rows, None)

        while pending is not None:
            uris.append(f"{self.path}/part-{part:06d}-{len(uris):04d}.warc.gz")
            write_file(uris[-1], some())
        return Written(uris)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def files(folder: str) -> list[str]:
    """The archives in a folder."""
    if (path := _local(folder)) is not None:
        names = sorted(os.listdir(path)) if os.path.isdir(path) else []
    else:
        from pyarrow import fs
        f, p = fs.FileSystem.from_uri(folder)
        names = sorted(x.base_name for x in f.get_file_info(fs.FileSelector(p, allow_not_found=True)))
    return [f"{folder.rstrip('/')}/{x}" for x in names if x.endswith((".warc", ".warc.gz")) and x[0] not in "._"]


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# ---- pages ---------------------------------------------------------------------------------
def with_revisits(pages: DataFrame, least: int = 1000, key: str = "page_id", text: str = "html",
                  url: str = "url", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A record per page: of equal payloads of ``least`` bytes or more, the one with the
    largest ``key`` is a response, the others revisit it; all others are responses.

    A null text is an empty payload; a null key never is the largest unless all are null
    (then all are responses); rows repeated with the largest key are all responses.  Only
    digests that occur twice are joined back, one row each; groups are counted with partial
    sums and a hot digest's rows may be split among tasks."""
    page = (pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("target_uri"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("payload"))
            .withColumn("payload_length", F.octet_length("payload").cast("long"))
            .withColumn("payload_digest", F.sha1("payload")))
    heads = (page.where(F.col("payload_length") >= least)
             .groupBy("payload_digest", "payload_length")
             .agg(F.max("key").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    name = F.concat(F.lit("<urn:x-row:"), F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(">"))
    again = F.col("head").isNotNull() & ~F.col("key").eqNullSafe(F.col("head"))
    return (page.join(heads, ["payload_digest", "payload_length"], "left")
            .select(F.when(again, "revisit").otherwise("response").alias("record_type"),
                    name.alias("record_id"), "target_uri", F.lit(date).alias("date"), "payload_digest",
                    F.when(again, F.concat(F.lit("<urn:x-row:"), F.col("head").cast("string"), F.lit(">"))).alias("refers_to"),
                    "payload_length", F.when(~again, F.col("payload")).alias("payload")))


def archive(rows: DataFrame, folder: str | None = None, level: int = 1) -> str:
    """Write records as WARC files; returns the folder."""
    spark = rows.sparkSession
    register(spark)
    folder = folder or fresh_folder(spark, "warc")
    make_folder(folder)
    rows.write.format("warc").mode("append").option("level", str(level)).save(folder)
    return folder


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def row_key(c: str):
    """The key inside a record id; null if it has none."""
    return F.expr(f"try_cast(nullif(regexp_extract({c}, 'urn:x-row:(-?[0-9]+)>', 1), '') as long)")
