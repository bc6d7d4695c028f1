"""Helpers shared by the operators: shared files, global numbering, batch slicing."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.common import numbered
from shelfcast.session import cut_lineage, scratch_path

__all__ = ["cut_lineage", "documents", "fresh_folder", "give_back", "order_bases", "stored", "ship", "shuffle_partitions",
           "slices", "read_range", "write_file", "make_folder", "numbered",
           "text_or_empty"]


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers, once per application, so that tasks
    can import it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_shelfcast_shipped", False):
        return
    import zipfile
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(sc._temp_dir, "shelfcast.zip")  # the driver's own Spark folder
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._shelfcast_shipped = True


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Like ``cut_lineage``, for wide text tables: written with a denser codec."""
    return cut_lineage(df, codec)


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """A new folder URI below the shared checkpoint folder."""
    return scratch_path(spark, f"files/{tag}")


# ---- files of our own formats, by URI, from tasks ---------------------------------
def _local(uri: str) -> str | None:
    p = urlparse(uri)
    return unquote(p.path) if p.scheme in ("", "file") else None


def make_folder(uri: str) -> None:
    path = _local(uri)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        return
    from pyarrow import fs
    f, p = fs.FileSystem.from_uri(uri)
    f.create_dir(p, recursive=True)


def write_file(uri: str, chunks) -> int:
    """Write the byte chunks to ``uri`` through a temporary name; a repeated task attempt
    replaces the file by one with the same content.  Returns the bytes written."""
    path, n = _local(uri), 0
    tmp = f".{uuid.uuid4().hex}.tmp"
    if path is not None:
        head, tail = os.path.split(path)
        os.makedirs(head, exist_ok=True)
        with open(f"{head}/{tmp}", "wb") as out:
            for c in chunks:
                n += out.write(c)
        os.replace(f"{head}/{tmp}", path)
        return n
    from pyarrow import fs
    f, p = fs.FileSystem.from_uri(uri)
    head, _, tail = p.rpartition("/")
    with f.open_output_stream(f"{head}/{tmp}") as out:
        for c in chunks:
            out.write(c)
            n += len(c)
    f.move(f"{head}/{tmp}", p)
    return n


def read_range(uri: str):
    """A read-only buffer over the file: memory-mapped where the folder is mounted, else
    read through the file system of its URI."""
    path = _local(uri)
    if path is not None:
        return np.memmap(path, dtype=np.uint8, mode="r") if os.path.getsize(path) else np.empty(0, np.uint8)
    from pyarrow import fs
    f, p = fs.FileSystem.from_uri(uri)
    with f.open_input_file(p) as src:
        return np.frombuffer(src.read(), np.uint8)


# ---- batches ------------------------------------------------------------------------
def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a task, and what the
    allocators keep would add to the next tasks' needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``max_bytes`` of ``column`` (one row
    at least): bounds a task's Python memory by the longest text, not by the batch."""
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(b.schema.get_field_index(column))
        width = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        cut = np.cumsum(width, dtype=np.int64) // max_bytes
        starts = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
        for i, s in enumerate(starts):
            e = starts[i + 1] if i + 1 < len(starts) else b.num_rows
            yield b.slice(s, e - s)
        del b, col, width, cut, starts
        give_back()


# ---- global numbering by prefix sums ------------------------------------------------
def order_bases(counts: list[tuple[int, int]]) -> dict[int, int]:
    """Exclusive prefix sums of (partition, size) pairs: partition -> base."""
    out, total = {}, 0
    for part, n in sorted(counts):
        out[part] = total
        total += n
    return out
