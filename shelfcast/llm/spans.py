"""Vectorised token cutting and hashing over UTF-8 bytes, for use inside tasks."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h = h ^ (h >> np.uint64(27))
    h = h * _M2
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        got = np.empty(size, np.uint64)
        got[0] = 1
        k = 1
        while k < size:
            m = min(k, size - k)
            got[k:k + m] = got[:m] * np.uint64(pow(base, k, 1 << 64))
            k += m
        _powers[base] = got
    return got[:n]


INVERSE = pow(BASE, -1, 1 << 64)
# value of each byte in the hashes: a fixed mix of the byte
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """P with P[e]-P[s] = sum of values[i] * BASE**i over s <= i < e, modulo 2**64."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def span_hashes(p: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the spans [s, e): equal contents give equal hashes wherever they stand."""
    inv = powers(INVERSE, len(p))
    return mix((p[e] - p[s]) * inv[s] + (e - s).astype(np.uint64) * _M2)


def share(h: np.ndarray, parts: int) -> np.ndarray:
    """One of ``parts`` for each hash, even if the hashes are small ones picked among many."""
    return ((mix(h ^ _M2) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def runs(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of equal non-zero ``kind``: starts, ends, kinds."""
    if not len(kind):
        z = np.empty(0, np.int64)
        return z, z, z
    cut = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    ends = np.append(cut[1:], len(kind))
    keep = kind[cut] != 0
    return cut[keep], ends[keep], kind[cut][keep]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (first at 0) of an Arrow string or binary column without nulls."""
    import pyarrow as pa
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if kind == pa.large_binary() else np.int32
    off = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]
