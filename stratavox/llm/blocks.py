"""Array helpers shared by the text operators: Arrow string columns as byte buffers, rolling hashes, Spark-equal hashes.

Everything works on whole columns of a batch; nothing here loops over characters in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_pow = {"n": 0, "f": np.ones(1, U64), "b": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse modulo 2**64."""
    if _pow["n"] < n:
        n = max(n, 1 << 16)
        for key, base in (("f", _BASE), ("b", _INV)):
            x = np.full(n + 1, base, U64)
            x[0] = 1
            _pow[key] = np.cumprod(x, dtype=U64)
        _pow["n"] = n
    return _pow["f"], _pow["b"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place)."""
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of integer symbols; ``span_hash`` turns two entries into the hash of a span."""
    f, _ = powers(len(data) + 1)
    out = np.empty(len(data) + 1, U64)
    out[0] = 0
    x = data.astype(U64)
    x += U64(1)
    x *= f[: len(data)]
    np.cumsum(x, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, stop), equal for equal contents wherever they stand."""
    _, b = powers(len(prefix))
    h = prefix[stop]
    h -= prefix[start]
    h *= b[start]
    h += (np.asarray(stop) - np.asarray(start)).astype(U64) * U64(0xA24BAED4963EE407)
    return mix(h)


def gram_hash(prefix: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-symbol grams."""
    n = len(prefix) - k
    _, b = powers(len(prefix))
    h = prefix[k:] - prefix[:n]
    h *= b[:n]
    return mix(h)


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if off is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def doc_groups(offsets: np.ndarray, most: int):
    """Index ranges [i, j) of consecutive texts of about ``most`` bytes together (at least one text each)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spark_hash_long(x: np.ndarray, seed: int | np.ndarray = 42) -> np.ndarray:
    """What ``xxhash64(bigint)`` gives in Spark SQL, as signed 64-bit."""
    p1, p2, p3, p4, p5 = (U64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rot = lambda v, r: (v << U64(r)) | (v >> U64(64 - r))
    with np.errstate(over="ignore"):
        h = np.full(len(x), p5 + U64(8), U64) + (seed.view(U64) if isinstance(seed, np.ndarray) else U64(seed))
        h ^= rot(np.asarray(x, np.int64).view(U64) * p2, 31) * p1
        h = rot(h, 27) * p1 + p4
        h = (h ^ (h >> U64(33))) * p2
        h = (h ^ (h >> U64(29))) * p3
        h ^= h >> U64(32)
    return h.view(np.int64)


def parts_of(doc_id: np.ndarray, n: int, row: np.ndarray) -> np.ndarray:
    """``pmod(xxhash64(doc_id, row), n)``."""
    return np.mod(spark_hash_long(row, spark_hash_long(doc_id)), n).astype(np.int32)


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i+1]]; zero for empty ranges."""
    c = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    return c[offsets[1:]] - c[offsets[:-1]]
