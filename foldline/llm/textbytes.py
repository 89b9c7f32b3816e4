"""Whole Arrow text columns as byte arrays: word bounds and rolling hashes with numpy.

A text of any length is handled in one piece; null counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def flat(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and its n + 1 offsets (from 0)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if lower:
        column = pc.ascii_lower(column)
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def blocks(offsets: np.ndarray, size: int = 1 << 21):
    """Row ranges of about ``size`` bytes each (one row at least)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end
        row = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash, so that any span's hash is one subtraction."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(len(data))[0][:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes start..end of each span."""
    back = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * back[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, size: int = 1 << 21) -> np.ndarray:
    """``span_hash`` of sorted spans that don't overlap, with prefix hashes of about ``size`` bytes at a time."""
    out, row = [], 0
    while row < len(start):
        stop = max(row + 1, int(np.searchsorted(end, start[row] + size, "right")))
        base = start[row]
        out.append(span_hash(prefix_hash(data[base:end[stop - 1]]), start[row:stop] - base, end[row:stop] - base))
        row = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of every maximal run of bytes other than ASCII white space."""
    solid = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | cut[1:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | cut[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    """The bytes of each span."""
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices start[i], start[i] + 1, ... of every run, one after another."""
    total = int(length.sum())
    first = np.cumsum(length) - length
    return np.arange(total) + np.repeat(start - first, length)
