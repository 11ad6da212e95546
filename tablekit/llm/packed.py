"""Strings side by side in one byte buffer: hashing, gathering, runs. All numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def layout(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each value starts and the last ends."""
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _MULTIPLY
    return h ^ (h >> np.uint64(32))


def hash_spans(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``, eight bytes a step."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, 0, (1,))
    h = mix(size.astype(np.uint64) + np.uint64(1))
    left, live = size.copy(), np.flatnonzero(size > 0)
    at = start.copy()
    while len(live):
        bits = np.minimum(left[live], 8).astype(np.uint64) * np.uint64(8)
        value = eight[at[live]] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - bits))
        h[live] = mix((h[live] ^ value) * _MULTIPLY)
        left[live] -= 8
        at[live] += 8
        live = live[left[live] > 0]
    return h


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The spans of ``values`` one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(start - (ends - size), size)]


def true_runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of True that no boundary of a value cuts through."""
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(mask))]
    first[inner] = mask[inner]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1
