"""Words of whole Arrow string columns as 64-bit hashes, without a Python loop over them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Bytes of text hashed at once; a longer text is hashed alone.
CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def chunks(values: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK bytes of text."""
    offsets = _offsets(values)
    row = 0
    while row < len(values):
        stop = max(int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1, row + 1)
        yield row, stop
        row = stop


def _offsets(values: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(values.type) else np.int32
    raw = np.frombuffer(values.buffers()[1], kind) if values.buffers()[1] else np.zeros(1, kind)
    return raw[values.offset:values.offset + len(values) + 1].astype(np.int64)


def word_hashes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, A-Z lowered, and where each row's words begin (rows + 1 numbers).

    Words are runs of bytes other than space and 0x09-0x0D. NULL rows have none. Different words
    have the same 64-bit hash with a chance of about their number squared over 2^65.
    """
    offsets = _offsets(values)
    base = offsets[0]
    data = np.frombuffer(values.buffers()[2], np.uint8)[base:offsets[-1]] if values.buffers()[2] else np.zeros(0, np.uint8)
    offsets = offsets - base
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(values) + 1, np.int64)
    data = _LOWER[data]
    inside = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.r_[False, inside[:-1]] & ~first[:-1]
    after = np.r_[inside[1:], False] & ~first[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    power, inverse = _powers(max(CHUNK + (1 << 16), 1 << int(n + 1).bit_length() if n > CHUNK else 0))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    begin = np.searchsorted(starts, offsets)
    if values.null_count:  # a NULL row may have bytes behind it
        null = np.asarray(values.is_null())
        keep = ~np.repeat(null, np.diff(begin))
        hashes = hashes[keep]
        begin = np.r_[0, np.cumsum(np.where(null, 0, np.diff(begin)))]
    return hashes, begin
