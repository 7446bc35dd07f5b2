"""Elias-Fano coded levels of an n-gram trie in one flat buffer.

A level's sorted numbers are split: low bits stand in an array of whole bytes, high parts in a
bit vector in unary, with a count of zeros per 64 bits. The buffer can be a file that is mapped
into memory or bytes from a table; nothing is unpacked to query it.
"""

from __future__ import annotations

import json

import numpy as np

_ONES = np.array([[bin(b).count("1")] for b in range(256)], np.uint8).ravel()
# Place of the k-th zero bit of a byte, from the lowest; 8 if it has fewer.
_ZERO = np.full((256, 8), 8, np.uint8)
for _byte in range(256):
    _at = [i for i in range(8) if not _byte >> i & 1]
    _ZERO[_byte, :len(_at)] = _at


def pack_levels(arrays: dict[str, np.ndarray]) -> bytes:
    """A header with names, types and places, then the arrays at multiples of 8 bytes."""
    head, parts, at = {}, [], 0
    for name, array in arrays.items():
        raw = np.ascontiguousarray(array).tobytes()
        head[name] = [array.dtype.str, at, len(array)]
        parts.append(raw + b"\0" * (-len(raw) % 8))
        at += len(parts[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(parts)


def open_levels(buffer: bytes | np.ndarray) -> dict[str, np.ndarray]:
    """Views of the arrays in a buffer, for example ``np.memmap(path, np.uint8, "r")``."""
    raw = np.frombuffer(buffer, np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    head, base = json.loads(raw[8:8 + size].tobytes()), 8 + size
    return {name: raw[base + at:base + at + n * np.dtype(kind).itemsize].view(kind)
            for name, (kind, at, n) in head.items()}


class EliasFano:
    """Sorted non-negative numbers, possibly repeated: ``access`` by place and ``find`` by value."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str) -> None:
        self.low, self.high, self.zeros = (arrays[f"{name}.{part}"] for part in ("low", "high", "zeros"))
        self.bits = np.uint64(8 * self.low.dtype.itemsize)
        self.size = len(self.low)

    @staticmethod
    def build(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        spread = int(values[-1]) // len(values) if len(values) else 0
        kind = np.uint8 if spread < 1 << 9 else np.uint16 if spread < 1 << 17 else np.uint32
        bits = np.uint64(8 * np.dtype(kind).itemsize)
        above = (values >> bits).astype(np.int64)
        total = len(values) + (int(above[-1]) if len(values) else 0) + 2
        vector = np.zeros(-(-total // 64) * 64, np.uint8)
        vector[above + np.arange(len(values))] = 1
        high = np.packbits(vector, bitorder="little")
        per_word = 64 - _ONES[high].reshape(-1, 8).sum(1, dtype=np.int64)
        zeros = np.concatenate([[0], np.cumsum(per_word)])
        return {f"{name}.low": values.astype(kind), f"{name}.high": high,
                f"{name}.zeros": zeros.astype(np.uint32 if zeros[-1] < 1 << 32 else np.uint64)}

    def _select_zero(self, rank: np.ndarray) -> np.ndarray:
        """Place of each ``rank``-th zero (from 0) of the bit vector."""
        word = np.searchsorted(self.zeros, rank, "right") - 1
        left, at = rank - self.zeros[word].astype(np.int64), word * 8
        for _ in range(7):
            here = 8 - _ONES[self.high[at]].astype(np.int64)
            on = left >= here
            left, at = left - np.where(on, here, 0), at + on
        return at * 8 + _ZERO[self.high[at], left]

    def bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the numbers with a high part: begin and end."""
        high = high.astype(np.int64)
        known = high < int(self.zeros[-1])
        safe = np.where(known, high, 0)
        end = self._select_zero(safe) - safe
        begin = np.where(safe > 0, self._select_zero(np.maximum(safe - 1, 0)) - np.maximum(safe - 1, 0), 0)
        return np.where(known, begin, self.size), np.where(known, end, self.size)

    def find(self, values: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of the first number not below each value, inside [begin, end) where given."""
        values = values.astype(np.uint64)
        lo, hi = self.bucket(values >> self.bits)
        if begin is not None:
            lo, hi = np.maximum(lo, begin), np.minimum(hi, end)
        low = (values & np.uint64((1 << int(self.bits)) - 1)).astype(self.low.dtype)
        hi = np.maximum(lo, hi)
        while (open_ := lo < hi).any():
            middle = np.where(open_, (lo + hi) // 2, 0)
            below = open_ & (self.low[middle] < low)
            lo, hi = np.where(below, middle + 1, lo), np.where(open_ & ~below, middle, hi)
        return lo

    def holds(self, values: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether ``place`` (from ``find``) has the value itself."""
        begin, end = self.bucket(values.astype(np.uint64) >> self.bits)
        inside = (place >= begin) & (place < end)
        safe = np.where(inside, place, 0)
        low = (values.astype(np.uint64) & np.uint64((1 << int(self.bits)) - 1)).astype(self.low.dtype)
        return inside & (self.low[safe] == low) if self.size else inside


class BigramTrie:
    """Contexts, pointers to their successors, successors and quantised probabilities."""

    def __init__(self, buffer: bytes | np.ndarray) -> None:
        self.levels = open_levels(buffer)
        self.contexts, self.pointers, self.successors = (
            EliasFano(self.levels, n) for n in ("contexts", "pointers", "successors"))
        self.codes, self.scale = self.levels["codes"], self.levels["scale"]
        self.width = int(self.levels["width"][0])

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, log_probability: np.ndarray, width: int) -> bytes:
        """From (context, word) pairs sorted by both and log10 probabilities; words are below ``width``.

        Successors are stored relative to the rank of their context, so the level is monotone.
        """
        new = np.r_[True, context[1:] != context[:-1]] if len(context) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        rank = np.cumsum(new) - 1
        low = float(log_probability.min(initial=0.0))
        step = max(-low / 254, 1e-9)
        codes = np.rint((log_probability - low) / step).astype(np.uint8) + 1
        return pack_levels({
            **EliasFano.build(context[first], "contexts"),
            **EliasFano.build(np.r_[first, len(context)], "pointers"),
            **EliasFano.build(rank.astype(np.uint64) * np.uint64(width) + word.astype(np.uint64), "successors"),
            "codes": codes.astype(np.uint8), "scale": np.array([low, step]), "width": np.array([width], np.int64)})

    def pointer(self, rank: np.ndarray) -> np.ndarray:
        """Number ``rank`` of the pointer level: its one in the bit vector, by search over the zeros' counts."""
        bits, low = self.pointers.high, self.pointers.low
        ones = np.arange(len(self.pointers.zeros), dtype=np.int64) * 64 - self.pointers.zeros
        word = np.searchsorted(ones, rank, "right") - 1
        left, at = rank - ones[word], word * 8
        for _ in range(7):
            here = _ONES[bits[at]].astype(np.int64)
            on = left >= here
            left, at = left - np.where(on, here, 0), at + on
        place = at * 8 + _ZERO[~bits[at], left]
        return ((place - rank) << int(self.pointers.bits)) + low[rank].astype(np.int64)

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of pairs: 0 for a pair that is not in the trie."""
        out = np.zeros(len(context), np.uint8)
        if not self.contexts.size or not len(context):
            return out
        rank = self.contexts.find(context)
        known = np.flatnonzero(self.contexts.holds(context, rank))
        rank = rank[known]
        begin, end = self.pointer(rank), self.pointer(rank + 1)
        key = rank.astype(np.uint64) * np.uint64(self.width) + word[known].astype(np.uint64)
        place = self.successors.find(key, begin, end)
        hit = self.successors.holds(key, place)
        out[known[hit]] = self.codes[place[hit]]
        return out
