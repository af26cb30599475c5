"""Monotone sequences in Elias-Fano form, read in place from a buffer or memory map.

Each value is cut into low bits, packed one after the other, and a high part, held in unary in a
bit vector: the i-th one stands at position high + i. Counts of ones by blocks of 512 bits lead to the
i-th one or zero. All operations take arrays of queries.
"""

from __future__ import annotations

import struct

import numpy as np

_BLOCK = 8  # words of 64 bits


def encode(values: np.ndarray, universe: int) -> bytes:
    """``values``: ascending, below ``universe``."""
    n = len(values)
    low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
    values = values.astype(np.uint64)
    size = n + (universe >> low_bits) + 2
    words = (size // 64 // _BLOCK + 1) * _BLOCK
    bits = np.zeros(words * 64, np.uint8)
    bits[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
    upper = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.concatenate(([0], np.cumsum(np.bitwise_count(upper).reshape(-1, _BLOCK).sum(axis=1, dtype=np.int64))))
    low = np.zeros(n * low_bits // 64 + 2, np.uint64)
    if low_bits and n:
        rest = values & np.uint64((1 << low_bits) - 1)
        at = np.arange(n, dtype=np.int64) * low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        head = np.flatnonzero(np.diff(word, prepend=-1))
        low[word[head]] |= np.bitwise_or.reduceat(rest << shift, head)
        over = (at & 63) + low_bits > 64
        low[word[over] + 1] |= rest[over] >> (np.uint64(64) - shift[over])
    return struct.pack("<QQQQ", n, low_bits, words, len(low)) + upper.tobytes() + ones.astype("<u8").tobytes() + low.tobytes()


class EliasFano:
    """A sequence in ``data`` from ``at``; ``end`` is where it ends."""

    def __init__(self, data, at: int = 0):
        self.n, self.low_bits, words, lows = struct.unpack("<QQQQ", data[at : at + 32])
        at += 32
        self.upper = np.frombuffer(data, np.uint64, words, at)
        self.ones = np.frombuffer(data, np.int64, words // _BLOCK + 1, at + 8 * words)
        at += 8 * words + 8 * (words // _BLOCK + 1)
        self.low = np.frombuffer(data, np.uint64, lows, at)
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * (64 * _BLOCK) - self.ones
        self.end = at + 8 * lows

    def _select(self, which: np.ndarray, zeros: bool) -> np.ndarray:
        """Position of each ``which``-th (from 0) one or zero."""
        counts = self.zeros if zeros else self.ones
        block = np.searchsorted(counts, which, "right") - 1
        left = which - counts[block]
        word = block * _BLOCK
        for _ in range(_BLOCK - 1):
            bits = self.upper[word]
            have = np.bitwise_count(~bits if zeros else bits).astype(np.int64)
            go = left >= have
            if not go.any():
                break
            left = np.where(go, left - have, left)
            word = word + go
        bits = self.upper[word]
        bits = ~bits if zeros else bits.copy()
        at = np.zeros(len(which), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            have = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            go = left >= have
            left = np.where(go, left - have, left)
            shift = np.where(go, width, 0)
            bits = bits >> shift.astype(np.uint64)
            at += shift
        return word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        value |= (self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return (value & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at the places ``i``."""
        return (self._select(i, False) - i) << self.low_bits | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is at least ``x`` within the values of the same high part; -1
        if it isn't equal to ``x``. ``x`` is below the universe."""
        high, rest = x >> self.low_bits, x & ((1 << self.low_bits) - 1)
        first = np.where(high > 0, self._select(np.maximum(high - 1, 0), True) - high + 1, 0)
        last = self._select(high, True) - high
        out = np.full(len(x), -1, np.int64)
        while True:  # bisection of all ranges together
            open_ = np.flatnonzero(first < last)
            if not len(open_):
                break
            a, b = first[open_], last[open_]
            middle = (a + b) >> 1
            value, wanted = self._low(middle), rest[open_]
            out[open_[value == wanted]] = middle[value == wanted]
            first[open_] = np.where(value < wanted, middle + 1, a)
            last[open_] = np.where(value < wanted, b, middle)
        return out
