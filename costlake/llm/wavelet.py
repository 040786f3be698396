"""Wavelet matrix over whole numbers: bit planes with rank and select, queried for many positions at once.

Plane ``l`` holds, from the highest bit down, one bit of every value; after each plane the values with
a 0 go before those with a 1, in stable order. A query follows its positions through the planes, so
each costs two ranks per bit, whatever the length. All queries take and return numpy arrays.

Edge cases: an empty sequence has empty planes and every count is 0; values of one kind only (all bits
equal) need no special care; a value that does not occur has rank 0 and an empty range.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class BitPlane:
    """``n`` bits with the number of ones before each 64-bit word."""

    def __init__(self, words: np.ndarray, n: int):
        self.n = n
        self.words = words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(ones, out=self.before[1:])

    @classmethod
    def of(cls, bits: np.ndarray) -> BitPlane:
        return cls(packed(bits), len(bits))

    def need(self, words: np.ndarray) -> None:
        """Called with the words that a query is about to read."""

    @property
    def ones(self) -> int:
        return int(self.before[-1])

    def bits(self) -> np.ndarray:
        """All bits, as booleans."""
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        self.need(word)
        return (self.words[word] >> (at & 63).astype(np.uint64)) & _ONE != 0

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position, ``at`` between 0 and n."""
        word = np.minimum(at >> 6, len(self.words) - 1) if len(self.words) else at
        if not len(self.words):
            return np.zeros_like(at)
        self.need(word)
        inside = (at - (word << 6)).astype(np.uint64)
        # A shift by 64 is undefined, so the mask of a full word is chosen apart.
        mask = np.where(inside >= 64, _ALL, (_ONE << np.minimum(inside, np.uint64(63))) - _ONE)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def select(self, k: np.ndarray, bit: bool) -> np.ndarray:
        """Position of the ``k``-th (from 0) one, or zero; each must exist."""
        before = self.before if bit else (np.arange(len(self.before), dtype=np.int64) << 6) - self.before
        word = np.searchsorted(before, k, side="right") - 1
        self.need(word)
        value = self.words[word] if bit else ~self.words[word]
        left = k - before[word]
        at = np.zeros(len(k), dtype=np.int64)
        for step in (32, 16, 8, 4, 2, 1):  # halve the word by the ones in its lower part
            low = (value >> at.astype(np.uint64)) & np.uint64((1 << step) - 1)
            ones = np.bitwise_count(low).astype(np.int64)
            over = ones <= left
            left = np.where(over, left - ones, left)
            at = np.where(over, at + step, at)
        return (word << 6) + at


def packed(bits: np.ndarray) -> np.ndarray:
    """Booleans as little-endian 64-bit words."""
    raw = np.packbits(bits, bitorder="little")
    out = np.zeros(-(-len(bits) // 64) * 8, dtype=np.uint8)
    out[: len(raw)] = raw
    return out.view(np.uint64)


def value_type(bits: int) -> type:
    return np.uint16 if bits <= 16 else np.uint32 if bits <= 32 else np.uint64


class WaveletMatrix:
    def __init__(self, planes: list, n: int):
        self.planes, self.n = planes, n
        self.zeros = [n - plane.ones for plane in planes]

    @classmethod
    def of(cls, values: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        """``values`` are not negative and below 2**bits."""
        if bits is None:
            bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        kind = value_type(bits)
        values = values.astype(kind)
        planes = []
        for level in range(bits - 1, -1, -1):
            one = values & kind(1 << level) != 0
            planes.append(BitPlane.of(one))
            # Compressing by a mask is several times faster here than indexing with it.
            values = np.concatenate((values.compress(~one), values.compress(one)))
        return cls(planes, len(values))

    def decode(self) -> np.ndarray:
        """The whole sequence: every plane's partition is undone, the lowest plane first."""
        kind = value_type(len(self.planes))
        values = np.zeros(self.n, dtype=kind)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            one = plane.bits()
            ordered = np.empty_like(values)
            ordered[np.flatnonzero(~one)] = values[:zeros]
            ordered[np.flatnonzero(one)] = values[zeros:] | kind(1 << level)
            values = ordered
        return values

    def access(self, at: np.ndarray) -> np.ndarray:
        """The value at each position."""
        at = np.asarray(at, dtype=np.int64)
        out = np.zeros(len(at), dtype=np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            one, ones = plane.get(at), plane.rank(at)
            out = (out << 1) | one
            at = np.where(one, zeros + ones, at - ones)
        return out

    def _range_of(self, value: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the occurrences before ``end`` lie below the last plane."""
        low = np.zeros(len(end), dtype=np.int64)
        for i, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            one = (value >> (len(self.planes) - 1 - i)) & 1 != 0
            low_ones, end_ones = plane.rank(low), plane.rank(end)
            low = np.where(one, zeros + low_ones, low - low_ones)
            end = np.where(one, zeros + end_ones, end - end_ones)
        return low, end

    def rank(self, value: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each value occurs before each position."""
        value, end = np.broadcast_arrays(np.asarray(value, np.int64), np.asarray(end, np.int64))
        low, high = self._range_of(value, end)
        return np.where((value >> len(self.planes)) == 0, high - low, 0)

    def count(self, value: np.ndarray) -> np.ndarray:
        value = np.asarray(value, dtype=np.int64)
        return self.rank(value, np.full(len(value), self.n))

    def select(self, value: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Position of the ``k``-th (from 0) occurrence of each value, -1 where there are fewer."""
        value, k = np.broadcast_arrays(np.asarray(value, np.int64), np.asarray(k, np.int64))
        found = (k >= 0) & (k < self.count(value))
        out = np.full(len(k), -1, dtype=np.int64)
        value, k = value[found], k[found]
        at = self._range_of(value, np.zeros(len(k), dtype=np.int64))[0] + k
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            one = (value >> level) & 1 != 0
            back = np.empty_like(at)
            back[one] = plane.select(at[one] - zeros, True)
            back[~one] = plane.select(at[~one], False)
            at = back
        out[found] = at
        return out

    def count_less(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in each range [low, high) are below each bound."""
        out = np.zeros(len(low), dtype=np.int64)
        above = (bound >> len(self.planes)) > 0
        whole = high - low
        for i, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            one = (bound >> (len(self.planes) - 1 - i)) & 1 != 0
            low_ones, high_ones = plane.rank(low), plane.rank(high)
            out += np.where(one, (high - high_ones) - (low - low_ones), 0)
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return np.where(above, whole, out)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest (from 0) value of each range; ``k`` must be below its length."""
        out = np.zeros(len(low), dtype=np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            low_ones, high_ones = plane.rank(low), plane.rank(high)
            without = (high - high_ones) - (low - low_ones)
            one = k >= without
            out = (out << 1) | one
            k = np.where(one, k - without, k)
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return out

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest value of each range that is not below its bound, -1 where there is none."""
        below = self.count_less(low, high, bound)
        out = np.full(len(low), -1, dtype=np.int64)
        found = below < high - low
        out[found] = self.smallest(low[found], high[found], below[found])
        return out
