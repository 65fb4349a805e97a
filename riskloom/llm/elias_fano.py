"""Elias-Fano coded monotone sequences, read from memory-mapped arrays by whole arrays of queries."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_ONES = ~_U(0)


def _select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit with so many set bits before it, in each 64-bit word."""
    words, rank = words.copy(), rank.astype(np.uint8)
    place = np.zeros(len(words), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = words & ((_U(1) << _U(width)) - _U(1))
        count = np.bitwise_count(low)
        up = rank >= count
        place += np.where(up, width, 0)
        rank = np.where(up, rank - count, rank)
        words = np.where(up, words >> _U(width), low)
    return place


class EliasFano:
    """A non-decreasing sequence below ``universe``: low bits as they are, high bits in unary.

    The arrays ``low``, ``high`` and ``ones`` (set bits before each word of ``high``) may be memory
    maps.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        places = (values >> _U(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((n + (universe >> width) + 1 + 63) // 64 * 64 + 64, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width:
            part = values & ((_U(1) << _U(width)) - _U(1))
            at = np.arange(n, dtype=np.int64) * width
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + _U(width) > _U(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - shift[over]))
        return cls(n, width, low, high, ones.astype(np.uint32 if n < 1 << 32 else np.uint64))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ones": self.ones}

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), np.uint64)
        bit = at * self.width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = shift + _U(self.width) > _U(64)
        if over.any():
            value[over] |= self.low[word[over] + 1] << (_U(64) - shift[over])
        return value & ((_U(1) << _U(self.width)) - _U(1))

    def _ones_before_zero(self, k: np.ndarray) -> np.ndarray:
        """Set bits before the k-th unset bit, counted from 0."""
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(zeros, k, "right") - 1
        inside = _select_in_word(~self.high[word], k - zeros[word])
        return word * 64 + inside - k

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at some places."""
        at = at.astype(np.int64)
        word = np.searchsorted(self.ones, at, "right") - 1
        inside = _select_in_word(self.high[word], at - self.ones[word])
        return ((word * 64 + inside - at).astype(np.uint64) << _U(self.width)) | self._low(at)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the successor, whether it equals the value) for each value.

        The successor is the first element that is not less. The high bits give the bucket, and a
        binary search over its low bits the place.
        """
        if not len(values) or not self.n:
            return np.full(len(values), self.n, np.int64), np.zeros(len(values), bool)
        values = values.astype(np.uint64)
        bucket = (values >> _U(self.width)).astype(np.int64)
        wanted = values & ((_U(1) << _U(self.width)) - _U(1))
        low = np.zeros(len(values), np.int64)
        later = bucket > 0
        low[later] = self._ones_before_zero(bucket[later] - 1)
        high = self._ones_before_zero(bucket)
        end = high.copy()
        open_ = low < high
        while open_.any():
            todo = np.flatnonzero(open_)
            middle = (low[todo] + high[todo]) >> 1
            less = self._low(middle) < wanted[todo]
            low[todo] = np.where(less, middle + 1, low[todo])
            high[todo] = np.where(less, high[todo], middle)
            open_ = low < high
        found = low < end
        found[found] = self._low(low[found]) == wanted[found]
        return low, found
