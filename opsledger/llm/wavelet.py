"""A wavelet matrix over the character classes of many texts laid end to end.

Every character has one of four classes of two bits. Level 0 holds the high bits in text order;
level 1 holds the low bits after a stable sort by the high bit. A count of one class before a
place is one rank on each level, with running counts per word of 64 bits and the bits inside it.
"""

from __future__ import annotations

import numpy as np

#: Classes of characters: anything else, a line feed, other white space, white space of more lines.
OTHER, LINE_FEED, BLANK, BREAK = 0, 1, 2, 3
_BLANKS = np.array([0x20, 0x09], np.uint32)
_BREAKS = np.array([0x0B, 0x0C, 0x0D], np.uint32)


def classes(points: np.ndarray) -> np.ndarray:
    """Class of every code point."""
    out = np.zeros(points.size, np.uint8)
    low = np.flatnonzero(points <= 0x20)
    found = points[low]
    out[low[found == 0x0A]] = LINE_FEED
    out[low[np.isin(found, _BLANKS)]] = BLANK
    out[low[np.isin(found, _BREAKS)]] = BREAK
    return out


class _Bits:
    """A row of bits with the number of ones before each word of 64."""

    def __init__(self, bits: np.ndarray) -> None:
        self.size = bits.size
        words = np.zeros((bits.size // 64 + 1) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        words[: packed.size] = packed
        self.words = words.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        inside = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)


class WaveletMatrix:
    """Ranks of classes by two levels of bits; places may be arrays."""

    def __init__(self, codes: np.ndarray) -> None:
        high = codes >> 1
        self.size = codes.size
        self.high = _Bits(high)
        self.zeros = int(codes.size - high.sum())
        order = np.concatenate((np.flatnonzero(high == 0), np.flatnonzero(high)))
        self.low = _Bits((codes & 1)[order])

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """Characters of a class before each place."""
        ones = self.high.ones(at)
        start, end = (np.full_like(at, self.zeros), self.zeros + ones) if code >> 1 else (np.zeros_like(at), at - ones)
        n = self.low.ones(end) - self.low.ones(start)
        return n if code & 1 else end - start - n

    def ranks(self, codes: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """Characters of any of the classes before each place."""
        return sum(self.rank(c, at) for c in codes)

    def select(self, codes: tuple[int, ...], n: np.ndarray) -> np.ndarray:
        """Place after the n-th character (from 1) of the classes, by bisection on their rank; 0 for n = 0."""
        low, high = np.zeros(n.size, np.int64), np.full(n.size, self.size, np.int64)
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self.ranks(codes, middle) >= n
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low
