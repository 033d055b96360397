"""Distinct pre-tokens of many texts as ragged numpy arrays.

Texts lie in one byte buffer, cut into pre-tokens at given places. Equal pre-tokens are found by
a 64-bit polynomial hash from prefix sums, mixed with the length: no Python object is made per
pre-token, only per distinct one. Buffers are bounded; a longer text gets a buffer of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np

#: Bytes of text that are worked on at once, unless one text alone is longer.
BUFFER_BYTES = 2 << 20
#: Distinct pre-tokens and bytes of them that a task remembers before it starts anew.
KNOWN_MOST, KNOWN_BYTES = 1_000_000, 64 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out)


def buffers(texts: Sequence[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts of bounded size: (index of the first, texts); null is empty."""
    at, run, size = 0, [], 0
    for i, x in enumerate(texts):
        x = x or b""
        if run and size + len(x) > BUFFER_BYTES:
            yield at, run
            at, run, size = i, [], 0
        run.append(x)
        size += len(x)
    if run:
        yield at, run


class Known:
    """Per-task memory of distinct pre-tokens: sorted hashes and the place of their values."""

    def __init__(self) -> None:
        self.reset()
        self.power = _powers(_BASE, BUFFER_BYTES + 1)
        self.inverse = _powers(_INVERSE, BUFFER_BYTES + 1)

    def reset(self) -> None:
        self.hashes, self.places = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.count = self.bytes = 0

    def hash(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if raw.size >= self.power.size:
            self.power, self.inverse = _powers(_BASE, raw.size + 1), _powers(_INVERSE, raw.size + 1)
        sums = np.zeros(raw.size + 1, np.uint64)
        np.cumsum(raw * self.power[: raw.size] + self.power[: raw.size], out=sums[1:])
        h = (sums[end] - sums[start]) * self.inverse[start]
        h ^= h >> np.uint64(29)
        return h * np.uint64(0xBF58476D1CE4E5B9) + (end - start).astype(np.uint64)

    def look_up(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, add: Callable[[np.ndarray, np.ndarray], None]) -> np.ndarray:
        """Place of every pre-token; ``add(starts, ends)`` is told the new ones in place order."""
        h, first, which = np.unique(self.hash(raw, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, h)
        known = np.zeros(h.size, bool)
        inside = at < self.hashes.size
        known[inside] = self.hashes[at[inside]] == h[inside]
        place = np.empty(h.size, np.int64)
        place[known] = self.places[at[known]]
        new = first[~known]
        place[~known] = self.count + np.arange(new.size)
        if new.size:
            add(start[new], end[new])
            self.count += new.size
            self.bytes += int((end[new] - start[new]).sum())
            self.hashes = np.insert(self.hashes, at[~known], h[~known])
            self.places = np.insert(self.places, at[~known], place[~known])
        return place[which]

    def full(self) -> bool:
        return self.count > KNOWN_MOST or self.bytes > KNOWN_BYTES


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated index ranges start[i] .. start[i] + length[i]."""
    total = int(length.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)
