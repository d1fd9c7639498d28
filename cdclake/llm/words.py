"""Words, word n-grams and their 64-bit hashes, for whole slices of texts at once.

A word is a run of bytes other than 0x20 and 0x09-0x0D, which are never part of a
longer UTF-8 sequence. Hashes are polynomials modulo 2**64 over random values of the
bytes (or words), mixed at the end; equal sequences have equal hashes in every task.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = {"byte": 0x9E3779B97F4A7C15, "word": 0xD1342543DE82EF95}
_VALUES = np.random.Generator(np.random.PCG64(20250117)).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[tuple[int, int], np.ndarray] = {}


class Words(NamedTuple):
    hashes: np.ndarray  # of each word
    starts: np.ndarray  # byte positions
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word; one more entry than texts

    @property
    def text(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    known = _powers.get((base, 0))
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16) * 5 // 4, base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if len(known) <= 8 << 20:
            _powers[base, 0] = known
    return known[:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str = "word") -> np.ndarray:
    """Hash of each ``values[start:end]``; ranges may overlap."""
    base = _BASE[kind]
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    inverse = powers(pow(base, -1, 2**64), len(values) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def split(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> Words:
    """Words of the texts in ``data``, set apart by the bytes that ``apart`` flags; none crosses from one text to the next."""
    inside = ~apart[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        begin, end = offsets[:-1][full], offsets[1:][full] - 1
        first[begin] = inside[begin]
        last[end] = inside[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(range_hashes(_VALUES[data], starts, ends, "byte"), starts, ends, np.searchsorted(starts, offsets))


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows that stay within a text, and the index of the first word of each."""
    at = np.arange(max(0, len(w.hashes) - n + 1))
    at = at[at + n <= w.first[1:][w.text[at]]] if len(at) else at
    return range_hashes(w.hashes, at, at + n), at
