"""Hashes of the words of a text, all at once.

A word is a run of letters, digits and, if asked for, underscores of the lower-case text: what
`\\w+` or `[^\\W_]+` finds. Its hash is that of a polynomial over its characters; differences of
running sums give the polynomials of all words, and of their beginnings, without a loop.
"""

from __future__ import annotations

import sys
from functools import cache

import numpy as np

from orderlake.llm.tokens import stretches

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
_STRETCH = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


@cache
def _in_word(underscore: bool) -> np.ndarray:
    """For each code point whether it is part of a word; made once by a worker."""
    table = np.fromiter((chr(c).isalnum() for c in range(sys.maxunicode + 1)), np.int8, sys.maxunicode + 1)
    table[ord("_")] = underscore
    return table


class Words:
    """Words of a text: places in its lower-case form, and hashes."""

    def __init__(self, underscore: bool = True):
        self.in_word = _in_word(underscore)
        self.power, self.back = _powers(_BASE, 1), _powers(_INVERSE, 1)

    def of(self, text: str, beginnings: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Starts, ends and hashes of the words, and for each length in `beginnings` the hashes
        of the beginnings of longer words."""
        parts, at = [], 0
        lowered = text.lower()
        for part in stretches(lowered, _STRETCH):
            starts, ends, hashes, begins = self._of(part, beginnings)
            parts.append((starts + at, ends + at, hashes, *begins))
            at += len(part)
        columns = parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts))
        return columns[0], columns[1], columns[2], list(columns[3:])

    def _of(self, text: str, beginnings: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(codes) >= len(self.power):
            self.power, self.back = _powers(_BASE, 2 * len(codes)), _powers(_INVERSE, 2 * len(codes))
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = self.in_word[codes]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(codes) + 1, np.uint64)
        terms = (codes + np.uint64(1)) * GOLDEN
        terms *= self.power[: len(codes)]
        np.cumsum(terms, out=sums[1:])
        back = self.back[starts]

        def hashed(start: np.ndarray, end: np.ndarray, back: np.ndarray, kind: int) -> np.ndarray:
            return mixed((sums[end] - sums[start]) * back + (end - start).astype(np.uint64) * GOLDEN + np.uint64(kind))

        begins = []
        for n in beginnings:
            long = ends - starts > n
            begins.append(hashed(starts[long], starts[long] + n, back[long], n))
        return starts, ends, hashed(starts, ends, back, 0), begins
