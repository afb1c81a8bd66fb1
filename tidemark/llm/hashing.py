"""Hashes of parts of a text, for all parts at once."""

from __future__ import annotations

from functools import cache

import numpy as np


class Hash:
    """Hashes of any part of a piece, from running sums of a polynomial over 64 bits."""

    @staticmethod
    @cache
    def _tables(seed: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rng = np.random.default_rng(seed)
        of_byte = rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 62)) * 4 + 5
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        inverse = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        with np.errstate(over="ignore"):
            return of_byte, np.cumprod(powers), np.cumprod(inverse)

    def __init__(self, text: np.ndarray, seed: int) -> None:
        size = 1 << max(19, int(len(text)).bit_length())
        of_byte, powers, self.inverse = self._tables(seed, size)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(of_byte[text] * powers[:len(text)], out=self.sums[1:])

    def grams(self, size: int) -> np.ndarray:
        found = self.sums[size:] - self.sums[:-size]
        found *= self.inverse[:len(found)]
        return mixed(found)

    def parts(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = hashes ^ (hashes >> np.uint64(32))
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    return hashes
