"""Polynomial hashes of byte ranges."""

from __future__ import annotations

import numpy as np

from audix.llm.batches import mix64, random_words

_BYTE = random_words(256, 23)
_BASE = int(random_words(1, 29)[0]) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class RollingHash:
    """Hashes of any byte range of an array, from prefix sums modulo 2**64."""

    powers = inverses = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(RollingHash.powers) <= n:
            size = max(n + 1, 1 << 20)
            RollingHash.powers = np.cumprod(np.append(np.uint64(1), np.full(size, _BASE, np.uint64)))
            RollingHash.inverses = np.cumprod(np.append(np.uint64(1), np.full(size, _INVERSE, np.uint64)))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * RollingHash.powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * RollingHash.inverses[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix64((self.sums[size:] - self.sums[:n]) * RollingHash.inverses[:n])
