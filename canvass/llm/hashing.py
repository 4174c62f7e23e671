"""Vectorised polynomial hashes of byte ranges, modulo 2^64, over fixed random byte values."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


class RangeHash:
    """Hashes of byte ranges of one buffer; equal bytes have equal hashes wherever they stand."""

    def __init__(self, buf: np.ndarray):
        up, self._down = powers(len(buf) + 1)
        self._total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[:-1], dtype=np.uint64, out=self._total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._total[end] - self._total[start]) * self._down[start])
