"""Content-chosen places in byte strings: hashes of substrings and the lowest of neighbouring values."""

from __future__ import annotations

import numpy as np

from .common import mix

_BASE = 0x9E3779B97F4A7C15
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of them at least."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            _POWERS[i] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]), dtype=np.uint64)
    return _POWERS


class Hashes:
    """Hash of any substring of ``data`` from two sums; equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[starts + sizes] - self.sums[starts]) * self.inverse[starts])

    def grams(self, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from each place on; places too near the end are left out."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    return Hashes(data).grams(size)


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest value of each ``width`` values in a row."""
    if len(values) < width:
        return values[:0]
    pick, have = np.minimum if least else np.maximum, 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values
