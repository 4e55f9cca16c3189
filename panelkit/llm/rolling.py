"""Prefix polynomial hashes over bytes, modulo 2^64: the hash of any substring in constant time, vectorised."""
import functools

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Prefix:
    """Hashes of substrings of one byte array."""

    def __init__(self, body: np.ndarray):
        n = len(body)
        size = 1 << max(n, 1 << 16).bit_length()          # few sizes, so that powers are computed once
        up, self.down = _powers(size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal for equal substrings [start, end), wherever they stand."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k bytes from every place on."""
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]
