"""Hashes of words and of runs of words, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED = 150_000
_BASE = 0x9E3779B97F4A7C15
_OTHER = 0xC2B2AE3D27D4EB4F


class WordHashes(dict):
    """64-bit hash by word, worked out on first sight."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHED:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Runs:
    """Hashes of any run of a document's words from running sums of word hash times base to the power of its place."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, hashes: np.ndarray, base: int = _BASE):
        n = len(hashes)
        power, inverse = self._table(n + 1, base)
        self.inverse = inverse
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * power[:n], out=self.sums[1:])

    @classmethod
    def _table(cls, n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in cls._powers or len(cls._powers[base][0]) < n:
            size = 1 << max(12, (n - 1).bit_length())
            up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            cls._powers[base] = np.cumprod(up), np.cumprod(down)
        return cls._powers[base]

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))

    def windows(self, length: int) -> np.ndarray:
        """The hash of every run of `length` words."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n] + np.uint64(length))


def other_windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A second hash of the same runs, independent of the first."""
    return Runs(mix(hashes + np.uint64(_OTHER)), _OTHER).windows(length)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values
