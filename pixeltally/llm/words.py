"""Words of many texts at once, as numpy arrays: places, hashes and hashes of word runs.

Hashes are 64 bits. Two of them with different seeds make 128 bits where equality is decided.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK_BYTES = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def chunks(texts: Sequence[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``most`` bytes each; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Words:
    """The words of texts: ``first[i]`` to ``first[i + 1]`` are the numbers of text i's words."""

    def __init__(self, texts: Sequence[bytes]):
        self.buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
        inside = IS_WORD[self.buffer].view(np.int8)
        edges = np.diff(inside, prepend=np.int8(0))
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A hash of each word's bytes: a polynomial in an odd number, modulo 2**64, mixed."""
        n = len(self.buffer)
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        base, inverse = _base(seed)
        symbols = _symbols(seed)[self.buffer]
        # A block of powers is enough: each word is brought back to power 0 by the inverse.
        powers = _powers(base, n)
        symbols *= powers
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols, out=total[1:])
        found = total[self.ends] - total[self.starts]
        found *= _powers(inverse, n)[self.starts]
        return mix64(found + (self.ends - self.starts).astype(np.uint64))

    def runs(self, words: np.ndarray, length: int) -> np.ndarray:
        """Hashes of each ``length`` words in a row, by number of the first one. Runs that begin
        less than ``length`` words before a text's end reach into the next text; see ``whole``."""
        n = max(0, len(words) - length + 1)
        found = np.zeros(n, np.uint64)
        for k in range(length):
            found *= _MULTIPLIER
            found += words[k:k + n]
        return mix64(found)

    def whole(self, length: int) -> np.ndarray:
        """For each run of ``runs``: whether it lies within one text."""
        n = max(0, len(self.starts) - length + 1)
        ends = np.repeat(self.first[1:], self.counts)[:n]
        return np.arange(n) + length <= ends

    def text_of(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


_power_tables: dict[int, np.ndarray] = {}


def _base(seed: int) -> tuple[int, int]:
    base = (0x5851F42D4C957F2D + 0x2545F4914F6CDD1E * 2 * seed) % 2**64 | 1
    return base, pow(base, -1, 2**64)


def _symbols(seed: int) -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1) * _MULTIPLIER)


def _powers(base: int, n: int) -> np.ndarray:
    found = _power_tables.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, CHUNK_BYTES * 5 // 4), base, np.uint64)
        found[0] = 1
        found = np.cumprod(found)
        if len(found) <= 16 * CHUNK_BYTES:  # what a very long text needs isn't kept
            _power_tables[base] = found
    return found[:n]
