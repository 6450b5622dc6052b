"""Vectorised word and shingle hashing on UTF-8 bytes.

A word is a run of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 is the
same as a run of code points other than those. Words are hashed by differences
of prefix sums of a random-table polynomial modulo 2**64, so no Python object is
made per word.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_TABLE_LOWER = _TABLE.copy()
_TABLE_LOWER[65:91] = _TABLE[97:123]
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()

            def powers(base: int) -> np.ndarray:
                out = np.full(size, base & _MASK, np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)

            self.up, self.down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
        return self.up, self.down


_powers = _Powers()


class Words:
    """Words of a list of texts: byte spans in ``data``, hashes, and the number in each text."""

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        texts = [t or b"" for t in texts]
        self.data = b" ".join(texts) + b" "
        buf = np.frombuffer(self.data, np.uint8)
        space = _SPACE[buf]
        before = np.empty_like(space)
        before[0], before[1:] = True, space[:-1]
        self.starts, self.ends = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_starts = np.concatenate([[0], np.cumsum(sizes)])
        self.bounds = np.searchsorted(self.starts, self.text_starts)
        self.counts = np.diff(self.bounds)
        self.hashes = self._hash(buf, _TABLE_LOWER if lower else _TABLE)

    def _hash(self, buf: np.ndarray, table: np.ndarray) -> np.ndarray:
        out, i, n = np.empty(len(self.starts), np.uint64), 0, len(self.starts)
        while i < n:
            at = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, at + SEGMENT, "right")))
            s, e = self.starts[i:j] - at, self.ends[i:j] - at
            up, down = _powers.upto(int(e[-1]) + 1)
            sums = np.zeros(int(e[-1]) + 1, np.uint64)
            np.cumsum(table[buf[at : at + e[-1]]] * up[: e[-1]], out=sums[1:])
            out[i:j] = (sums[e] - sums[s]) * down[s]
            i = j
        return mix(out)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def windows(h: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Hash of each run of ``k`` neighbours of ``h``, by doubling; the mix is left to the caller."""
    out, width, wide, size = None, 0, h, 1
    while size <= k:
        if k & size:
            if out is None:
                out, width = wide, size
            else:
                m = max(0, min(len(wide) - width, len(out)))
                out = out[:m] * U(pow(base, size, 1 << 64)) + wide[width : width + m]
                width += size
        size *= 2
        if size <= k:
            half = size // 2
            m = max(0, len(wide) - half)
            wide = wide[:m] * U(pow(base, half, 1 << 64)) + wide[half : half + m]
    return out


def window_starts(bounds: np.ndarray, k: int) -> np.ndarray:
    """Word positions at which a whole window of ``k`` words starts inside its text."""
    counts = np.diff(bounds)
    inside = np.maximum(counts - k + 1, 0)
    return np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(inside)[:-1]]), inside) + np.arange(inside.sum())


def spread(bounds: np.ndarray) -> np.ndarray:
    """0, 0, .., 1, 1, ..: the text of each position between bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
