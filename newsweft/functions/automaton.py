"""Many needles at once: windows of a text whose hash is that of a needle, all windows of a length in a few passes of numpy.

A window's hash comes from prefix sums, whatever its length. Lengths are taken
together by powers of two: a place counts if the window of a class's least length
may begin a needle, and there each length of the class is looked at. What may be
a needle is told by a bitmap, so what is found is a superset: equal text decides.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Places that are hashed at once.
RUN = 1 << 16
#: Texts are set apart by a code that no needle has.
APART = (1 << 21) - 1
#: Bits of the bitmap for each needle, and its sizes as powers of two.
BITS, LEAST, MOST = 64, 16, 28
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
#: What tells a first part from a whole needle, which has two bits.
_FIRST, _WHOLE = (_U(0xD6E8FEB86659FD93),), (_U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25))


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(_U) + _U(1)) * _U(0xBF58476D1CE4E5B9)
    return (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)


def size_of(needles: int) -> int:
    """Bits of a bitmap, as a power of two."""
    return min(MOST, max(LEAST, (BITS * needles - 1).bit_length() if needles else 0))


def classes(lengths: Iterable[int]) -> list[list[int]]:
    """Lengths of needles, those between two powers of two together."""
    out: dict[int, list[int]] = {}
    for n in sorted({x for x in lengths if x}):
        out.setdefault(n.bit_length(), []).append(n)
    return list(out.values())


def _places(h: np.ndarray, kinds: tuple, bits: int) -> list[np.ndarray]:
    return [((h ^ (h >> _U(31))) * k) >> _U(64 - bits) for k in kinds]


def marks(needles: list[str], lengths: list[list[int]], bits: int) -> np.ndarray:
    """The bits to set for needles that aren't empty, three for each, in order."""
    each = [_codes(n) for n in needles]
    if not each:
        return np.zeros(0, np.int64)
    size = np.array([len(x) for x in each])
    least = {n: c[0] for c in lengths for n in c}
    first = np.array([least[n] for n in size.tolist()])
    start = np.cumsum(size) - size
    at = np.arange(size.sum()) - np.repeat(start, size)
    part = _mixed(np.concatenate(each)) * _powers(int(size.max()), _BASE)[at]
    whole = np.add.reduceat(part, start)
    begin = np.add.reduceat(np.where(at < np.repeat(first, size), part, _U(0)), start)
    return np.column_stack([*_places(begin, _FIRST, bits), *_places(whole, _WHOLE, bits)]).astype(np.int64).ravel()


def bitmap(places: np.ndarray, bits: int) -> bytes:
    out = np.zeros(1 << bits, bool)
    out[places] = True
    return np.packbits(out, bitorder="little").tobytes()


class Windows:
    """Windows of texts that may be needles, by their bitmap."""

    def __init__(self, lengths: list[list[int]], bits: int, marked: bytes):
        self.lengths, self.bits, self.marked = lengths, bits, np.frombuffer(marked, np.uint8)
        self.longest = max((c[-1] for c in lengths), default=0)
        self.run = max(RUN, 4 * self.longest)
        self.up = _powers(self.run + self.longest, _BASE)
        self.down = _powers(self.run, pow(_BASE, -1, 1 << 64))

    def _set(self, h: np.ndarray, kinds: tuple) -> np.ndarray:
        hit = np.ones(len(h), bool)
        for p in _places(h, kinds, self.bits):
            hit &= (self.marked[(p >> _U(3)).astype(np.int64)] >> (p & _U(7)).astype(np.uint8)) & 1 > 0
        return hit

    def find(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, place in it, length, hash) of windows, by text; each needle that occurs is among them wherever it does."""
        each = [np.append(_codes(t or ""), APART) for t in texts]
        starts = np.cumsum([0, *map(len, each)])
        codes = np.concatenate([*each, np.zeros(0, np.int64)])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U))]
        for a in range(0, len(codes) if self.lengths else 0, self.run):
            m = _mixed(codes[a : a + self.run + self.longest])
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(m * self.up[: len(m)], dtype=_U)])
            for c in self.lengths:
                n = min(self.run, len(m) - c[0] + 1)
                if n <= 0:
                    continue
                at = np.flatnonzero(self._set((sums[c[0] : c[0] + n] - sums[:n]) * self.down[:n], _FIRST))
                for k in c:
                    at = at[at + k <= len(m)]
                    h = (sums[at + k] - sums[at]) * self.down[at]
                    hit = self._set(h, _WHOLE)
                    found.append((a + at[hit], np.full(hit.sum(), k), h[hit]))
        place, length, h = (np.concatenate(x) for x in zip(*found))
        text = np.searchsorted(starts, place, "right") - 1
        whole = place + length < starts[text + 1] if len(place) else np.zeros(0, bool)
        order = np.flatnonzero(whole)[np.argsort(text[whole], kind="stable")]
        return text[order], place[order] - starts[text[order]], length[order], h[order]


class Automaton:
    """Needles that are looked for together, without Spark."""

    def __init__(self, needles: list[str]):
        self.own = {n: i for i, n in reversed(list(enumerate(needles))) if n}
        lengths, bits = classes(map(len, self.own)), size_of(len(self.own))
        self.windows = Windows(lengths, bits, bitmap(marks(list(self.own), lengths, bits), bits))

    def find(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text, needle) of the distinct needles that occur in each text, in order."""
        pairs = {(t, self.own.get(texts[t][p : p + n], -1)) for t, p, n, _ in zip(*(x.tolist() for x in self.windows.find(texts)))}
        out = np.array(sorted(p for p in pairs if p[1] >= 0), np.int64).reshape(-1, 2)
        return out[:, 0], out[:, 1]
