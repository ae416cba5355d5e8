"""Rolling 64-bit hashes of words and bytes, a whole chunk at a time."""

from __future__ import annotations

import numpy as np

from gridloom.llm.common import SPACE

_A, _B = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads each value over 64 bits; one to one."""
    x = x ^ np.uint64(salt * _A & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _A) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of an odd base modulo 2**64, and their inverses."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(18, (n - 1).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            k = 1
            while k < size:
                p[k : 2 * k] = p[:k] * np.uint64(pow(b, k, 1 << 64))
                k *= 2
            pair.append(p)
        have = (pair[0], pair[1])
        if size <= 1 << 21:
            _powers[base] = have
    return have[0][:n], have[1][:n]


class Rolling:
    """Hashes of any run of a chunk's units, whichever place it has."""

    def __init__(self, units: np.ndarray, base: int = _A) -> None:
        n = len(units)
        up, self.down = powers(n + 1, base)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(units * up[:n], out=self.sums[1:])
        self.n = n

    def every(self, length: int) -> np.ndarray:
        """Of the run of this length at each place where it fits."""
        k = max(0, self.n + 1 - length)
        return (self.sums[length : length + k] - self.sums[:k]) * self.down[:k]

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the runs from start up to end."""
        return (self.sums[end] - self.sums[start]) * self.down[start]


def second(units: np.ndarray) -> Rolling:
    """Hashes independent of those of Rolling(units)."""
    return Rolling(mix(units, 77), _B)


def byte_units(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in some documents' bytes, and the words before each document."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word, in pieces so that the sums stay small."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), 1 << 16):
        s, e = starts[i : i + (1 << 16)], ends[i : i + (1 << 16)]
        roll = Rolling(_BYTE[data[s[0] : e[-1]]])
        out[i : i + len(s)] = mix(roll.at(s - s[0], e - s[0]) + (e - s).astype(np.uint64))
    return out
