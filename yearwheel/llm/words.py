"""Words of many texts at once, as byte positions and hashes in numpy.

A word is a run of bytes other than space and the five ASCII controls 0x09-0x0D, as ``bytes.split``
has it. Hashes have 64 bits and depend on the bytes alone, so they mean the same in every task.
"""

from __future__ import annotations

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, 256, dtype=np.uint64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for exponents up to n."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * len(_powers[0]), 1 << 20)
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _powers = made[0], made[1]
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Weighted prefix sums from which :func:`range_hashes` takes any range."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power_tables(len(values))[0][: len(values)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range [begin, end) of the values behind ``sums``, wherever it stands."""
    back = _power_tables(len(sums))[1]
    return mixed((sums[ends] - sums[begins]) * back[begins] + (ends - begins).astype(np.uint64))


class Words:
    """Words of texts laid end to end.

    ``begins`` and ``ends`` are byte positions in ``data``; document d has the words
    ``first[d]:first[d + 1]`` and the bytes ``at[d]:at[d + 1] - 1``.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b" ".join(texts) + b" "
        self.data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
        self.space = SPACES[self.data]
        before = np.concatenate([[True], self.space[:-1]])
        self.begins = np.flatnonzero(before & ~self.space)
        self.ends = np.flatnonzero(self.space & ~before)
        self.first = np.searchsorted(self.begins, self.at)
        self.sums = prefix_sums(_TABLE[self.data])

    def __len__(self) -> int:
        return len(self.begins)

    @property
    def n(self) -> np.ndarray:
        """Number of words of each document."""
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return range_hashes(self.sums, self.begins, self.ends)

    def windows(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``size`` words of one document, and the windows' hashes."""
        last = np.repeat(self.first[1:], self.n) - size
        begins = np.flatnonzero(np.arange(len(self)) <= last)
        return begins, range_hashes(prefix_sums(hashes), begins, begins + size)


def covered(begins: np.ndarray, size: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n words lie in one of the windows that start at ``begins``."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + size, -1)
    return np.cumsum(edges[:-1]) > 0
