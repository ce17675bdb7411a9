"""Encode texts by their distinct parts, and gather ragged arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np


def gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """pool[s : s + n] for every start s and length n, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def slices(texts: list[str | None], most: int) -> Iterator[slice]:
    """Runs of rows with about ``most`` characters together; one longer text is a run of its own."""
    return runs([len(t or "") for t in texts], most)


def runs(sizes: list[int], most: int) -> Iterator[slice]:
    """Runs of rows of about ``most`` together."""
    begin = total = 0
    for k, size in enumerate(sizes):
        total += size
        if total >= most or k == len(sizes) - 1:
            yield slice(begin, k + 1)
            begin, total = k + 1, 0


class DistinctEncoder:
    """Ids of texts whose parts are encoded independently of each other.

    ``split`` takes a text apart, ``encode`` gives the ids of a list of parts. Up to ``most`` parts are
    remembered; beyond that only those of the last texts stay, which changes no result.
    """

    def __init__(self, split: Callable[[str], list], encode: Callable[[list], list], most: int = 300_000):
        self.split, self.encode, self.most = split, encode, most
        # number of each known part, and where its ids stand in the pool
        self.known: dict = {}
        self.pool, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list) -> None:
        ids = self.encode(new)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.starts = np.concatenate([self.starts, np.cumsum(lengths) - lengths + len(self.pool)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))])

    def _forget(self, codes: np.ndarray, parts: list) -> None:
        """Keep the parts of the last texts only."""
        last, at = np.unique(codes, return_index=True)
        self.known = {parts[k]: i for i, k in enumerate(at.tolist())}
        self.pool = gathered(self.pool, self.starts[last], self.lengths[last])
        self.lengths = self.lengths[last]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        split = [self.split(t) if t else [] for t in texts]
        bounds = np.cumsum([0, *map(len, split)])
        parts = list(chain.from_iterable(split))
        codes = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            wanted = [parts[k] for k in missing]
            self._learn(list(dict.fromkeys(wanted)))
            codes[missing] = [self.known[p] for p in wanted]
        of_part = self.lengths[codes]
        ends = np.concatenate([[0], np.cumsum(of_part)])
        ids = gathered(self.pool, self.starts[codes], of_part)
        if len(self.known) > self.most:
            self._forget(codes, parts)
        return ids, np.diff(ends[bounds])
