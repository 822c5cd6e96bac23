"""Windows of a sequence whose pieces repeat in other documents, level by level.

A window of `window` values is represented at a level by the least hash among its
pieces of that many values. Equal windows have equal least pieces, so a window
that occurs in two documents has a repeated piece at every level; a window whose
least piece is found in one document alone is dropped. Neighbouring windows share
their least piece, which keeps the keys few. A hash shared by two different pieces
keeps a candidate too many and drops none.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .chunks import Chunk, answers_of
from .texts import CACHED, mix


def sliding(values: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """The least of each `width` consecutive values."""
    step = 1
    while 2 * step <= width:
        values = best(values[:-step], values[step:])
        step *= 2
    if step < width:
        values = best(values[: len(values) - (width - step)], values[width - step :])
    return values


class Windows:
    """The windows of a chunk that are still candidates; none of its exact copies.

    `bounds`: where each document's values begin; `hashes` of the pieces of a size that
    begin at the values start:end.
    """

    def __init__(self, chunk: Chunk, bounds: np.ndarray, hashes: Callable[[int, int, int], np.ndarray], window: int):
        self.chunk, self.hashes, self.window = chunk, hashes, window
        n = np.where((chunk.rank >= 0) & ~chunk.copies, np.maximum(np.diff(bounds) - window + 1, 0), 0)
        self.starts = np.arange(n.sum()) + np.repeat(bounds[:-1] - (np.cumsum(n) - n), n)
        self.rank = np.repeat(chunk.rank.astype(np.int32), n)

    def least(self, size: int, hashes: Callable[[int, int, int], np.ndarray] | None = None) -> np.ndarray:
        """The least hash of the pieces of `size` values in each candidate window."""
        hashes = hashes or self.hashes
        found, width = np.empty(len(self.starts), np.uint64), self.window - size + 1
        at = 0
        while at < len(self.starts):  # a cache's worth of values at a time
            low = int(self.starts[at])
            end = int(np.searchsorted(self.starts, low + CACHED))
            pieces = hashes(size, low, int(self.starts[end - 1]) + width)
            found[at:end] = sliding(pieces, width)[self.starts[at:end] - low]
            at = end
        return mix(found + np.uint64(size))  # least hashes crowd at the bottom of the key space

    def keep(self, which: np.ndarray) -> None:
        self.starts, self.rank = self.starts[which], self.rank[which]


class Keys:
    """Distinct keys of candidate windows, ascending, and in which documents they are."""

    def __init__(self, keys: np.ndarray, rank: np.ndarray):
        changes = np.r_[True, (keys[1:] != keys[:-1]) | (rank[1:] != rank[:-1])] if len(keys) else np.zeros(0, bool)
        self._run = np.cumsum(changes) - 1  # by window
        keys, rank = keys[changes], rank[changes]
        order = np.argsort(keys)
        ordered = keys[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]] if len(keys) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        self.distinct = ordered[starts]
        self._of_run = np.empty(len(keys), np.int64)
        self._of_run[order] = np.cumsum(new) - 1
        rank = rank[order]
        self.first = np.minimum.reduceat(rank, starts) if len(keys) else rank  # smallest rank of each key
        last = np.maximum.reduceat(rank, starts) if len(keys) else rank
        self.shared = self.first != last  # by two documents of this chunk

    def of_windows(self) -> np.ndarray:
        """By window: the index of its key."""
        return self._of_run[self._run]


def narrowed(windows: Windows, levels: tuple[int, ...], answers: pa.Table | None) -> None:
    """Keep the candidates whose least pieces of the given sizes repeat in other documents."""
    for level, size in enumerate(levels):
        keys = Keys(windows.least(size), windows.rank)
        repeated = keys.shared | answers_of(answers, level)
        windows.keep(repeated[keys.of_windows()])
