"""Elias-Fano sequences and a two-level n-gram trie in memory-mapped arrays."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: By byte and k: the place of its k-th one, counted from the highest bit.
_PLACE = np.array([([p for p in range(8) if byte >> (7 - p) & 1] + [0] * 8)[:8] for byte in range(256)], np.uint8)


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays, read back from one memory-mapped file that vanishes with them."""
    starts, at = [], 0
    with tempfile.TemporaryFile() as file:
        for array in arrays:
            starts.append(at)
            file.write(array.tobytes() + bytes(-array.nbytes % 8))
            at += array.nbytes + -array.nbytes % 8
        file.write(bytes(8))
        file.flush()
        region = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    return [np.frombuffer(region, a.dtype, len(a), start) for a, start in zip(arrays, starts, strict=True)]


class EliasFano:
    """A monotone sequence: low bits in a plain array, high parts in unary.

    Element i sets bit (value >> shift) + i, so the zeros count high parts and the
    ones count elements. Directories of ones per byte block answer both selects.
    """

    def __init__(self, values: np.ndarray):
        self.n = n = len(values)
        top = int(values[-1]) if n else 0
        self.shift = max(0, (top // max(n, 1)).bit_length() - 1)
        low = values & ((1 << self.shift) - 1)
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if self.shift <= 8 * np.dtype(t).itemsize)
        bits = np.zeros(((top >> self.shift) + n + 8) // 8 * 8 + 8, np.uint8)
        bits[(values >> self.shift) + np.arange(n)] = 1
        packed = np.packbits(bits)
        ones = np.concatenate([[0], np.cumsum(_POPCOUNT[packed], dtype=np.int64)])
        self.low, self._bits, self._ones = mapped([low.astype(kind), packed, ones])
        self._zeros = 8 * np.arange(len(ones)) - self._ones

    def _select(self, counts: np.ndarray, wanted: np.ndarray, bit: int) -> np.ndarray:
        """Positions of the wanted-th (from 0) bits of a kind."""
        block = np.searchsorted(counts, wanted, "right") - 1
        byte = self._bits[block] if bit else ~self._bits[block]
        return 8 * block + _PLACE[byte, wanted - counts[block]]

    def get(self, index: np.ndarray) -> np.ndarray:
        """The elements at the indexes."""
        high = self._select(self._ones, index, 1) - index
        return (high << self.shift) | self.low[index].astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The indexes of the values, -1 where absent."""
        found = np.full(len(values), -1, np.int64)
        if not self.n:
            return found
        high = values >> self.shift
        inside = np.flatnonzero(high < self._zeros[-1])
        high, low = high[inside], values[inside] & ((1 << self.shift) - 1)
        # elements with that high part lie between the zero before and the zero after
        end = self._select(self._zeros, high, 0) - high
        before = np.maximum(high - 1, 0)
        at = np.where(high > 0, self._select(self._zeros, before, 0) - before, 0)
        while len(inside):
            open_ = at < end
            inside, low, at, end = inside[open_], low[open_], at[open_], end[open_]
            hit = self.low[at] == low
            found[inside[hit]] = at[hit]
            inside, low, at, end = inside[~hit], low[~hit], at[~hit] + 1, end[~hit]
        return found


class Trie:
    """Contexts, and behind each its successors with quantised probabilities.

    A context's range of successors comes from monotone pointers. Successors are
    numbered within the trie; adding a base that grows from context to context makes
    the whole level monotone, and a search for (base of context + successor) finds it.
    """

    #: Codes are steps of 1/32 of a decimal order; 0 means absent.
    STEPS = 32

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, counts: np.ndarray):
        """Rows (context, successor, count > 0), ascending and distinct."""
        new = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(contexts) else np.zeros(0, np.int64)
        names = np.sort(successors)
        names = names[np.r_[True, names[1:] != names[:-1]]] if len(names) else names
        totals = np.add.reduceat(counts, new) if len(new) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[new, len(contexts)])
        share = np.log10(counts / np.repeat(totals, sizes)) if len(counts) else np.zeros(0)
        codes = np.clip(255 + np.rint(share * self.STEPS), 1, 255).astype(np.uint8)
        self.width = max(len(names), 1)
        place = np.searchsorted(names, successors)
        self.pointers = EliasFano(np.r_[new, len(contexts)].astype(np.int64))
        self.level = EliasFano(np.repeat(np.arange(len(new)), sizes) * self.width + place)
        self.contexts, self.names, self.codes, self.totals = mapped([contexts[new], names, codes, totals.astype(np.int64)])

    def context(self, contexts: np.ndarray) -> np.ndarray:
        """The numbers of the contexts, -1 where absent."""
        if not len(self.contexts):
            return np.full(len(contexts), -1, np.int64)
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        return np.where(self.contexts[at] == contexts, at, -1)

    def total(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers >= 0, self.totals[numbers], 0) if len(self.totals) else np.zeros(len(numbers), np.int64)

    def successor(self, numbers: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of the successors behind contexts of these numbers."""
        codes = np.zeros(len(numbers), np.uint8)
        if not len(self.names):
            return codes
        order = np.argsort(successors)  # neighbours in the search are neighbours in memory
        place = np.empty(len(order), np.int64)
        place[order] = np.searchsorted(self.names, successors[order])
        place = np.minimum(place, len(self.names) - 1)
        known = np.flatnonzero((numbers >= 0) & (self.names[place] == successors))
        found = self.level.find(numbers[known] * self.width + place[known])
        codes[known[found >= 0]] = self.codes[found[found >= 0]]
        return codes

    def fan_out(self) -> np.ndarray:
        """How many successors each context has."""
        return np.diff(self.pointers.get(np.arange(len(self.contexts) + 1)))

    @classmethod
    def share(cls, codes: np.ndarray) -> np.ndarray:
        """What the codes stand for: the successor's share of its context."""
        return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 255) / cls.STEPS), 0.0)
