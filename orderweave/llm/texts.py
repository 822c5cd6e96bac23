"""Whole batches of texts as flat byte arrays: words, substring hashes, packed rows.

All functions work on one slice of an Arrow batch at a time (`slices`), so a
task's memory is bounded by the slice size or by its longest single text.

Two families of hashes: `stretches_hash` and `sequences_hash` decide what is equal. They
chain bijective mixes of eight bytes, or of the hashes of two parts, under a seed that a
run draws (`fresh_seed`); callers that delete or link by them take two, with unrelated
seeds. `spans_hash` and `windows_hash` take any stretch from prefix sums modulo 2**64;
different texts can be built that they do not tell apart, so they only choose candidates.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
#: Values worked on at a time where an array is passed over again and again.
CACHED = 1 << 15

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_GOLDEN = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes inside the closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of a word: all but space and \t..\r.
NOT_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of a word once A-Z is lower-cased: digits, a-z and everything beyond ASCII.
ALPHANUMERIC = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds at most `limit` text bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): word i is data[starts[i]:ends[i]]; text t has words bounds[t]:bounds[t+1]."""
    inside = table[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class _Powers:
    """Powers of an odd number modulo 2**64: a small table of low exponents times one of high ones."""

    def __init__(self, base: int):
        self._low = self._table(base, CACHED)
        self._base = pow(base, CACHED, 1 << 64)
        self._high = self._table(self._base, 64)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        table = np.full(n, base, np.uint64)
        table[0] = 1
        return np.cumprod(table, dtype=np.uint64)

    def _reach(self, exponent: int) -> np.ndarray:
        if exponent // CACHED >= len(self._high):
            self._high = self._table(self._base, 2 * (exponent // CACHED + 1))
        return self._high

    def at(self, exponents: np.ndarray) -> np.ndarray:
        high = self._reach(int(exponents.max()) if len(exponents) else 0)
        return high[exponents // CACHED] * self._low[exponents % CACHED]

    def between(self, start: int, end: int) -> np.ndarray:
        first, last = start // CACHED, (end - 1) // CACHED
        found = (self._reach(end)[first : last + 1, None] * self._low[None, :]).ravel()
        return found[start - first * CACHED : end - first * CACHED]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which `spans_hash` takes the hash of any stretch; values are uint64."""
    return _summed(len(values), lambda start, end: values[start:end])


def byte_sums(data: np.ndarray) -> np.ndarray:
    return _summed(len(data), lambda start, end: _GOLDEN[data[start:end]])


def _summed(n: int, values: Callable[[int, int], np.ndarray]) -> np.ndarray:
    sums = np.zeros(n + 1, np.uint64)
    for start in range(0, n, CACHED):
        end = min(start + CACHED, n)
        part = values(start, end) * _POWERS.between(start, end)
        part[:1] += sums[start : start + 1]
        np.cumsum(part, out=sums[start + 1 : end + 1])
    return sums


def spans_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches starts:ends; equal stretches get equal hashes wherever they are."""
    return mix((sums[ends] - sums[starts]) * _INVERSES.at(starts))


def windows_hash(sums: np.ndarray, size: int, start: int = 0, end: int | None = None) -> np.ndarray:
    """Hashes of all stretches of `size` consecutive values that begin in start:end."""
    end = len(sums) - size if end is None else end
    if end <= start:
        return np.zeros(0, np.uint64)
    return mix((sums[start + size : end + size] - sums[start:end]) * _INVERSES.between(start, end))


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_INVERSE)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xA0761D6478BD642F)
    values ^= values >> np.uint64(32)
    return values


def fresh_seed() -> int:
    """A seed that no text can be prepared for; drawn once and sent to all tasks of a run."""
    return secrets.randbits(63)


#: Stretches longer than this are hashed one by one.
_CHAINED = 128
_TAILS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [_MASK], np.uint64)


def _seeded(seed: int, number: int) -> np.uint64:
    return np.uint64((seed * 0x9E3779B97F4A7C15 + number * 0xD6E8FEB86659FD93 + 0xA0761D6478BD642F) & _MASK)


def stretches_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the stretches starts:ends of the bytes: eight bytes at a time, each chained by a mix."""
    lengths = ends - starts
    found = mix(lengths.astype(np.uint64) * _seeded(seed, 1) + _seeded(seed, 2))
    if not len(starts):
        return found
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    words = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    short = int(min(lengths.max(), _CHAINED))
    which = np.flatnonzero((lengths > 0) & (lengths <= _CHAINED))
    for at in range(0, short, 8):
        if at:
            which = which[lengths[which] > at]
        block = words[starts[which] + at] & _TAILS[np.minimum(lengths[which] - at, 8)]
        found[which] = mix((found[which] ^ block) + _seeded(seed, 3))
    long = np.flatnonzero(lengths > _CHAINED)
    if len(long):
        view, key = memoryview(np.ascontiguousarray(data)), seed.to_bytes(8, "little")
        digests = [hashlib.blake2b(view[a:b], digest_size=8, key=key).digest() for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        found[long] = np.frombuffer(b"".join(digests), np.uint64)
    return found


def sequences_hash(values: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of all stretches of `size` consecutive 64-bit values: of two halves, which may overlap, and so on."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    found, have = mix(values ^ _seeded(seed, 4)), 1
    while have < size:
        step = min(have, size - have)
        found = mix(found[:-step] * _seeded(seed, 2 * step + 5) + (found[step:] ^ (found[step:] >> np.uint64(31))))
        have += step
    return mix(found + np.uint64(size))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True at the positions of 0..n-1 that some stretch starts:ends covers."""
    edges = np.bincount(starts, minlength=n + 1).astype(np.int64) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


def kept_texts(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes where `keep` holds, and their offsets."""
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=sums[1:])
    return data[keep], sums[offsets]


def sequence_in(bounds: np.ndarray) -> np.ndarray:
    """For rows bounds[t]:bounds[t+1] of text t: the text's index, row by row."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def equal_stretches(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray
) -> np.ndarray:
    """Whether data[starts:ends] and other[other_starts:other_ends] hold the same bytes, pair by pair."""
    lengths = ends - starts
    equal = lengths == other_ends - other_starts
    which = np.flatnonzero(equal)
    n = lengths[which]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    differs = data[np.repeat(starts[which], n) + step] != other[np.repeat(other_starts[which], n) + step]
    equal[np.repeat(which, n)[differs]] = False
    return equal
