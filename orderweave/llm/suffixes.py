"""Suffix-array dedup: removes byte stretches that also start in a document with a smaller id.

A document whose whole text a document with a smaller id has is all repeated. All other
documents' windows of `window` bytes are candidates. Those whose least piece of `PIECE`
bytes is in one document alone are dropped (`repeats.py`). What is left is cut into
stretches of neighbouring windows that share their least `ANCHOR`-byte piece; that
piece sends the stretch to a shard, so that equal windows meet there, whatever
surrounds them. A chunk sends each distinct stretch once.

A shard sorts the suffixes of its distinct stretches block by block, takes the
Burrows-Wheeler transform and expands intervals breadth-first: an interval of rows
that share a prefix is extended backward by one symbol, which parts neighbouring rows
in order of increasing common prefix. It stops at `window` symbols; rows not parted
by then start with the same window. The smallest id among them decides.

Defined results: a null text is empty; texts shorter than the window stay whole;
rows of one id are one document for "smaller id"; rows without an id stay whole and
remove nothing. Repeats within one document stay. A removal may cut a character in
two, so what is kept is bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import Chunk, answered, answers_of, ask, copies, deal, released, requests
from .repeats import Keys, Windows, narrowed
from .texts import byte_sums, covered, flat, fresh_seed, mix, sequence_in, stretches_hash, windows_hash

WINDOW = 50
PIECE = 32
ANCHOR = 16
CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 19
_SHARD_BYTES = 16 << 20
_STRETCHES = "shard long, chunk long, level int, anchors binary, lengths binary, ids binary, bytes binary"
_ANSWER = "chunk long, level int, shard long, n long, bits binary"


def transform(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, BWT) of a cyclic text of 9-bit symbols: rotations sorted by at least `depth` symbols."""
    n = len(symbols)
    key = np.zeros(n, np.int64)
    wide = np.resize(symbols, n + 6).astype(np.int64)
    for k in range(7):
        key = (key << 9) | wide[k : k + n]
    have = 7
    while True:
        rows = np.argsort(key)
        if have >= depth:
            return rows, symbols[rows - 1]
        ordered = key[rows]
        rank = np.empty(n, np.int64)
        rank[rows] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        key = (rank << 32) | np.roll(rank, -have)
        have *= 2


def intervals(bwt: np.ndarray, depth: int) -> np.ndarray:
    """By row: the number of its interval of rows that share `depth` symbols.

    Row j begins with the j-th smallest symbol; what follows is row `back[j]`.
    Neighbours with the same first symbol are parted at the next depth when their
    continuations were parted before.
    """
    back = np.argsort(bwt, kind="stable").astype(np.int32)
    first = bwt[back]
    parted = np.r_[True, first[1:] != first[:-1]]
    open_ = np.flatnonzero(~parted)
    for _ in range(depth - 1):
        if not len(open_):
            break
        number = np.cumsum(parted, dtype=np.int32)
        apart = number[back[open_ - 1]] != number[back[open_]]
        parted[open_[apart]] = True
        open_ = open_[~apart]
    return np.cumsum(parted) - 1


def least_ids(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, window: int) -> np.ndarray:
    """By position of the stretches: the least id of a stretch in which the window at the position occurs.

    Only positions at which a whole window of one stretch begins count.
    """
    n = len(offsets) - 1
    symbols = np.zeros(len(data) + n, np.int16)  # 0 parts the stretches
    owner = sequence_in(offsets)
    symbols[np.arange(len(data)) + owner] = data.astype(np.int16) + 1
    rows, bwt = transform(symbols, window)
    interval = intervals(bwt, window)
    id_of = np.full(len(symbols), np.iinfo(np.int64).max)
    id_of[np.arange(len(data)) + owner] = ids[owner]
    least = np.full(interval[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, interval, id_of[rows])
    found = np.empty(len(symbols), np.int64)
    found[rows] = least[interval]
    return found[np.arange(len(data)) + owner]


class _Bytes:
    """A chunk's candidate windows, cut into stretches."""

    def __init__(self, rows: pa.Table, given: pa.Table, window: int):
        self.chunk = Chunk(rows, given)
        sums = byte_sums(self.chunk.data)
        self.windows = Windows(self.chunk, self.chunk.offsets, lambda size, start, end: windows_hash(sums, size, start, end), window)
        self.window = window

    def stretches(self, shards: int, seed: int) -> None:
        """Distinct stretches, by shard and then in ascending order of a hash of anchor and content."""
        w, chunk = self.windows, self.chunk
        anchor = w.least(ANCHOR)
        new = np.r_[True, (np.diff(w.starts) != 1) | (anchor[1:] != anchor[:-1]) | (w.rank[1:] != w.rank[:-1])] if len(anchor) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(anchor)] - 1 if len(first) else first
        begin, end, rank, anchor = w.starts[first], w.starts[last] + self.window, w.rank[first], anchor[first]
        key = mix(stretches_hash(chunk.data, begin, end, seed) + mix(anchor))
        order = np.argsort(key)
        ordered = key[order]
        heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(key) else first
        shard = (anchor[order[heads]] >> np.uint64(32)).astype(np.int64) * shards >> 32
        by_shard = np.argsort(shard, kind="stable")
        place = np.empty(len(heads), np.int64)
        place[by_shard] = np.arange(len(heads))
        self.run = np.cumsum(new) - 1  # by window: its stretch
        self.first_window = first
        self.kind = np.empty(len(key), np.int64)  # by stretch: its distinct stretch
        self.kind[order] = np.repeat(place, np.diff(np.r_[heads, len(key)]))
        chosen = order[heads][by_shard]
        self.shard, self.anchor, self.begin, self.end = shard[by_shard], anchor[chosen], begin[chosen], end[chosen]
        self.least_rank = np.minimum.reduceat(rank[order], heads)[by_shard] if len(key) else rank
        position = np.searchsorted(chunk.rank[: int((chunk.rank >= 0).sum())], self.least_rank)
        self.least_id = chunk.ids[position]

    def request(self, level: int, shards: int) -> pa.Table:
        cuts = np.searchsorted(self.shard, np.arange(shards))
        ends = np.r_[cuts[1:], len(self.anchor)]
        rows: dict[str, list] = {k: [] for k in ("shard", "chunk", "level", "anchors", "lengths", "ids", "bytes")}
        for shard in np.flatnonzero(ends > cuts).tolist():
            a, b = cuts[shard], ends[shard]
            lengths = self.end[a:b] - self.begin[a:b]
            at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(self.begin[a:b], lengths)
            packed = (self.anchor[a:b], lengths.astype(np.int32), self.least_id[a:b], self.chunk.data[at])
            values = (shard, self.chunk.number, level, *(x.tobytes() for x in packed))
            for column, value in zip(rows.values(), values, strict=True):
                column.append(value)
        types = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], names=list(rows))


def _decide(rows: pa.Table, window: int, seed: int) -> pa.Table:
    """For each window of each stretch a bit: does it occur in a document with a smaller id?"""
    rows = rows.sort_by("chunk")
    unpacked = {c: flat(rows[c]) for c in ("anchors", "lengths", "ids", "bytes")}
    anchors = np.frombuffer(unpacked["anchors"][0].tobytes(), np.uint64)
    lengths = np.frombuffer(unpacked["lengths"][0].tobytes(), np.int32).astype(np.int64)
    ids = np.frombuffer(unpacked["ids"][0].tobytes(), np.int64)
    data = unpacked["bytes"][0]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    # distinct stretches, each with its least id
    key = mix(stretches_hash(data, offsets[:-1], offsets[1:], seed) + mix(anchors))
    order = np.argsort(key)
    ordered = key[order]
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    by_anchor = np.argsort(anchors[order[heads]])
    place = np.empty(len(heads), np.int64)
    place[by_anchor] = np.arange(len(heads))
    kind = np.empty(len(order), np.int64)
    kind[order] = np.repeat(place, np.diff(np.r_[heads, len(order)]))
    chosen = order[heads][by_anchor]
    least_of = np.minimum.reduceat(ids[order], heads)[by_anchor]
    # blocks of whole anchors
    sizes = lengths[chosen]
    new_anchor = np.flatnonzero(np.r_[True, anchors[chosen][1:] != anchors[chosen][:-1]])
    before = np.concatenate([[0], np.cumsum(sizes)])
    starts = np.flatnonzero(np.r_[True, np.diff(before[new_anchor] // BLOCK_BYTES) > 0])
    cuts = np.r_[new_anchor[starts], len(chosen)]
    least = np.empty(before[-1], np.int64)
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        n = sizes[low:high]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[chosen[low:high]], n)
        least[before[low] : before[high]] = least_ids(data[at], np.concatenate([[0], np.cumsum(n)]), least_of[low:high], window)
    # a bit for each window of each stretch as sent
    n = lengths - window + 1
    of_window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(before[kind], n)
    bit = least[of_window] < np.repeat(ids, n)
    ends = np.concatenate([[0], np.cumsum(n)])[unpacked["anchors"][1] // 8]
    bits = [np.packbits(bit[x:y]).tobytes() for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return pa.table({"chunk": rows["chunk"], "level": rows["level"], "shard": rows["shard"], "n": pa.array(np.diff(ends), pa.int64()), "bits": pa.array(bits, pa.binary())})


def removed_bytes(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes left of each text."""
    dealt = deal(docs, doc_id, text, chunk_bytes)
    shards = max(1, dealt.n_bytes // _SHARD_BYTES)
    piece, seed = min(PIECE, window), fresh_seed()

    def send(rows: pa.Table, given: pa.Table) -> pa.Table:
        own = _Bytes(rows, given, window)
        return requests(own.chunk.number, 0, shards, Keys(own.windows.least(piece), own.windows.rank).distinct)

    known = [copies(dealt)]
    known.append(answered(ask(dealt, known, send), earlier=False))

    def send_stretches(rows: pa.Table, given: pa.Table) -> pa.Table:
        own = _Bytes(rows, given, window)
        narrowed(own.windows, (piece,), given)
        own.stretches(shards, seed)
        return own.request(1, shards)

    asked = ask(dealt, known, send_stretches, _STRETCHES)
    decided = asked.groupBy("shard").applyInArrow(lambda rows: released(_decide(rows, window, seed)), _ANSWER)

    def cut(rows: pa.Table, given: pa.Table) -> pa.Table:
        own = _Bytes(rows, given, window)
        narrowed(own.windows, (piece,), given)
        own.stretches(shards, seed)
        w, bits = own.windows, answers_of(given, 1)
        n = own.end - own.begin - window + 1
        of_run = own.kind[own.run] if len(own.run) else own.run
        at = (np.cumsum(n) - n)[of_run] + np.arange(len(w.starts)) - own.first_window[own.run] if len(own.run) else own.run
        gone = w.starts[(bits[at] if len(at) else np.zeros(0, bool)) | (w.rank > own.least_rank[of_run])]
        sizes = np.diff(own.chunk.offsets)
        return _kept(own.chunk, covered(len(own.chunk.data), gone, gone + window) | np.repeat(own.chunk.copies & (sizes >= window), sizes))

    return ask(dealt, [*known, decided], cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _kept(chunk: Chunk, hit: np.ndarray) -> pa.Table:
    sums = np.concatenate([[0], np.cumsum(hit)])
    begins = hit & ~np.r_[False, hit[:-1]] if len(hit) else hit
    at = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
    begins[at] = hit[at]
    spans = np.concatenate([[0], np.cumsum(begins)])
    removed = sums[chunk.offsets[1:]] - sums[chunk.offsets[:-1]]
    sizes = np.diff(chunk.offsets)
    offsets = np.concatenate([[0], np.cumsum(sizes - removed)]).astype(np.int32)
    kept = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(chunk.data[~hit]))])
    return pa.table(
        {
            "doc_id": chunk.rows["doc_id"],
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans[chunk.offsets[1:]] - spans[chunk.offsets[:-1]], pa.int64()),
            "kept": kept,
        }
    )
