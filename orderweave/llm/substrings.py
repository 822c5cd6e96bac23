"""Substring dedup by level-wise doubling of repeated word windows.

Candidates are all windows of `window` words. At each length - a quarter, a half,
the whole window - only candidates whose pieces of that length repeat in another
document go on to the doubled length (`repeats.py` says which piece stands for a
window). At the whole length a window is removed from a document if its word
sequence also starts in a document with a smaller id: in an earlier chunk, which
a shard answers, or earlier in the same chunk. That is judged by two hashes with
unrelated seeds, drawn anew for each run, both of which have to be found.

A document whose whole text a document with a smaller id has is all repeated; it and
so its original's share in it stay out of the rounds. Texts are shuffled once, by
chunk; then only packed hashes and bits move.

Defined results: a null text has no words; documents with fewer words than the
window keep all of them; rows of one id are one document for "smaller id", so
repeated rows do not remove each other; rows without an id keep everything and
remove nothing. Repeats within one document stay.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import CHUNK_BYTES, Chunk, answered, answers_of, ask, copies, deal, requests
from .repeats import Keys, Windows, narrowed
from .texts import NOT_SPACE, covered, fresh_seed, sequence_in, sequences_hash, stretches_hash, word_spans

WINDOW = 50
#: Words of text bytes per shard of keys.
_SHARD_BYTES = 32 << 20
#: What tells the second seed from the first.
_OTHER = 0x2545F4914F6CDD1D


def lengths(window: int) -> tuple[int, ...]:
    """The lengths below the window: a quarter and a half of it."""
    half = -(-window // 2)
    return tuple(sorted({-(-half // 2), half} - {window}))


class _Words:
    def __init__(self, rows: pa.Table, given: pa.Table | None, window: int, seed: int):
        self.chunk = chunk = Chunk(rows, given)
        self._seed = seed
        self.starts, self.ends, self.bounds = word_spans(chunk.data, chunk.offsets, NOT_SPACE)
        self.windows = Windows(chunk, self.bounds, self._hashes(seed), window)

    def _hashes(self, seed: int) -> Callable[[int, int, int], np.ndarray]:
        words = stretches_hash(self.chunk.data, self.starts, self.ends, seed)
        return lambda size, start, end: sequences_hash(words[start : end + size - 1], size, seed)

    def whole(self) -> list[Keys]:
        """The keys of the candidates themselves, by both hashes."""
        w = self.windows
        return [Keys(w.least(w.window), w.rank), Keys(w.least(w.window, self._hashes(self._seed ^ _OTHER)), w.rank)]


def removed_words(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words left, joined by one space."""
    dealt = deal(docs, doc_id, text, chunk_bytes)
    shards = max(1, dealt.n_bytes // _SHARD_BYTES)
    below = lengths(window)
    seed = fresh_seed()
    answers: list[DataFrame] = [copies(dealt)]
    for level, size in enumerate(below):

        def send(rows: pa.Table, given: pa.Table | None, level: int = level, size: int = size) -> pa.Table:
            words = _Words(rows, given, window, seed)
            narrowed(words.windows, below[:level], given)
            keys = Keys(words.windows.least(size), words.windows.rank)
            return requests(words.chunk.number, level, shards, keys.distinct)

        answers.append(answered(ask(dealt, answers, send), earlier=False))

    def send_whole(rows: pa.Table, given: pa.Table | None) -> pa.Table:
        words = _Words(rows, given, window, seed)
        narrowed(words.windows, below, given)
        return pa.concat_tables(requests(words.chunk.number, len(below) + k, shards, keys.distinct) for k, keys in enumerate(words.whole()))

    answers.append(answered(ask(dealt, answers, send_whole), earlier=True))

    def cut(rows: pa.Table, given: pa.Table) -> pa.Table:
        words = _Words(rows, given, window, seed)
        narrowed(words.windows, below, given)
        repeated = np.ones(len(words.windows.starts), bool)
        for k, keys in enumerate(words.whole()):
            earlier, of = answers_of(given, len(below) + k), keys.of_windows()
            repeated &= (earlier[of] if len(of) else np.zeros(0, bool)) | (words.windows.rank > keys.first[of])
        gone = words.windows.starts[repeated]
        hit = covered(len(words.starts), gone, gone + window)
        n_words = np.diff(words.bounds)
        return _kept(words, hit | np.repeat(words.chunk.copies & (n_words >= window), n_words))

    return ask(dealt, answers, cut, "doc_id long, n_words long, n_removed long, kept string")


def _kept(words: _Words, hit: np.ndarray) -> pa.Table:
    chunk, n = words.chunk, len(words.bounds) - 1
    owner = sequence_in(words.bounds)
    starts, ends, text = words.starts[~hit], words.ends[~hit], owner[~hit]
    # each kept word and a space after it, then without the last space of a document
    lengths_ = ends - starts + 1
    at = np.arange(lengths_.sum()) - np.repeat(np.cumsum(lengths_) - lengths_, lengths_)
    source = np.repeat(starts, lengths_) + at
    data = np.append(chunk.data, np.uint8(0x20))[np.minimum(source, len(chunk.data))]
    data[np.cumsum(lengths_) - 1] = 0x20
    last = np.flatnonzero(np.r_[text[1:] != text[:-1], True]) if len(text) else np.zeros(0, np.int64)
    keep = np.ones(len(data), bool)
    keep[np.cumsum(lengths_)[last] - 1] = False
    sizes = np.bincount(text, lengths_, minlength=n).astype(np.int64)
    sizes[text[last]] -= 1
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    kept = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[keep])))
    return pa.table(
        {
            "doc_id": chunk.rows["doc_id"],
            "n_words": pa.array(np.diff(words.bounds), pa.int64()),
            "n_removed": pa.array(np.bincount(owner[hit], minlength=n), pa.int64()),
            "kept": kept,
        }
    )
