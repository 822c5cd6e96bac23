"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items: `window` consecutive words, or
the whole item where it has fewer. The alphabet is words, and patterns of one
length are searched together. A block is the last two words at a position (one
for patterns of one word); the shift table says how far the search may move on
from a block without skipping an occurrence. Where it says 0, the window's hash
selects the bucket of patterns it may be, and a comparison of the bytes confirms
the occurrence. Many stretches of documents are searched in step.

The tables are broadcast. They hold at most `TABLE_BYTES` of benchmark text; a
larger benchmark is searched part by part, each part in a further pass.

Defined results: a null or wordless text has no words and no hits; items with a
null id or without words are ignored; repeated items count once; documents are
judged row by row, so repeated rows and null ids get their own rows. An empty
benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark import filter_texts, map_texts, text_bytes, written
from .texts import (
    ALPHANUMERIC,
    covered,
    equal_stretches,
    flat,
    lower_ascii,
    prefix_sums,
    sequence_in,
    spans_hash,
    byte_sums,
    windows_hash,
    word_spans,
)

WINDOW = 10
TABLE_BYTES = 16 << 20
_SHIFT_BITS = 18
_SEGMENT = 512


@dataclass
class Words:
    """The words of a slice of texts."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Words:
        data, offsets = flat(column)
        data = lower_ascii(data)
        starts, ends, bounds = word_spans(data, offsets, ALPHANUMERIC)
        return Words(data, starts, ends, bounds, prefix_sums(spans_hash(byte_sums(data), starts, ends)))

    def blocks(self, size: int) -> np.ndarray:
        """Shift-table slots of the blocks of `size` words, by their last word."""
        slots = np.zeros(len(self.starts), np.int64)
        slots[size - 1 :] = windows_hash(self.sums, size) >> np.uint64(64 - _SHIFT_BITS)
        return slots


@dataclass
class Patterns:
    """The patterns of one length: shift table, hash buckets, words, items."""

    size: int
    block: int
    shift: np.ndarray
    hashes: np.ndarray  # ascending
    first_word: np.ndarray  # by pattern: index of its first word in `words`
    words: Words
    item_bounds: np.ndarray
    items: np.ndarray

    @staticmethod
    def build(size: int, words: Words, first: np.ndarray, item: np.ndarray) -> Patterns:
        block = min(2, size)
        distinct: dict[bytes, tuple[int, set[int]]] = {}
        for start, owner in zip(first.tolist(), item.tolist(), strict=True):
            text = b" ".join(words.data[words.starts[i] : words.ends[i]].tobytes() for i in range(start, start + size))
            distinct.setdefault(text, (start, set()))[1].add(owner)
        first = np.array([x[0] for x in distinct.values()], np.int64)
        owners = [sorted(x[1]) for x in distinct.values()]
        hashes = spans_hash(words.sums, first, first + size)
        order = np.argsort(hashes, kind="stable")
        shift = np.full(1 << _SHIFT_BITS, size - block + 1, np.int64)
        slots = words.blocks(block)
        for last in range(block - 1, size):
            np.minimum.at(shift, slots[first + last], size - 1 - last)
        owners = [owners[i] for i in order]
        bounds = np.cumsum([0, *map(len, owners)])
        return Patterns(size, block, shift, hashes[order], first[order], words, bounds, np.array(sum(owners, []), np.int64))

    def occurrences(self, text: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of each occurrence."""
        lengths = np.maximum(np.diff(text.bounds) - self.size + 1, 0)
        count = -(-lengths // _SEGMENT)
        owner = np.repeat(np.arange(len(count)), count)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        cursor = text.bounds[owner] + self.size - 1 + rank * _SEGMENT
        limit = np.minimum(cursor + _SEGMENT, text.bounds[owner + 1])
        slots, found = text.blocks(self.block), []
        while len(cursor):
            shift = self.shift[slots[cursor]]
            found.append(cursor[shift == 0])
            cursor = cursor + np.maximum(shift, 1)
            going = cursor < limit
            cursor, limit = cursor[going], limit[going]
        first = (np.concatenate(found) if found else np.zeros(0, np.int64)) - self.size + 1
        hashes = spans_hash(text.sums, first, first + self.size)
        bucket = np.searchsorted(self.hashes, hashes)
        starts, patterns = [], []
        for step in range(len(self.hashes)):  # as many steps as a bucket has patterns: mostly one
            at = np.minimum(bucket + step, len(self.hashes) - 1)
            same = (bucket + step < len(self.hashes)) & (self.hashes[at] == hashes)
            if not same.any():
                break
            equal = self._equal(text, first[same], at[same])
            starts.append(first[same][equal])
            patterns.append(at[same][equal])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(patterns)

    def _equal(self, text: Words, first: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        """Compare the words byte by byte."""
        equal = np.ones(len(first), bool)
        for k in range(self.size):
            a, b = first + k, self.first_word[pattern] + k
            equal &= equal_stretches(text.data, text.starts[a], text.ends[a], self.words.data, self.words.starts[b], self.words.ends[b])
        return equal


def build_tables(item_ids: list[str], texts: list[str], window: int = WINDOW) -> list[Patterns]:
    """Pattern tables of the items, one for each pattern length."""
    words = Words.of(pa.array(texts, pa.large_string()))
    counts = np.diff(words.bounds)
    sizes = np.minimum(counts, window)
    tables = []
    for size in np.unique(sizes[sizes > 0]).tolist():
        items = np.flatnonzero(sizes == size)
        n = counts[items] - size + 1
        item = np.repeat(items, n)
        first = words.bounds[item] + np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
        tables.append(Patterns.build(size, words, first, item))
    return tables


def _parts(benchmark: DataFrame, item: str, text: str, table_bytes: int) -> Iterator[tuple[bool, tuple[list[str], list[str]]]]:
    """(is it the last one, (ids as text, texts)): items by parts of bounded size, of which the driver holds one at a time."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where("item is not null and text is not null")
    total = text_bytes(items)
    parts = max(1, -(-2 * total // table_bytes)) if total > table_bytes else 1
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k).collect()
        yield k == parts - 1, ([r["item"] for r in rows], [r["text"] for r in rows])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """(doc_id, n_words, hits, items): per row the hit word ranges as (first, end) pairs and the ids of items found."""
    spark = docs.sparkSession
    frame, state = docs.select(doc_id, text), ()
    for k, (last, part) in enumerate(_parts(benchmark, item_id, text, table_bytes)):
        shared = spark.sparkContext.broadcast((part, window))
        frame = map_texts(frame, _search(shared, text), "n_words long, hits array<long>, items array<string>", (doc_id, *(() if last else (text,)), *state), text)
        if not last:
            frame, state = written(frame.withColumnsRenamed({c: f"_{c}{k}" for c in ("n_words", "hits", "items")})), (*state, f"_hits{k}", f"_items{k}")
            shared.destroy()
    for k in range(len(state) // 2):
        frame = frame.withColumns({"hits": F.concat("hits", f"_hits{k}"), "items": F.array_union("items", f"_items{k}")}).drop(f"_hits{k}", f"_items{k}")
    return frame.withColumn("items", F.array_sort("items"))


def _search(shared, text: str):
    state: dict[str, object] = {}

    def search(batch: pa.RecordBatch) -> dict[str, object]:
        if not state:
            (ids, texts), window = shared.value
            state["tables"], state["ids"] = build_tables(ids, texts, window), np.array(ids, object)
        words = Words.of(batch.column(text))
        owner = sequence_in(words.bounds)
        starts, ends, docs, items = [], [], [], []
        for patterns in state["tables"]:
            first, pattern = patterns.occurrences(words)
            starts.append(first)
            ends.append(first + patterns.size)
            n = np.diff(patterns.item_bounds)[pattern]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(patterns.item_bounds[pattern], n)
            docs.append(np.repeat(owner[first], n))
            items.append(patterns.items[at])
        rows = batch.num_rows
        hits, found = [[] for _ in range(rows)], [[] for _ in range(rows)]
        if starts:
            first, end = _ranges(np.concatenate(starts), np.concatenate(ends), words)
            for d, a, b in zip(owner[first].tolist(), (first - words.bounds[owner[first]]).tolist(), (end - words.bounds[owner[first]]).tolist(), strict=True):
                hits[d] += (a, b)
            pairs = np.unique(np.stack([np.concatenate(docs), np.concatenate(items)]), axis=1)
            for d, i in pairs.T.tolist():
                found[d].append(state["ids"][i])
        found = [sorted(set(x)) for x in found]
        return {"n_words": np.diff(words.bounds).astype(np.int64), "hits": pa.array(hits, pa.list_(pa.int64())), "items": pa.array(found, pa.list_(pa.string()))}

    return search


def _ranges(starts: np.ndarray, ends: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Maximal hit word ranges, cut at text boundaries."""
    n = len(words.starts)
    inside = np.zeros(n + 1, bool)
    inside[:n] = covered(n, starts, ends)
    new_text = np.zeros(n + 1, bool)
    new_text[words.bounds] = True
    before = np.r_[False, inside[:-1]]
    first = np.flatnonzero(inside & (~before | new_text))
    end = np.flatnonzero(before & (~inside | new_text))
    return first, end


def n_hit(hits: str = "hits"):
    """Number of words in the hit ranges; ranges of several parts may overlap."""
    pairs = F.expr(
        f"aggregate(array_sort(transform(sequence(0, cast(size({hits}) div 2 as int)), i -> named_struct('a', get({hits}, 2 * i), 'b', get({hits}, 2 * i + 1)))),"
        " named_struct('n', 0L, 'end', 0L),"
        " (s, x) -> if(x.a is null, s, named_struct('n', s.n + greatest(x.b - greatest(x.a, s.end), 0L), 'end', greatest(s.end, x.b))), s -> s.n)"
    )
    return pairs


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The documents in which no window of an item occurs, with all their columns."""
    for last, part in _parts(benchmark, item_id, text, table_bytes):
        shared = docs.sparkSession.sparkContext.broadcast((part, window))
        search = _search(shared, text)
        docs = filter_texts(docs, lambda batch, search=search: [not x for x in search(batch)["hits"].to_pylist()], text)
        if not last:
            docs = written(docs)
            shared.destroy()
    return docs
