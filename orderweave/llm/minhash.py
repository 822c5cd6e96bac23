"""MinHash near-dedup: SuperMinHash signatures, banding, verification, union-find.

A document's set are its distinct shingles of `SHINGLE` words, or its whole word
sequence where it has fewer. In a SuperMinHash signature each shingle deals ranks
to the `SLOTS` slots by a random permutation: at step j it offers j plus a random
fraction to one slot it has not used. A document stops once every slot holds less
than the next step could offer.

1. Documents with equal sets form a class; its smallest id stands for it. Sets are
   compared by size and two sums over hashes with unrelated seeds, drawn for the run.
2. Representatives that agree on all slots of one of the bands share a bucket. Bands
   have as many slots as leave two documents at the threshold none in common with a
   chance below `MISSED`: 25 bands of 5 slots at 85 % (4e-7), 31 of 4 at 80 % (8e-8).
3. Round one compares every member of a bucket with one hub, the member with most
   bucket neighbours. Round two compares what is left: members of different groups
   of one bucket, unless a link is ruled out - for certain by the sizes, by the
   shingles that no other document of an open bucket has, or by what either shares
   with the hub; and by 125-bit sketches with a chance below `MISSED` at the threshold,
   from 27 differing bits on at 85 %, 32 at 80 %. A bucket is never expanded into all pairs of a group that round one has linked.
4. Links are confirmed on the full sets, by integers.

Defined results: null, empty and blank texts have no shingles and no links; rows of
one id are one document, linked as any of its rows is; rows without an id are kept
and have no component. A very long text is one set, in a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .spark import map_texts, prepare, rows_with_ids, written
from .texts import NOT_SPACE, flat, fresh_seed, lower_ascii, mix, sequence_in, sequences_hash, stretches_hash, word_spans

SHINGLE = 5
PERCENT = 85
SLOTS = 125
#: Chance that two documents at the threshold are lost: by the bands, and by the sketches.
MISSED = 1e-6

_STEP = np.uint64(0x9E3779B97F4A7C15)


def banding(percent: int) -> tuple[int, int]:
    """(bands, slots of a band): the longest bands that miss a pair at the threshold with a chance below `MISSED`."""
    missed = lambda rows: (1 - (percent / 100) ** rows) ** (SLOTS // rows)
    rows = max((r for r in range(1, SLOTS + 1) if missed(r) < MISSED), default=1)
    return SLOTS // rows, rows


def sketch_bits(percent: int) -> int:
    """How many bits of two sketches may differ: more do at the threshold with a chance below `MISSED`."""
    p, above, bits = (1 - percent / 100) / 2, 0.0, SLOTS
    while bits and (above := above + comb(SLOTS, bits) * p**bits * (1 - p) ** (SLOTS - bits)) < MISSED:
        bits -= 1
    return bits


def shingle_sets(column: pa.Array, seeds: tuple[int, ...] = (0,), size: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """(text, shingle hash by the first seed, by the second, ...), distinct and ascending."""
    data, offsets = flat(column)
    data = lower_ascii(data)
    starts, ends, bounds = word_spans(data, offsets, NOT_SPACE)
    owner, n = sequence_in(bounds), np.diff(bounds)
    found = max(len(owner) - size + 1, 0)
    whole = np.flatnonzero(owner[:found] == owner[size - 1 : size - 1 + found])
    short = [np.flatnonzero(n == k) for k in range(1, size)]
    text = np.concatenate([owner[whole], *short])
    lanes = []
    for seed in seeds:
        words = stretches_hash(data, starts, ends, seed)
        lanes.append(np.concatenate([sequences_hash(words, size, seed)[whole], *(sequences_hash(words, k, seed)[bounds[at]] for k, at in enumerate(short, 1))]))
    order = np.lexsort((lanes[0], text))
    text, hashes = text[order], lanes[0][order]
    new = np.r_[True, (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])] if len(text) else np.zeros(0, bool)
    return text[new], hashes[new], *(lane[order][new] for lane in lanes[1:])


def signatures(text: np.ndarray, hashes: np.ndarray, n_texts: int, slots: int = SLOTS) -> np.ndarray:
    """(n_texts, slots): least offers; step in the upper bits, fraction below."""
    least = np.full(n_texts * slots, np.iinfo(np.uint64).max, np.uint64)
    steps = np.arange(1, slots + 1, dtype=np.uint64) * _STEP
    used: list[np.ndarray] = []  # by step: the place each shingle swapped with
    for step in range(slots):
        drawn = mix(hashes + steps[step])
        place = step + ((drawn >> np.uint64(44)) % np.uint64(slots - step)).astype(np.int64)
        slot = place.copy()
        for earlier in range(step - 1, -1, -1):  # what earlier swaps have put there
            slot[slot == used[earlier]] = earlier
        offer = (np.uint64(step) << np.uint64(44)) | (drawn & np.uint64((1 << 44) - 1))
        np.minimum.at(least, text * slots + slot, offer)
        going = (least.reshape(n_texts, slots).max(1) >> np.uint64(44) > np.uint64(step))[text]
        if not going.any():
            break
        used.append(place)
        if not going.all():
            text, hashes, used = text[going], hashes[going], [u[going] for u in used]
    return least.reshape(n_texts, slots)


def _sketch(batch: pa.RecordBatch, column: str, percent: int, seeds: tuple[int, int]) -> dict[str, object]:
    n, (n_bands, n_rows) = batch.num_rows, banding(percent)
    text, hashes, others = shingle_sets(batch.column(column), seeds)
    sizes = np.bincount(text, minlength=n)
    full = np.flatnonzero(sizes)
    bands = np.zeros((n, n_bands), np.int64)
    keys, sketch = np.zeros((2, n), np.uint64), np.zeros((n, 2), np.int64)
    if len(full):
        begins = np.searchsorted(text, full)
        keys[0, full] = np.add.reduceat(mix(hashes), begins)
        keys[1, full] = np.add.reduceat(mix(others + _STEP), begins)
        signature = signatures(np.repeat(np.arange(len(full)), sizes[full]), hashes, len(full))
        rows = signature[:, : n_bands * n_rows].reshape(len(full), n_bands, n_rows)
        key = np.arange(n_bands, dtype=np.uint64)[None, :] + np.zeros((len(full), 1), np.uint64)
        for k in range(n_rows):
            key = mix(key * _STEP + rows[:, :, k])
        bands[full] = key.view(np.int64)
        bits = np.zeros((len(full), 128), np.uint8)
        bits[:, :SLOTS] = mix(signature) >> np.uint64(63)
        sketch[full] = np.packbits(bits, axis=1).view(np.int64)
    lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum((sizes > 0) * n_bands)]).astype(np.int32), bands[full].ravel())
    return {"n": sizes.astype(np.int64), "k1": keys[0].view(np.int64), "k2": keys[1].view(np.int64), "bands": lists, "s1": sketch[:, 0].copy(), "s2": sketch[:, 1].copy()}


def _compared(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, overlap, linked): how many shingles the full sets share, and whether that is enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            overlap, hit = [], []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                overlap.append(shared)
                hit.append(100 * shared >= percent * (len(both) - shared))
            columns = [batch.column("a"), batch.column("b"), pa.array(overlap, pa.int64()), pa.array(hit, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "overlap", "linked"])

    return pairs.mapInArrow(confirm, "a long, b long, overlap long, linked boolean")


def _sets(docs: DataFrame, ids: DataFrame, text: str, seed: int) -> DataFrame:
    """(id, set): packed ascending shingle hashes of the documents wanted."""

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, hashes = shingle_sets(batch.column(text), (seed,))
        cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        sets = [hashes[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["id", "set"])

    found = rows_with_ids(docs, ids, pack, "id long, set binary", text).where("length(set) > 0")
    return written(found.join(ids, "id", "left_semi"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) compared on their full sets. The side that repeats more, the hubs, is joined last."""
    a = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    hubs = pairs.select("b").distinct()
    b = sets.join(hubs, sets["id"] == hubs["b"], "left_semi").select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    return written(_compared(pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b"), percent))


def _shared_sizes(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shared): how many of a set's shingles are in another of these sets, too."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("set"))
            shingles = np.frombuffer(data.tobytes(), np.int64)
            ids_of = np.repeat(batch.column("id").to_numpy(), np.diff(offsets) // 8)
            yield pa.RecordBatch.from_arrays([pa.array(ids_of), pa.array(shingles)], names=["id", "shingle"])

    rows = sets.join(ids, "id", "left_semi").mapInArrow(unpack, "id long, shingle long")
    alone = rows.groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("other")).where("id = other")
    alone = alone.groupBy("id").agg(F.count("*").alias("alone"))
    sizes = sets.select("id", F.expr("length(set) div 8").alias("n")).groupBy("id").agg(F.max("n").alias("n"))
    return sizes.join(ids, "id", "left_semi").join(alone, "id", "left").select("id", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))


def _possible(x: str, y: str, percent: int):
    """Whether sizes and sketches leave room for a link; sets too small to differ and be linked are classes already."""
    sizes = f"(100 - {percent}) * least({x}.n, {y}.n) >= {percent} and 100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)"
    bits = f"bit_count({x}.s1 ^ {y}.s1) + bit_count({x}.s2 ^ {y}.s2) <= {sketch_bits(percent)}"
    return F.expr(f"{sizes} and {bits}")


def grouped(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias(text))
    seeds = (fresh_seed(), fresh_seed())
    fields = "n long, k1 long, k2 long, bands array<long>, s1 long, s2 long"
    rows = written(map_texts(docs, lambda batch: _sketch(batch, text, percent, seeds), fields, ("doc_id",), text))
    known = rows.where("n > 0 and doc_id is not null")
    # equal sets: the smallest id stands for the class
    classes = written(known.groupBy("k1", "k2", "n").agg(F.min_by(F.struct("bands", "s1", "s2"), "doc_id").alias("x"), F.min("doc_id").alias("id")))
    member = written(known.select("doc_id", "k1", "k2", "n").join(classes.select("k1", "k2", "n", "id"), ["k1", "k2", "n"]).select("doc_id", "id"))
    same_id = member.groupBy("doc_id").agg(F.min("id").alias("a"), F.collect_set("id").alias("others")).where("size(others) > 1")
    same_id = same_id.select("a", F.explode("others").alias("b"))

    # buckets with more than one representative
    slots = classes.select(F.explode("x.bands").alias("band"), "id")
    sizes = slots.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    slots = written(slots.join(sizes, "band"))
    score = slots.groupBy("id").agg(F.sum("size").alias("score"))
    about = classes.select("id", "n", F.col("x.s1").alias("s1"), F.col("x.s2").alias("s2"))
    entry = written(slots.drop("size").join(score.join(about, "id"), "id"))
    hub = entry.groupBy("band").agg(F.max_by(F.struct("id", "n", "s1", "s2"), F.struct("score", -F.col("id"))).alias("h")).select("band", "h.*")
    hub = written(hub)
    sets = _sets(docs, entry.select("id").distinct(), text, seeds[0])

    # round one: every member with its hub
    x, y = entry.alias("x"), hub.alias("y")
    near = F.expr("x.band = y.band and x.id <> y.id") & _possible("x", "y", percent)
    first = written(x.join(y, near).selectExpr("x.id as a", "y.id as b").distinct())
    tested = _confirmed(first, sets, percent)
    links = tested.where("linked").select("a", "b")

    # round two: members of a bucket that are still apart
    labels = components(links)
    grouped_ = entry.join(labels, entry["id"] == labels["node"], "left").select("band", "id", "n", "s1", "s2", F.coalesce("component", "id").alias("group"))
    of_hub = hub.join(labels, hub["id"] == labels["node"], "left").select("band", F.col("id").alias("b"), F.coalesce("component", "id").alias("hub_group"))
    overlaps = tested.groupBy(F.col("a").alias("id"), "b").agg(F.max("overlap").alias("overlap"))
    grouped_ = written(grouped_.join(of_hub, "band").join(overlaps, ["id", "b"], "left").drop("b"))
    open_ = grouped_.join(grouped_.where("group <> hub_group").select("band").distinct(), "band", "left_semi")
    open_ = written(open_.join(_shared_sizes(sets, open_.select("id").distinct()), "id"))
    x, y = open_.where("group <> hub_group").alias("x"), open_.alias("y")
    across = F.expr("x.band = y.band and x.group <> y.group and (y.group = y.hub_group or x.id < y.id)")
    # x and y share at most what both share with the hub, and what both share with others beyond it
    most = "least(x.shared, y.shared, coalesce(least(x.overlap, y.overlap) + least(x.shared - x.overlap, y.shared - y.overlap), x.n))"
    overlap = F.expr(f"100 * {most} >= {percent} * (x.n + y.n - {most})")
    second = x.join(y, across & overlap & _possible("x", "y", percent)).selectExpr("x.id as a", "y.id as b").distinct()
    second = written(second.join(first, ["a", "b"], "left_anti"))
    if not second.isEmpty():
        links = links.union(_confirmed(second, sets, percent).where("linked").select("a", "b"))
    labels = components(links.union(same_id))

    found = member.join(labels, member["id"] == labels["node"], "left").select("doc_id", F.coalesce("component", "id").alias("component_id")).distinct()
    found = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    joined = rows.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document of each group, with all columns."""
    gone = grouped(docs, percent, doc_id, text).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
