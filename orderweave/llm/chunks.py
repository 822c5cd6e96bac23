"""Documents in chunks, and rounds of questions between chunks.

A chunk holds the documents of one id range, some megabytes of text. In a round
every chunk sends its distinct 64-bit keys, packed, to shards of the key space;
a shard sends back one bit for each key it got. A key that is frequent in the
corpus therefore reaches a shard once per chunk, not once per occurrence, and a
text is never sent after its key. Chunks are in id order, so that "in an earlier
chunk" means "in a document with a smaller id".
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spark import prepare, release, written
from .texts import flat

CHUNK_BYTES = 4 << 20
#: Chunk bytes that a task gets, about; a session's number of shuffle partitions may be too small for the data.
_TASK_BYTES = 64 << 20
_WORKER_BYTES = 384 << 20
#: The level of answers that name a chunk's exact copies.
COPY = -1
_REQUEST = "shard long, chunk long, level int, keys binary"
_ANSWER = "chunk long, level int, shard long, n long, bits binary"


@dataclass
class Dealt:
    """(chunk, doc_id, text) rows, and how many text bytes they hold."""

    docs: DataFrame
    n_bytes: int


def deal(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, rest: bool = False) -> Dealt:
    """Give every document its chunk; with `rest`, its other columns come along in a struct.

    Chunks end where the sizes of the documents in id order say, whatever the ids
    are: none holds more than `chunk_bytes`, unless the rows of one id do. Rows of
    one id share a chunk. Rows without an id go to chunks of their own, below 0.

    The sizes are range-partitioned by id. A chunk's number is its partition's, shifted,
    and its place there. Where chunks begin stays in a table, a row for each partition;
    the driver sees one id and one sum of each, however many chunks there are.
    """
    spark = docs.sparkSession
    prepare(spark)
    named = lambda c: F.col(f"`{c}`")
    more = [F.struct(*[named(c) for c in others]).alias("rest")] if rest and (others := [c for c in docs.columns if c not in (doc_id, text)]) else []
    docs = docs.select(named(doc_id).cast("long").alias("doc_id"), named(text).alias("text"), *more)
    sizes = docs.groupBy("doc_id").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n"))
    ordered = sizes.where("doc_id is not null").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    runs = written(ordered.mapInArrow(lambda batches: _runs(batches, chunk_bytes), "first long, starts array<long>, n long"))
    parts = sorted((r["first"], r["n"], r["k"]) for r in runs.select("first", "n", F.size("starts").alias("k")).collect())  # one a partition
    unknown = docs.where("doc_id is null").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_bytes = sum(n for _, n, _ in parts) + unknown
    n_lost = unknown // chunk_bytes + 1
    lost = -1 - F.pmod(F.xxhash64("text"), F.lit(n_lost))
    firsts = F.split(F.lit(",".join(str(first) for first, _, _ in parts)), ",").cast("array<long>") if parts else F.array().cast("array<long>")
    docs = docs.withColumn("part", F.when(F.col("doc_id").isNotNull(), _place(F.col("doc_id"), firsts, len(parts))))
    runs = runs.select(_place(F.col("first"), firsts, len(parts)).alias("of"), "starts")
    docs = docs.join(runs, docs["part"] == runs["of"], "left")
    inside = _place(F.col("doc_id"), F.col("starts"), max((k for _, _, k in parts), default=1))
    chunk = F.when(F.col("part").isNotNull(), F.shiftleft("part", 32) + inside).otherwise(lost)
    docs = docs.select(chunk.alias("chunk"), "doc_id", "text", *(["rest"] if more else []))
    tasks = n_bytes // _TASK_BYTES + 1
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):  # else the session's number, and fewer if Spark finds that best
        docs = docs.repartition(tasks, "chunk")
    return Dealt(docs, n_bytes)


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(first id, first ids of its chunks, bytes) of a partition; a chunk of several ids holds at most `most` bytes."""
    starts, filled, total = [], 0, 0
    for batch in batches:
        for first, n in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), strict=True):
            if not starts or filled + n > most:
                starts.append(first)
                filled = 0
            filled, total = filled + n, total + n
    if starts:
        columns = [pa.array(starts[:1], pa.int64()), pa.array([starts], pa.list_(pa.int64())), pa.array([total], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["first", "starts", "n"])


def _place(value: Column, starts: Column, most: int) -> Column:
    """The index of the last of the ascending `starts`, `most` or fewer, that is not above the value, by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(most, 1).bit_length()))])
    further = lambda at, step: F.when(F.get(starts, at + step - 1) <= value, at + step).otherwise(at)
    return (F.aggregate(steps, F.lit(0), further) - 1).cast("long")


class Chunk:
    """The documents of one chunk in id order, as flat bytes."""

    def __init__(self, rows: pa.Table, given: pa.Table | None = None):
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])  # null ids come last
        self.rows = rows
        self.number = rows["chunk"][0].as_py() if rows.num_rows else 0
        self.data, self.offsets = flat(rows["text"])
        ids = rows["doc_id"].combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        rank = np.cumsum(np.r_[0, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
        #: By document: its id's rank in the chunk; -1 without an id.
        self.rank = np.where(known, rank, -1)
        self.ids = values
        #: By document: is its text that of a document with a smaller id?
        self.copies = np.zeros(rows.num_rows, bool)
        if given is not None:
            named = given.filter(pa.compute.equal(given["level"], COPY))
            marks = set(zip(named["shard"].to_pylist(), named["n"].to_pylist(), strict=True))
            for at in np.flatnonzero(known & np.isin(values, named["shard"].to_numpy())).tolist():
                text = self.data[self.offsets[at] : self.offsets[at + 1]]
                self.copies[at] = (int(values[at]), int(hashlib.md5(text).hexdigest()[:15], 16)) in marks


def copies(dealt: Dealt) -> DataFrame:
    """An answer for each row whose text a document with a smaller id has: (chunk, COPY, doc_id, 60 bits of MD5 of the text, ...).

    Rows of one id may differ, so the text is named beside the id. What such a document repeats is clear, and its original
    stands for it elsewhere. A chunk's rows of one text are put together first, so that a text meets one row a chunk.
    """
    rows = dealt.docs.where("doc_id is not null and length(text) > 0")
    rows = rows.select("chunk", "doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"), F.octet_length("text").alias("n"), F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long").alias("mark"))
    held = rows.groupBy("a", "b", "n", "chunk").agg(F.collect_set("doc_id").alias("ids"), F.min("mark").alias("mark"), F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest"))
    first = held.groupBy("a", "b", "n").agg(F.min("least").alias("first"), F.max("greatest").alias("last")).where("first < last")
    found = held.join(first, ["a", "b", "n"]).select("chunk", "mark", F.explode(F.filter("ids", lambda i: i > F.col("first"))).alias("doc_id"))
    nothing = F.lit(None).cast("binary")
    # a column of its own, as these rows meet the documents they come from
    return found.select((F.col("chunk") + 0).alias("chunk"), F.lit(COPY).alias("level"), F.col("doc_id").alias("shard"), F.col("mark").alias("n"), nothing.alias("bits"))


def requests(chunk: int, level: int, shards: int, keys: np.ndarray) -> pa.Table:
    """One row for each shard that any of the ascending keys belong to."""
    cuts = np.searchsorted(keys, shard_starts(shards))
    ends = np.r_[cuts[1:], len(keys)]
    full = np.flatnonzero(ends > cuts)
    packed = [keys[a:b].tobytes() for a, b in zip(cuts[full].tolist(), ends[full].tolist(), strict=True)]
    n = len(full)
    return pa.table(
        {
            "shard": pa.array(full, pa.int64()),
            "chunk": pa.array(np.full(n, chunk), pa.int64()),
            "level": pa.array(np.full(n, level), pa.int32()),
            "keys": pa.array(packed, pa.binary()),
        }
    )


def shard_starts(shards: int) -> np.ndarray:
    """The least key of each shard."""
    return np.array([-(-(k << 64) // shards) for k in range(shards)], np.uint64)


def answered(asked: DataFrame, earlier: bool) -> DataFrame:
    """For each key a bit: was it also sent by an earlier chunk, or (`earlier` false) by any other chunk?"""

    def answer(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        keys, offsets = flat(rows["keys"])
        keys = np.frombuffer(keys.tobytes(), np.uint64)
        bounds = offsets // 8
        order = np.argsort(keys, kind="stable")  # within a key by chunk
        same = keys[order][1:] == keys[order][:-1]
        bit = np.zeros(len(keys), bool)
        bit[order[1:][same]] = True
        if not earlier:
            bit[order[:-1][same]] = True
        pairs = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        columns = {
            "chunk": rows["chunk"],
            "level": rows["level"],
            "shard": rows["shard"],
            "n": pa.array(np.diff(bounds), pa.int64()),
            "bits": pa.array([np.packbits(bit[a:b]).tobytes() for a, b in pairs], pa.binary()),
        }
        return released(pa.table(columns))

    return asked.groupBy("shard").applyInArrow(answer, _ANSWER)


def answers_of(rows: pa.Table, level: int) -> np.ndarray:
    """The bits that a chunk got for its ascending keys of a level."""
    rows = rows.filter(pa.compute.equal(rows["level"], level)).sort_by("shard")
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(rows["bits"].to_pylist(), rows["n"].to_pylist(), strict=True)]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)


def released(made: pa.Table) -> pa.Table:
    release(above=_WORKER_BYTES)  # one of many groups of a task: not every time
    return made


def ask(dealt: Dealt, answers: list[DataFrame], function: Callable[[pa.Table, pa.Table | None], pa.Table], schema: str = _REQUEST) -> DataFrame:
    """Apply a function to each chunk's rows and the answers it has so far."""
    if not answers:
        return dealt.docs.groupBy("chunk").applyInArrow(lambda rows: released(function(rows, None)), schema)
    known = answers[0]
    for more in answers[1:]:
        known = known.unionByName(more)

    def with_answers(rows: pa.Table, given: pa.Table) -> pa.Table:
        return released(function(rows, given))

    return dealt.docs.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(with_answers, schema)
