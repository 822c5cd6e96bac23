"""Token counts by a separator scan over flat token files.

A token file is nothing but token ids of a fixed width, each document followed by the
end-of-document id; no index says where documents begin. It is held as numbered blocks
of equal size, cut without regard to documents. Each block is searched for the id at
once. A document's length is the distance between its separator and the one before,
which may lie many blocks back: a prefix scan over the blocks (sum of separators, last
separator's position) stitches the boundaries. The scan works in two levels, blocks
within segments and segments within a file, so that a long file is not one task's.

Defined results: a null or empty text is a document of no tokens; what follows a
file's last separator is a document without end, reported with `closed` false if it
holds any token; an empty table has no documents.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spark import prepare, shared_folder
from .texts import slices

BLOCK_TOKENS = 1 << 16
SEGMENT_BLOCKS = 1 << 10
END_OF_DOCUMENT = 50_256


def byte_bpe(ranks: dict[bytes, int], pattern: str) -> Callable[[list[str]], list[list[int]]]:
    """An encoder of whole texts with a rank file's vocabulary."""
    import tiktoken

    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [encoding.encode_ordinary(t) for t in texts]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def token_files(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write one token file per input partition; (file, block, data, ids).

    The rows with `data` are the files. A file's ids, in the order of its documents, are
    in rows of their own (`block` null, `ids` packed with a validity byte each).
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((ranks, pattern))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(*shared.value)
        held, n_held, block, part, file = [], 0, 0, 0, 0

        def row(block: int | None, data: bytes | None, part: int | None = None, ids: bytes | None = None) -> pa.RecordBatch:
            values = [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([data], pa.binary()), pa.array([part], pa.int64()), pa.array([ids], pa.binary())]
            return pa.RecordBatch.from_arrays(values, names=["file", "block", "data", "part", "ids"])

        for batch in slices(batches, text):
            file = batch.column("file")[0].as_py()
            for ids in encode([t or "" for t in batch.column(text).to_pylist()]):
                held += [np.array(ids, np.uint16), np.array([end], np.uint16)]
                n_held += len(ids) + 1
            if n_held >= block_tokens:
                stream = np.concatenate(held)
                whole = len(stream) // block_tokens * block_tokens
                for start in range(0, whole, block_tokens):
                    yield row(block, stream[start : start + block_tokens].tobytes())
                    block += 1
                held, n_held = [stream[whole:]], len(stream) - whole
            names = batch.column(doc_id).cast(pa.int64())
            packed = names.fill_null(0).to_numpy(zero_copy_only=False).tobytes() + names.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
            yield row(None, None, part, packed)
            part += batch.num_rows
        if n_held:
            yield row(block, np.concatenate(held).tobytes())

    frame = docs.select(doc_id, text, F.spark_partition_id().alias("file"))
    path = shared_folder(spark)
    made = frame.mapInArrow(write, "file int, block long, data binary, part long, ids binary")
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def counted(blocks: DataFrame, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS, segment_blocks: int = SEGMENT_BLOCKS) -> DataFrame:
    """(file, ordinal, n_tokens, closed) of each document of the files (file, block, data)."""
    prepare(blocks.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {c: [] for c in ("n", "first", "last", "stop", "inner")}
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
                ids = np.frombuffer(data.as_buffer(), np.uint16)
                at = np.flatnonzero(ids == end) + block * block_tokens  # from the file's begin
                found["n"].append(len(at))
                found["first"].append(int(at[0]) if len(at) else None)
                found["last"].append(int(at[-1]) if len(at) else None)
                found["stop"].append(block * block_tokens + len(ids))
                found["inner"].append(np.diff(at) - 1)
            arrays = [pa.array(v, pa.list_(pa.int64()) if c == "inner" else pa.int64()) for c, v in found.items()]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), *arrays], names=["file", "block", *found])

    blocks = blocks.where("data is not null").select("file", "block", "data")
    found = blocks.mapInArrow(search, f"file {blocks.schema['file'].dataType.simpleString()}, block long, n long, first long, last long, stop long, inner array<long>")
    found = found.withColumn("segment", F.floor(F.col("block") / segment_blocks))
    # upper level: what lies before each segment
    whole = found.groupBy("file", "segment").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    ahead = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("file", "segment", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n_ahead"), F.max("last").over(ahead).alias("last_ahead"))
    # lower level: what lies before each block of a segment
    before = Window.partitionBy("file", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumns({"n_before": F.coalesce(F.sum("n").over(before), F.lit(0)), "last_before": F.max("last").over(before)})
    found = found.join(whole, ["file", "segment"])
    previous = F.coalesce("last_before", "last_ahead", F.lit(-1))
    lengths = F.concat(F.array(F.col("first") - previous - 1), F.col("inner"))
    closed = found.where("n > 0").select("file", (F.col("n_ahead") + F.col("n_before")).alias("base"), F.posexplode(lengths).alias("at", "n_tokens"))
    closed = closed.select("file", (F.col("base") + F.col("at")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    open_ = found.groupBy("file").agg(F.sum("n").alias("ordinal"), F.max("last").alias("last"), F.max("stop").alias("stop"))
    open_ = open_.select("file", "ordinal", (F.col("stop") - F.coalesce("last", F.lit(-1)) - 1).alias("n_tokens"), F.lit(False).alias("closed")).where("n_tokens > 0")
    return closed.unionByName(open_)


def named(files: DataFrame) -> DataFrame:
    """(file, ordinal, doc_id) from the id rows of `token_files`."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, part, packed in zip(batch.column("file").to_pylist(), batch.column("part").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                n = len(packed) // 9
                ids = pa.array(np.frombuffer(packed, np.int64, n), mask=np.frombuffer(packed, np.uint8, n, 8 * n) == 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, file), pa.int32()), pa.array(np.arange(part, part + n)), ids], names=["file", "ordinal", "doc_id"])

    return files.where("ids is not null").select("file", "part", "ids").mapInArrow(unpack, "file int, ordinal long, doc_id long")


def documents_counted(docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens): writes the token files of the documents and scans them."""
    files = token_files(docs, ranks, pattern, block_tokens=block_tokens, doc_id=doc_id, text=text)
    return named(files).join(counted(files, block_tokens=block_tokens), ["file", "ordinal"]).select("doc_id", "n_tokens")
