"""Spark helpers of the operators: tables, shared scratch tables, mapping over text slices."""

from __future__ import annotations

import ctypes
import mmap
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import SLICE_BYTES, slices

#: Rows of one Arrow batch: bounds what the JVM gathers before Python sees it.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LIBC = ctypes.CDLL(None)
_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors, which may not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> None:
    """Ready the session for Python tasks: the package, and small Arrow batches as long texts make large rows."""
    _ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below `spark.checkpoint.dir`.

    A session without that setting (tests) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows from a table in the shared folder: cuts the lineage and survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_texts(
    docs: DataFrame,
    function: Callable[[pa.RecordBatch], dict[str, object]],
    fields: str,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    limit: int = SLICE_BYTES,
    finish: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Columns `keep` of each row and what `function` makes of its slice.

    The function gets slices with the columns `keep` and `text` and returns a
    list or array for each of the `fields`.  `finish` ends a task.
    """
    prepare(docs.sparkSession)
    frame = docs.select(*dict.fromkeys([*keep, text]))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, limit):
            made = function(batch)
            columns = [batch.column(c) for c in keep] + [x if isinstance(x, pa.Array) else pa.array(x) for x in made.values()]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made])
        finish()
        release()

    return frame.mapInArrow(run, schema)


def filter_texts(docs: DataFrame, function: Callable[[pa.RecordBatch], object], text: str = "text") -> DataFrame:
    """The rows for which `function` of a slice is true, with all their columns."""
    prepare(docs.sparkSession)
    columns = docs.columns
    plain = [c if c == text or "." not in c else f"_column_{k}" for k, c in enumerate(columns)]  # no dots in between

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            named = batch.rename_columns(columns)
            yield batch.filter(pa.array(function(named), pa.bool_()))
        release()

    renamed = docs.toDF(*plain)
    return renamed.mapInArrow(run, renamed.schema).toDF(*columns)


def rows_with_ids(docs: DataFrame, ids: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text", bits: int = 1 << 23) -> DataFrame:
    """`function` of the rows whose doc_id is among the ids (id), without moving the texts.

    Ids are looked up in a broadcast bit table of fixed size; the few others that
    share a bit come along, so what is made has to be joined by id.
    """
    prepare(docs.sparkSession)
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {bits}L) % 64 as int))")
    words = ids.select(F.floor(place / 64).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mask"))
    found = words.toArrow()  # at most bits / 64 rows
    table = np.zeros(bits // 64, np.int64)
    table[found["word"].to_numpy()] = found["mask"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)
    frame = docs.where("doc_id is not null").withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            at = batch.column("place").to_numpy()
            wanted = (shared.value[at // 64] >> (at % 64)) & 1 == 1
            if wanted.any():
                yield function(batch.filter(pa.array(wanted)))

    return frame.mapInArrow(run, schema)


def release(above: int = 0) -> None:
    """Give freed memory back, if the process holds more than `above` bytes.

    A worker lives on after its task, beside the executor's own memory.
    """
    held = Path("/proc/self/statm")
    if above and held.exists() and int(held.read_text().split()[1]) * mmap.PAGESIZE <= above:
        return
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.select(F.sum(F.octet_length(F.col(text))).alias("n")).first()["n"] or 0
