"""Frames that the plans of a run share, each computed once and stored.

A dataset is about one month, its side tables are of all years. With stages, the dated
headers of the month are written first. What else the plans need of them then comes from
those few rows: the ids that cut approvals, notes, deliveries, invoices and logs before
these are grouped or shuffled, whether a branch of a plan has rows at all, and which ids
are shared by so many headers that their joins need salts. Several datasets built with
the same stages share them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import DateWindow
from ..session import SHUFFLES_FREED, SessionSettings, scratch_folder

#: Rows of one id that a task may get; ids with more are salted.
HEAVY_ROWS = 500_000
#: Ids that the sketch of a column keeps, and how many of them it may report.
_TRACKED, _REPORTED = 4096, 256
#: Where ids cut large tables: a scan is filtered by a Bloom filter (of 8 MB at most) of ids that are too many to be broadcast.
_BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}


class Stages:
    """Stored frames below a folder that all executors share; the run's owner removes it.

    `window`: the headers' dates, if datasets over several windows share them; it has
    to hold all of theirs.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, window: DateWindow | None = None, heavy_rows: int = HEAVY_ROWS):
        self.spark, self.window, self.heavy_rows = spark, window, heavy_rows
        #: Ids of the orders that datasets over the shared window may need (one column), once the headers are stored.
        self.run_orders: DataFrame | None = None
        #: Ids of the documents that the run's headers name, by kind (`run_id`, distinct), unless the shared window is a wide one.
        self.run_ids: dict[str, DataFrame] | None = None
        self._folder = folder or scratch_folder(spark)
        self._frames: dict[str, DataFrame] = {}
        self._heavy: dict[str, tuple[str | None, ...]] = {}
        self._empty: dict[str, bool] = {}
        self._wide: dict[str, bool] = {}
        self._wide_headers: list[DataFrame] = []
        self._bloom = SessionSettings(_BLOOM)

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._frames:
            df = build()
            path = f"{self._folder}/{name}"
            with SHUFFLES_FREED.set(self.spark):
                df.write.parquet(path)
            self._frames[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._frames[name]

    def drop(self, name: str) -> None:
        """Delete a stored frame, if there is one, that no plan still to run reads."""
        if self._frames.pop(name, None) is not None:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def together(self, *builds: Callable[[], object]) -> list:
        """Run jobs that do not need each other at the same time."""
        with ThreadPoolExecutor(len(builds)) as pool:
            return [f.result() for f in [pool.submit(inheritable_thread_target(self.spark)(b)) for b in builds]]

    def bloom_filters(self) -> AbstractContextManager[None]:
        """Joins planned meanwhile may filter a scan by a Bloom filter of the other side's ids, whatever its size."""
        return self._bloom.set(self.spark)

    def within(self, name: str, window: DateWindow, ids: dict[str, DataFrame]) -> Stages:
        """Stages for what is left to do on stored rows, whose ids (`run_id`, distinct), by kind, cut the side tables."""
        inner = Stages(self.spark, f"{self._folder}/within-{name}", window, self.heavy_rows)
        inner._heavy = self._heavy
        inner.run_ids, inner.run_orders = ids, ids["order"]
        return inner

    def name(self, kind: str, window: DateWindow) -> str:
        """What a frame over a window is stored as."""
        return re.sub("[^0-9A-Za-z]+", "-", f"{kind} {window.start} {window.end} {'closed' if window.closed else 'open'}")

    def is_wide(self, window: DateWindow, dated: DataFrame, date: str) -> bool:
        """Does the window hold nine tenths of the dated documents or more? Their ids then hardly cut a side table, and cost a shuffle of it."""
        name = self.name("wide", window)
        if name not in self._wide:
            found = dated.agg(F.count(date).alias("n"), F.count_if(window.contains(F.col(date))).alias("inside")).first()
            self._wide[name] = found["n"] > 0 and 10 * found["inside"] >= 9 * found["n"]
        return self._wide[name]

    def mark_wide(self, headers: DataFrame) -> DataFrame:
        """Headers of a wide window, by whose ids no side table is cut."""
        self._wide_headers.append(headers)
        return headers

    def cuts(self, headers: DataFrame) -> bool:
        return not any(headers is wide for wide in self._wide_headers)

    def is_empty(self, name: str, df: DataFrame) -> bool:
        if name not in self._empty:
            self._empty[name] = df.isEmpty()
        return self._empty[name]

    def watch(self, name: str, df: DataFrame, columns: Sequence[str]) -> None:
        """Find the ids in `columns` that more than `heavy_rows` rows share, by one sketch of each column.

        The sketch may count an id too high, and never misses one that makes up more
        than a few thousandths of the rows. What it finds only says where salts go.
        """
        if name in self._empty:
            return
        sketch = lambda c: F.expr(f"approx_top_k(cast(`{c}` as string), {_REPORTED}, {_TRACKED})")
        found = df.agg(F.count(F.lit(1)).alias("n"), *[sketch(c).alias(f"top_{c}") for c in columns], *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]).first()
        self._empty[name] = found["n"] == 0
        for c in columns:
            keys = [top["item"] for top in found[f"top_{c}"] or [] if top["count"] > self.heavy_rows]
            nulls = [None] if found[f"null_{c}"] > self.heavy_rows else []
            self._heavy[c] = tuple(dict.fromkeys([*self._heavy.get(c, ()), *keys, *nulls]))

    def heavy(self, column: str) -> tuple[str | None, ...]:
        """The heavy ids of a column; none where it was not watched."""
        return self._heavy.get(column, ())
