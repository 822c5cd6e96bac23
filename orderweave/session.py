"""Session settings the plans rely on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffles start with many small partitions, which AQE joins up to the size below. The ids
    # compress well, so 16 MB are some million rows, and a task sorts several tables.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A side already partitioned by one of several join keys stays in place.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


class SessionSettings:
    """Settings of a session that hold while some of its jobs are planned; jobs that run together may overlap."""

    def __init__(self, values: dict[str, str]):
        self._values, self._lock, self._open, self._before = values, Lock(), 0, {}

    @contextmanager
    def set(self, spark: SparkSession) -> Iterator[None]:
        """The session's own settings are back after the last of them."""
        with self._lock:
            if not self._open:
                self._before = {key: spark.conf.get(key) for key in self._values}
                self._put(spark, self._values)
            self._open += 1
        try:
            yield
        finally:
            with self._lock:
                self._open -= 1
                if not self._open:
                    self._put(spark, self._before)

    def _put(self, spark: SparkSession, values: dict[str, str]) -> None:
        for key, value in values.items():
            spark.conf.set(key, value)


#: A job that writes a table on the way needs its shuffle files no more when it ends; else they stay until a driver's garbage collection.
SHUFFLES_FREED = SessionSettings({"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared folder.

    That folder is the setting `spark.checkpoint.dir`; only a local session may
    do without it.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared and "://" in shared and not shared.startswith("file:"):
        return f"{shared.rstrip('/')}/orderweave-{os.urandom(8).hex()}"
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if shared:
        root = shared.removeprefix("file://").removeprefix("file:")
        return os.path.join(root, f"orderweave-{os.urandom(8).hex()}")
    return tempfile.mkdtemp(prefix="orderweave-")
