"""Versions of a folder target: data beside data, and a numbered log whose last entry says what counts.

    <path>/_data/<name>/...      one write each, never changed
    <path>/_log/00000012.json    the schema, and which data folder holds which period

A load writes a new data folder and then the next log entry. The entry is renamed into
place in one step, so a reader sees the target as before or as after it; a load that
fails on its way leaves nothing that counts. Two loads that want the same number do not
overwrite each other: the later one is refused. Folders that the last `KEPT` entries do
not name are removed, so that a query that began before the switch can end.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEPT = 2
#: The one part of a target that is replaced as a whole.
WHOLE = ""


@dataclass(frozen=True)
class Entry:
    """What a target holds: its schema, and the data folder of every part."""

    number: int
    schema: T.StructType
    parts: dict[str, str] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "parts": self.parts})

    @classmethod
    def parse(cls, number: int, text: str) -> Entry:
        values = json.loads(text)
        return cls(number, T.StructType.fromJson(values["schema"]), values["parts"])


class Versions:
    """The log of one folder, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._system = self._file("").getFileSystem(self._conf)

    def _file(self, name: str):
        return self._fs.Path(f"{self.path}/{name}" if name else self.path)

    def _numbers(self) -> list[int]:
        log = self._file("_log")
        if not self._system.exists(log):
            return []
        names = [status.getPath().getName() for status in self._system.listStatus(log)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def _read(self, number: int) -> Entry:
        stream = self._system.open(self._file(f"_log/{number:08d}.json"))
        try:
            return Entry.parse(number, self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> Entry | None:
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else None

    def new_folder(self) -> str:
        return f"_data/{os.urandom(8).hex()}"

    def commit(self, before: Entry | None, schema: T.StructType, parts: dict[str, str]) -> None:
        """Make `parts` what counts, if nothing was committed since `before`."""
        entry = Entry(before.number + 1 if before else 1, schema, parts)
        self._system.mkdirs(self._file("_log"))
        draft, place = self._file(f"_log/_{os.urandom(8).hex()}"), self._file(f"_log/{entry.number:08d}.json")
        stream = self._system.create(draft)
        stream.write(bytearray(entry.text().encode()))
        stream.close()
        # a rename that does not overwrite: it fails where another load was faster
        if self._system.exists(place) or not self._system.rename(draft, place):
            self._system.delete(draft, False)
            raise RuntimeError(f"{self.path} was changed by another load meanwhile")
        self._remove_unnamed()

    def _remove_unnamed(self) -> None:
        numbers = self._numbers()
        named = {folder for n in numbers[-KEPT:] for folder in self._read(n).parts.values()}
        old = {folder for n in numbers[:-KEPT] for folder in self._read(n).parts.values()} - named
        for folder in old:
            self._system.delete(self._file(folder), True)
        for number in numbers[:-KEPT]:
            self._system.delete(self._file(f"_log/{number:08d}.json"), False)

    def parts_of(self, folder: str, column: str) -> dict[str, str]:
        """The parts that a write partitioned by `column` has left in a folder."""
        path = self._file(folder)
        names = [s.getPath().getName() for s in self._system.listStatus(path)] if self._system.exists(path) else []
        return {n.removeprefix(f"{column}="): f"{folder}/{n}" for n in names if n.startswith(f"{column}=")}

    def read(self, entry: Entry, parts: list[str] | None = None, format: str = "parquet") -> DataFrame:
        """The rows of the parts that count, or of some of them: folders of other parts are not listed."""
        folders = [f"{self.path}/{folder}" for part, folder in sorted(entry.parts.items()) if parts is None or part in parts]
        if not folders:
            return self._spark.createDataFrame([], entry.schema)
        return self._spark.read.schema(entry.schema).format(format).load(folders)


def fitted(df: DataFrame, stored: T.StructType) -> DataFrame:
    """`df` as a load into a target of the schema `stored`: by name, in the stored order.

    Refused are missing and extra columns, and types that only a lossy cast could fit.
    """
    have = {f.name.lower(): f for f in df.schema.fields}
    want = {f.name.lower(): f for f in stored.fields}
    missing = [f.name for key, f in want.items() if key not in have]
    extra = [f.name for key, f in have.items() if key not in want]
    if missing or extra:
        raise ValueError(f"the target's columns differ: missing {missing}, not stored there {extra}")
    other = [f"{f.name} is {have[k].dataType.simpleString()}, stored as {f.dataType.simpleString()}" for k, f in want.items() if not _fits(have[k].dataType, f.dataType)]
    if other:
        raise ValueError(f"the target's types differ: {'; '.join(other)}")
    return df.select([df[f"`{have[k].name}`"].cast(f.dataType).alias(f.name) for k, f in want.items()])


_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _fits(given: T.DataType, stored: T.DataType) -> bool:
    """Whether every value of one type is one of the other."""
    if isinstance(given, T.StringType) and isinstance(stored, T.StringType) or given == stored or isinstance(given, T.NullType):
        return True
    if type(given) in _WHOLE_NUMBERS and type(stored) in _WHOLE_NUMBERS:
        return _WHOLE_NUMBERS.index(type(given)) <= _WHOLE_NUMBERS.index(type(stored))
    if isinstance(given, T.DecimalType) and isinstance(stored, T.DecimalType):
        return given.scale <= stored.scale and given.precision - given.scale <= stored.precision - stored.scale
    return isinstance(given, T.FloatType) and isinstance(stored, T.DoubleType)
