"""Warehouse targets: full replacement, and replacement run by run, each in one step.

A load writes a new version beside the old one and then switches: the next log entry of a
folder (`versions.py`), or the location of a catalog table or of one of its partitions.
The first load of a target makes its schema the contract of all later ones.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import WHOLE, Versions, fitted

# Fixed value: the column the warehouse receives as text.
TEXT_DATES = ("date_created",)
PERIOD = "period"
# The folders of a load of several periods; the column itself is stored in the files.
_FOLDER = "run"


@dataclass(frozen=True)
class Target:
    """A folder (`path`) or a catalog table (`table`), the latter optionally bucketed."""

    path: str | None = None
    table: str | None = None
    format: str = "parquet"
    buckets: int | None = None
    bucket_column: str | None = None

    def __post_init__(self) -> None:
        if (self.path is None) == (self.table is None):
            raise ValueError("a target is either a path or a table")
        if self.buckets is not None and (self.table is None or self.bucket_column is None):
            raise ValueError("buckets need a table and a column")

    def read(self, spark: SparkSession, periods: Sequence[str] | None = None) -> DataFrame:
        """The rows that count now; with `periods` (`yyyy-MM`) those of these runs only."""
        if self.table is not None:
            df = spark.table(self.table)
            return df if periods is None else df.where(F.col(PERIOD).isin(list(periods)))
        versions = Versions(spark, self.path)
        entry = versions.last()
        if entry is None:
            raise ValueError(f"nothing was loaded into {self.path}")
        return versions.read(entry, None if periods is None else list(periods), self.format)

    def schema(self, spark: SparkSession) -> T.StructType | None:
        """The stored schema, without the period; None before the first load."""
        if self.table is not None:
            stored = spark.table(self.table).schema if spark.catalog.tableExists(self.table) else None
        else:
            entry = Versions(spark, self.path).last()
            stored = entry.schema if entry else None
        return T.StructType([f for f in stored.fields if f.name != PERIOD]) if stored else None


def with_source_text_dates(df: DataFrame, columns: Sequence[str] = TEXT_DATES, missing: str = "NaT") -> DataFrame:
    """Dates as the source's loader writes them: in one form, which the whole column decides.

    No time where every row is at midnight, no fraction where every row is at a whole second, and else
    three or six places, as many as some row needs; `missing` where there is no date. A first pass over the columns
    decides, in the same plan (a scalar subquery), so the frame should be a stored one.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    micros = lambda c: F.pmod(F.unix_micros(F.col(c).cast("timestamp")), F.lit(1_000_000))
    form = lambda c: (
        F.when(F.bool_or(F.pmod(micros(c), F.lit(1000)) != 0), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .when(F.bool_or(micros(c) != 0), "yyyy-MM-dd HH:mm:ss.SSS")
        .when(F.bool_or(F.col(c) != F.date_trunc("day", c)), "yyyy-MM-dd HH:mm:ss")
        .otherwise("yyyy-MM-dd")
    )
    forms = df.agg(*[form(c).alias(c) for c in present])
    return df.withColumns({c: F.coalesce(F.call_function("date_format", F.col(c), forms.select(c).scalar()), F.lit(missing)) for c in present})


def with_text_dates(df: DataFrame, columns: Sequence[str] = TEXT_DATES) -> DataFrame:
    """Dates as text with their time, for those of the columns the frame has."""
    present = set(df.columns)
    return df.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns if c in present}
    )


def check_columns(df: DataFrame, expected: Sequence[str] | None = None) -> None:
    """Refuse repeated names, which no file format stores, and unexpected columns."""
    counts = Counter(c.lower() for c in df.columns)
    repeated = sorted(c for c, n in counts.items() if n > 1)
    if repeated:
        raise ValueError(f"repeated column names: {repeated}")
    if expected is not None and list(expected) != df.columns:
        raise ValueError(f"columns {df.columns} differ from {list(expected)}")


def _contracted(df: DataFrame, target: Target, expected: Sequence[str] | None = None) -> DataFrame:
    """The rows as the target stores them, or a refusal."""
    check_columns(df, expected)
    stored = target.schema(df.sparkSession)
    return df if stored is None else fitted(df, stored)


def replace(df: DataFrame, target: Target, expected: Sequence[str] | None = None, new_schema: bool = False) -> None:
    """Replace the whole target; its schema stays, unless `new_schema` says that it may change.

    The files are the partitions of the last stage, which Spark sizes by their
    actual bytes.  Rows of a bucketed table are brought to their bucket first,
    one file each.
    """
    if new_schema:
        check_columns(df, expected)
    else:
        df = _contracted(df, target, expected)
    if target.table is not None:
        _replace_table(df, target)
        return
    versions = Versions(df.sparkSession, target.path)
    before, folder = versions.last(), versions.new_folder()
    df.write.format(target.format).save(f"{target.path}/{folder}")
    versions.commit(before, df.schema, {WHOLE: folder})


def replace_period(df: DataFrame, target: Target, month: date) -> None:
    """Replace what the run for `month` has written before, and nothing else.

    The period is the run's, not a date of the rows: a run may hold rows of
    neighbouring months, which belong to it all the same.  A run without rows
    empties its period.  Columns are matched by name to those stored.
    """
    df = _contracted(df, target)
    period = f"{month:%Y-%m}"
    if target.table is not None:
        _replace_partition(df, target, period)
        return
    versions = Versions(df.sparkSession, target.path)
    before, folder = versions.last(), versions.new_folder()
    stored = df.withColumn(PERIOD, F.lit(period))
    stored.write.format(target.format).save(f"{target.path}/{folder}")
    parts = {part: f for part, f in before.parts.items() if part != WHOLE} if before else {}
    versions.commit(before, stored.schema, {**parts, period: folder})


def replace_periods(df: DataFrame, target: Target, date_column: str) -> None:
    """Load the runs of all months that the rows are of, as `replace_period` does one: written together, switched together.

    Rows without a date belong to no run and are refused. A table's partitions switch one after another.
    """
    period = F.date_format(date_column, "yyyy-MM")
    replace_months(df.withColumn(PERIOD, F.coalesce(period, F.raise_error(F.lit(f"a row without {date_column}")).cast("string"))), target)


def replace_months(df: DataFrame, target: Target, months: Sequence[str] = ()) -> None:
    """Replace the periods that the rows name in their column `period`, and those in `months`, which may have none."""
    spark = df.sparkSession
    rows = _contracted(df.drop(PERIOD), target)  # refusals come before any work
    dated = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in rows.schema.fields], PERIOD)
    if target.table is not None:
        named = {r[0] for r in dated.select(PERIOD).distinct().collect()}
        for month in sorted(named | set(months)):
            _replace_partition(dated.where(F.col(PERIOD) == month).drop(PERIOD), target, month)
        return
    versions = Versions(spark, target.path)
    before, folder = versions.last(), versions.new_folder()
    writer = dated.withColumn(_FOLDER, F.col(PERIOD)).hint("rebalance", _FOLDER).write
    writer.format(target.format).partitionBy(_FOLDER).save(f"{target.path}/{folder}")
    parts = {part: f for part, f in before.parts.items() if part != WHOLE and part not in months} if before else {}
    versions.commit(before, dated.schema, {**parts, **versions.parts_of(folder, _FOLDER)})


# Catalog tables: files are written under names of their own, then a location is set.


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _location(spark: SparkSession, table: str, part: str = "") -> str:
    rows = spark.sql(f"describe table extended {table} {part}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _versions(spark: SparkSession, table: str) -> str:
    """The folder of a table's versions, beside where a managed table of its name would be."""
    if spark.catalog.tableExists(table):
        return f"{_location(spark, table).split('.versions/')[0]}.versions"
    *database, name = table.split(".")
    home = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{name}.versions"


def _keep_only(spark: SparkSession, folder: str, *kept: str) -> None:
    """Remove the versions in a folder but for the new one and the one before, which may still be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {k.rsplit("/", 1)[-1] for k in kept}
    for status in system.listStatus(path) if system.exists(path) else []:
        if status.getPath().getName() not in names:
            system.delete(status.getPath(), True)


def _writer(df: DataFrame, target: Target, folder: str) -> DataFrameWriter:
    writer = df.write.format(target.format).option("path", folder)
    if target.buckets is not None:
        writer = writer.bucketBy(target.buckets, target.bucket_column).sortBy(target.bucket_column)
    return writer


def _replace_table(df: DataFrame, target: Target) -> None:
    spark = df.sparkSession
    if target.buckets is not None:
        df = df.repartition(target.buckets, target.bucket_column)
    stored = spark.table(target.table).schema if spark.catalog.tableExists(target.table) else None
    versions, name = _versions(spark, target.table), os.urandom(8).hex()
    folder = f"{versions}/{name}"
    if stored is None or stored != df.schema:
        _writer(df, target, folder).mode("overwrite").saveAsTable(target.table)  # the first load, or a new schema
        return
    before, draft = _location(spark, target.table), f"{target.table}__{name}"
    # as a table, because only tables are bucketed; its files outlive it
    _writer(df, target, folder).saveAsTable(draft)
    try:
        spark.sql(f"alter table {target.table} set location {_literal(folder)}")
        spark.catalog.refreshTable(target.table)
    finally:
        spark.sql(f"drop table {draft}")
    _keep_only(spark, versions, before, folder)


def _replace_partition(df: DataFrame, target: Target, period: str) -> None:
    spark = df.sparkSession
    versions = _versions(spark, target.table)
    if not spark.catalog.tableExists(target.table):
        empty = df.where(F.lit(False)).withColumn(PERIOD, F.lit(period))
        empty.write.format(target.format).option("path", f"{versions}/{os.urandom(8).hex()}").partitionBy(PERIOD).saveAsTable(target.table)
    own = f"{versions}/{PERIOD}={period}"
    folder = f"{own}/{os.urandom(8).hex()}"
    df.write.format(target.format).save(folder)
    part = f"partition ({PERIOD} = {_literal(period)})"
    known = not spark.sql(f"show partitions {target.table}").where(F.col("partition") == f"{PERIOD}={period}").isEmpty()
    before = _location(spark, target.table, part) if known else folder
    change = f"{part} set location" if known else f"add {part} location"
    spark.sql(f"alter table {target.table} {change} {_literal(folder)}")
    spark.catalog.refreshTable(target.table)
    _keep_only(spark, own, before, folder)
