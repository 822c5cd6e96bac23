"""Registry of the base tables a job reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.windows import DateWindow
from .jdbc import JdbcSource
from .schema import MONEY, MONTH_COLUMNS, SOURCE_TABLES, STORED_MONTH, table_schema


class Tables:
    """Base tables by name, each loaded on first use."""

    def __init__(
        self, spark: SparkSession, load: Callable[[str], DataFrame], bucketed: bool = False
    ):
        self.spark = spark
        self.bucketed = bucketed
        #: Whether the headers of `MONTH_COLUMNS` are stored by month.
        self.by_month = False
        #: The type of the tables' text columns.
        self.text = "string"
        self._load = load
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> Tables:
        return cls(spark, frames.__getitem__)

    @classmethod
    def parquet(cls, spark: SparkSession, root: str, money: T.DataType = MONEY) -> Tables:
        """One parquet directory per table under `root`, read with a fixed schema."""
        return cls(
            spark,
            lambda name: spark.read.schema(table_schema(name, money)).parquet(f"{root}/{name}"),
        )

    @classmethod
    def catalog(
        cls,
        spark: SparkSession,
        database: str,
        money: T.DataType = MONEY,
        bucketed: bool = False,
        by_month: bool = False,
    ) -> Tables:
        """Catalog tables under their source names.

        `bucketed` says that they are bucketed by `BUCKET_COLUMNS`; items are
        then read in place instead of being shuffled.  `by_month`: the dated
        headers are partitioned by month, as `jobs.stage` writes them, and a run
        reads the months of its window only.
        """

        def load(name: str) -> DataFrame:
            stored = spark.table(f"{database}.{SOURCE_TABLES[name]}")
            return conform(stored, name, money, (STORED_MONTH,) if by_month and name in MONTH_COLUMNS else ())

        tables = cls(spark, load, bucketed)
        tables.by_month = by_month
        return tables

    @classmethod
    def jdbc(cls, spark: SparkSession, source: JdbcSource, money: T.DataType = MONEY, window: DateWindow | None = None) -> Tables:
        """Tables of the database; `window`, the dates of the run, says how reads of dated tables are split."""
        return cls(
            spark, lambda name: conform(source.read(spark, name, SOURCE_TABLES[name], window), name, money)
        )

    def with_padded_keys(self, ignore_case: bool = False) -> Tables:
        """Texts that compare as in the source: without trailing blanks, or also without case.

        Every comparison, join, group and DISTINCT of the plans follows; the texts
        themselves stay as they are.
        """
        tables = Tables(self.spark, lambda name: collated(self[name], ignore_case))
        tables.by_month = self.by_month
        tables.text = f"string collate {collation(ignore_case)}"
        return tables

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]


def conform(df: DataFrame, name: str, money: T.DataType = MONEY, more: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns of a table in their declared types, and `more` columns as they are."""
    declared = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(name, money).fields]
    return df.select(*declared, *more)


def collation(ignore_case: bool) -> str:
    return "UTF8_LCASE_RTRIM" if ignore_case else "UTF8_BINARY_RTRIM"


def collated(df: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Text columns under a padded, optionally case-insensitive collation."""
    return df.select(
        [
            (F.collate(f.name, collation(ignore_case)) if isinstance(f.dataType, T.StringType) and f.name != STORED_MONTH else F.col(f.name)).alias(f.name)
            for f in df.schema.fields
        ]
    )
