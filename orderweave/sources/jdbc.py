"""Reading base tables from the source database over JDBC.

Address, login and driver come from the caller; nothing is stored here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.windows import DateWindow
from .predicates import T_SQL_HASH, read_predicates
from .schema import BUCKET_COLUMNS, MONTH_COLUMNS


@dataclass(frozen=True)
class PartitionedRead:
    """Splits one table read into `partitions` range queries on `column`."""

    column: str
    lower: str
    upper: str
    partitions: int


#: Header and item tables: one connection would pull each of them through one task.
LARGE_TABLES = (
    "sales_inquiry",
    "sales_order",
    "sales_order_item",
    "purchase_order",
    "purchase_order_item",
    "bonus_source",
    "delivery_order",
    "delivery_confirmation_item",
    "invoice",
    "invoice_item",
)


@dataclass(frozen=True)
class JdbcSource:
    """A database and how its tables are read; stage it first if several datasets are built from it."""

    url: str
    options: dict[str, str] = field(default_factory=dict)
    partitioned: dict[str, PartitionedRead] = field(default_factory=dict)
    fetch_size: int = 10_000
    #: Parts by key of each read of a large table, and of each month of it; without bounds of its own.
    buckets: int = 0
    hash_sql: str = T_SQL_HASH

    def __post_init__(self) -> None:
        if self.buckets:
            return
        missing = [name for name in LARGE_TABLES if name not in self.partitioned]
        if missing:
            raise ValueError(f"reads of these tables need partition bounds: {missing}")

    @classmethod
    def from_settings(cls, settings: dict) -> JdbcSource:
        """From plain values: `url`, `options`, `partitioned` (table to its bounds), `fetch_size`."""
        splits = {name: PartitionedRead(**bounds) for name, bounds in settings.get("partitioned", {}).items()}
        return cls(**{**settings, "partitioned": splits})

    def read_options(self, name: str, source_table: str) -> dict[str, str]:
        settings = {
            "url": self.url,
            "dbtable": source_table,
            "fetchsize": str(self.fetch_size),
            # The source has no time zones: keep its times as they are.
            "preferTimestampNTZ": "true",
            **self.options,
        }
        split = self.partitioned.get(name)
        if split is not None:
            settings.update(
                partitionColumn=split.column,
                lowerBound=split.lower,
                upperBound=split.upper,
                numPartitions=str(split.partitions),
            )
        return settings

    def predicates(self, name: str, window: DateWindow | None = None) -> list[str]:
        """The partitions of a read that has no bounds; one for small tables."""
        if name not in LARGE_TABLES or not self.buckets:
            return []
        return read_predicates(BUCKET_COLUMNS.get(name), MONTH_COLUMNS.get(name), window, self.buckets, self.hash_sql)

    def read(self, spark: SparkSession, name: str, source_table: str, window: DateWindow | None = None) -> DataFrame:
        """Lazy scan; Spark sends its filters and column list to the database, a query for each partition.

        Partitions are the bounds given for the table, or made from the `window` of the
        run and the table's key.
        """
        predicates = [] if name in self.partitioned else self.predicates(name, window)
        if predicates:
            options = {k: v for k, v in self.read_options(name, source_table).items() if k not in ("url", "dbtable")}
            return spark.read.jdbc(self.url, source_table, predicates=predicates, properties=options)
        return spark.read.format("jdbc").options(**self.read_options(name, source_table)).load()
