"""The batch jobs: build a dataset and load it into its target.

    python -m orderweave.jobs month --source /data/erp --target /warehouse/po --day 2024-12-31
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.windows import last_months, month_to_date
from .plans import (
    Stages,
    enrich_with_distributor,
    po_tracking_by_delivery,
    po_tracking_month,
    so_tracking_inquiry,
    so_tracking_no_inquiry,
)
from .session import tune
from .sinks import Target, replace, replace_period, with_source_text_dates, with_text_dates
from .sinks.warehouse import TEXT_DATES
from .sources import JdbcSource, Tables
from .sources.schema import BUCKET_COLUMNS, MONTH_COLUMNS, SOURCE_TABLES, STORED_MONTH

# Default target names.
TARGETS = {
    "month": "po_tracking_mtd",
    "quarter": "po_tracking_3m",
    "inquiry": "so_tracking_inquiry",
    "no-inquiry": "so_tracking_no_inquiry",
}


def build(tables: Tables, dataset: str, day: date, stages: Stages | None = None) -> DataFrame:
    """A dataset for the month of `day`."""
    month = month_to_date(day)
    if dataset == "month":
        return po_tracking_month(tables, month, stages=stages)
    if dataset == "quarter":
        return po_tracking_by_delivery(tables, last_months(day, 3), month, stages=stages)
    if dataset == "inquiry":
        # Its window is closed, so it ends with the last instant of the month's last day.
        return so_tracking_inquiry(tables, month.up_to_last_instant(), stages=stages)
    if dataset == "no-inquiry":
        return so_tracking_no_inquiry(tables, month, stages=stages)
    raise ValueError(f"unknown dataset: {dataset}")


def load(df: DataFrame, target: Target, month: date | None = None, new_schema: bool = False) -> None:
    """Replace the target, or only the period of the run for `month`, in one step; what does not fit its schema is refused.

    Dates that are not text yet become text with their time.
    """
    dates = [c for c, kind in df.dtypes if kind in ("timestamp_ntz", "timestamp", "date")]
    df = with_text_dates(df, [c for c in TEXT_DATES if c in dates])
    if month is not None:
        replace_period(df, target, month)
    else:
        replace(df, target, new_schema=new_schema)


def run_all(tables: Tables, day: date, targets: dict[str, Target], by_period: bool = False, stages: Stages | None = None) -> None:
    """Load all four datasets of a month: headers, discounts and delivered sums are computed once for them.

    The targets switch one after another, each when its rows are complete.
    """
    stages = stages or Stages(tables.spark, window=last_months(day, 3))
    for dataset, target in targets.items():
        load(build(tables, dataset, day, stages), target, day if by_period else None)


def load_table(tables: Tables, name: str, target: Target) -> None:
    """Copy one base table into the warehouse as it is."""
    replace(tables[name], target)


def stage(
    tables: Tables, database: str, buckets: int, unbucketed: Sequence[str] = ()
) -> None:
    """Copy all base tables into catalog tables: dated headers by month, large tables bucketed by their join column.

    A later `Tables.catalog(spark, database, bucketed=True, by_month=True)` reads
    the headers of its window only and joins the items without shuffling them again.  `buckets` should be at least the number of shuffle
    partitions.  A bucket is read by one task: tables in which one id holds many
    rows belong into `unbucketed`.
    """
    for name, source_name in SOURCE_TABLES.items():
        if name in MONTH_COLUMNS:
            month = F.date_format(MONTH_COLUMNS[name], "yyyy-MM")
            rows = tables[name].withColumn(STORED_MONTH, month).hint("rebalance", STORED_MONTH)
            rows.write.mode("overwrite").partitionBy(STORED_MONTH).saveAsTable(f"{database}.{source_name}")
            continue
        column = None if name in unbucketed else BUCKET_COLUMNS.get(name)
        target = Target(
            table=f"{database}.{source_name}",
            buckets=buckets if column else None,
            bucket_column=column,
        )
        load_table(tables, name, target)


def _source(spark: SparkSession, options: argparse.Namespace) -> Tables:
    """The base tables: a parquet folder, catalog tables, or the database itself."""
    if options.database:
        tables = Tables.catalog(spark, options.database, bucketed=options.staged, by_month=options.staged)
    elif options.jdbc:
        with open(options.jdbc, encoding="utf-8") as file:
            tables = Tables.jdbc(spark, JdbcSource.from_settings(json.load(file)), window=last_months(options.day, 3))
    else:
        tables = Tables.parquet(spark, options.source)
    return tables.with_padded_keys(options.ignore_case) if options.padded or options.ignore_case else tables


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=[*TARGETS, "all", "stage", "copy"], help="a dataset, all four, or copies of base tables")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--source", help="folder with one parquet folder per table")
    source.add_argument("--database", help="catalog database with the base tables")
    parser.add_argument("--staged", action="store_true", help="the database was written by `stage`")
    source.add_argument("--jdbc", help="JSON file with url, options and partitioned reads")
    parser.add_argument("--target", required=True, help="folder of the target tables; for `stage` a database")
    parser.add_argument("--name", help="name of the target table; for `copy` the base table")
    parser.add_argument("--day", type=date.fromisoformat, default=date.today())
    parser.add_argument("--by-period", action="store_true", help="replace only what earlier runs for this month wrote")
    parser.add_argument("--source-dates", action="store_true", help="dates as text in the form that the whole column asks for")
    parser.add_argument("--new-schema", action="store_true", help="the dataset's columns may differ from those stored")
    parser.add_argument("--padded", action="store_true", help="ids and texts compare without trailing blanks")
    parser.add_argument("--ignore-case", action="store_true", help="they also compare without case")
    parser.add_argument("--buckets", type=int, default=200, help="for `stage`")
    parser.add_argument("--unbucketed", nargs="*", default=(), help="for `stage`: tables with ids of many rows")
    parser.add_argument("--distributors", help="parquet folder to join to the dataset")
    parser.add_argument("--distributor-key", nargs=2, metavar=("DATASET_COLUMN", "DISTRIBUTOR_COLUMN"))
    options = parser.parse_args(arguments)

    spark = tune(SparkSession.builder.appName("orderweave").getOrCreate())
    tables = _source(spark, options)
    if options.job == "stage":
        stage(tables, options.target, options.buckets, options.unbucketed)
        return
    if options.job == "copy":
        load_table(tables, options.name, Target(path=f"{options.target}/{options.name}"))
        return
    if options.job == "all":
        run_all(tables, options.day, {dataset: Target(path=f"{options.target}/{name}") for dataset, name in TARGETS.items()}, options.by_period)
        return
    df = build(tables, options.job, options.day, Stages(spark))
    if options.source_dates:
        # read twice, so stored first
        df = with_source_text_dates(Stages(spark).stored("dataset", lambda: df))
    if options.distributors:
        df = enrich_with_distributor(df, spark.read.parquet(options.distributors), tuple(options.distributor_key))
    name = options.name or TARGETS[options.job]
    load(df, Target(path=f"{options.target}/{name}"), options.day if options.by_period else None, options.new_schema)


if __name__ == "__main__":
    main()
