"""Latest-row and highest-value lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    `order` must be total, or ties fall at random.  Spark keeps one candidate
    per key and task before the shuffle.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def top_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row of the whole frame (one row, or none)."""
    return df.orderBy(*order).limit(1)


def join_top_row(
    left: DataFrame, right: DataFrame, on: tuple[str, str], order: Sequence[Column]
) -> DataFrame:
    """Left join to the single first row of `right`."""
    first = F.broadcast(top_row(right, order))
    return left.join(first, F.col(on[0]) == F.col(on[1]), "left")


def highest(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(name))
