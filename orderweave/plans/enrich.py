"""Joining a loaded dataset with the distributor table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import skew_join


def enrich_with_distributor(
    dataset: DataFrame,
    distributors: DataFrame,
    on: tuple[str, str],
    *,
    heavy_keys: tuple[str, ...] = (),
    salts: int = 64,
) -> DataFrame:
    """Left join on the caller's key pair; `heavy_keys` are frequent keys of the dataset."""
    left, right = on
    collation = getattr(dataset.schema[left].dataType, "collation", "UTF8_BINARY")
    if collation != "UTF8_BINARY":  # the dataset's texts say how keys compare
        distributors = distributors.withColumn(right, F.collate(right, collation))
    return skew_join(dataset, distributors, [on], "left", heavy_left=heavy_keys, salts=salts)
