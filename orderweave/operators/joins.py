"""Join operators of the order-tracking datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anti_join_null_aware(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, candidates: DataFrame | None = None
) -> DataFrame:
    """Rows of `left` for which SQL's `left_key NOT IN (right)` is true.

    Spark broadcasts the whole subquery of a NOT IN.  Here one row of counts
    decides the NULL cases, and the rest is a shuffled anti join on keys that
    were de-duplicated before the shuffle.  `candidates`, if given, are the rows of
    `right` that a key of `left` may equal.
    """
    keys = right.select(F.col(right_key).alias("_key"))
    counts = keys.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_key").isNull()).alias("n_null")
    )
    rows = counts.select("n").scalar()
    null_rows = counts.select("n_null").scalar()
    comparable = (rows == 0) | ((null_rows == 0) & F.col(left_key).isNotNull())
    if candidates is not None:
        keys = candidates.select(F.col(right_key).alias("_key"))
    distinct_keys = keys.where(F.col("_key").isNotNull()).distinct()
    return left.where(comparable).join(
        distinct_keys, F.col(left_key) == F.col("_key"), "left_anti"
    )


def flag_states(flags: DataFrame, key: str, flag: str) -> DataFrame:
    """One row per key telling which values its flag takes: false, NULL."""
    return flags.groupBy(F.col(key).alias("_flag_key")).agg(
        F.bool_or(~F.col(flag)).alias("_has_false"),
        F.bool_or(F.col(flag).isNull()).alias("_has_null"),
    )


def surviving_flags(joined: DataFrame, flag: str) -> DataFrame:
    """After a left join to `flag_states`: one row per flag value other than true."""
    false, null = F.lit(False), F.lit(None).cast("boolean")
    states = (
        F.when(F.col("_flag_key").isNull(), F.array(null))
        .when(F.col("_has_false") & F.col("_has_null"), F.array(false, null))
        .when(F.col("_has_false"), F.array(false))
        .when(F.col("_has_null"), F.array(null))
        .otherwise(F.array().cast("array<boolean>"))
    )
    return joined.withColumn(flag, F.explode(states)).drop("_flag_key", "_has_false", "_has_null")
