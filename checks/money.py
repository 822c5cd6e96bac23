"""Comparing money across engines.

Both engines add doubles, in different orders.  Amounts are compared on a grid
of 0.0001 whose cell borders lie off the short decimals the data is made of, so
a last-bit difference never moves a value to the next cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BORDER = 0.4871


def on_grid(c: Column) -> Column:
    return F.floor(c * 10000 + F.lit(BORDER)) / F.lit(10000.0)


def money_on_grid(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: on_grid(F.col(c)) for c in columns})


def grid_sql(expression: str) -> str:
    return f"floor(({expression}) * 10000 + {BORDER}e0) / 10000e0"
