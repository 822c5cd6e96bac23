"""Null defaults and blank tests.

The source system pads and blanks its ids instead of leaving them NULL, and its
string comparison ignores trailing blanks.  Spark's does not, so every blank
test in this package goes through the functions below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date that stands for "no date" in every dataset.
NO_DATE = "1900-01-01"


def no_date() -> Column:
    return F.lit(NO_DATE).cast("timestamp_ntz")


def date_or_default(c: Column) -> Column:
    return F.coalesce(c, no_date())


def date_or_parts(c: Column, year: int = 1900, month: int = 1, day: int = 1) -> Column:
    """Default a date to one built from its parts."""
    return F.coalesce(c, F.make_date(F.lit(year), F.lit(month), F.lit(day)))


def text_or_default(c: Column, default: str = "") -> Column:
    return F.coalesce(c, F.lit(default))


def number_or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def flag_or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_blank(c: Column) -> Column:
    """NULL, empty or only spaces; never NULL itself."""
    return F.coalesce(F.trim(c), F.lit("")) == ""


def is_empty(c: Column) -> Column:
    """Empty or only spaces; NULL for NULL, so a filter drops the row."""
    return F.rtrim(c) == ""


def not_empty(c: Column) -> Column:
    return F.rtrim(c) != ""


def is_empty_id(c: Column) -> Column:
    """`is_empty` for a scan of an id column.

    Texts of only spaces sort before "!", and that comparison reaches the
    parquet statistics: row groups without blank ids are not read.
    """
    return (c < "!") & (F.rtrim(c) == "")


def trimmed(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))
