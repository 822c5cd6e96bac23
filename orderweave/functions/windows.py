"""Date windows: half-open or closed ranges, passed as parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DateWindow:
    """`[start, end)`, or `[start, end]` when `closed`."""

    start: str
    end: str
    closed: bool = False

    def contains(self, c: Column) -> Column:
        low = F.lit(self.start).cast("timestamp_ntz")
        high = F.lit(self.end).cast("timestamp_ntz")
        return (c >= low) & ((c <= high) if self.closed else (c < high))

    def in_months(self, c: Column) -> Column:
        """Whether a `yyyy-MM` text is a month that the window touches."""
        return (c >= F.lit(self.start[:7])) & (c <= F.lit(self.end[:7]))

    def up_to_last_instant(self) -> DateWindow:
        """The same instants as a closed window; times are stored to the microsecond."""
        if self.closed:
            return self
        last = datetime.fromisoformat(self.end) - timedelta(microseconds=1)
        return DateWindow(self.start, last.isoformat(sep=" "), closed=True)


@dataclass(frozen=True)
class DateFloor:
    """Lower bound of an order date, inclusive or strict."""

    start: str
    inclusive: bool = True

    def admits(self, c: Column) -> Column:
        low = F.lit(self.start).cast("timestamp_ntz")
        return (c >= low) if self.inclusive else (c > low)


def _first_of_month(day: date, shift: int = 0) -> date:
    months = day.year * 12 + day.month - 1 + shift
    return date(months // 12, months % 12 + 1, 1)


def month_to_date(day: date) -> DateWindow:
    """The calendar month of `day`."""
    return last_months(day, 1)


def last_months(day: date, months: int) -> DateWindow:
    """`months` calendar months, the month of `day` being the last."""
    start = _first_of_month(day, 1 - months)
    end = _first_of_month(day, 1)
    return DateWindow(start.isoformat(), end.isoformat())
