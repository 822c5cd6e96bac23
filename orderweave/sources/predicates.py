"""Partitions of a database read, as predicates: by month of a date column and by hash of a key.

Every row of the table, NULLs included, satisfies exactly one predicate of a list. Spark
sends the plan's own filters along with each, so partitions outside a run's dates end
without a row; completeness does not depend on it.
"""

from __future__ import annotations

from datetime import date

from ..functions.windows import DateWindow

#: T-SQL: a non-negative hash of a key, which it also has for NULL.
T_SQL_HASH = "(CHECKSUM({key}) & 2147483647)"


def hash_predicates(key: str, buckets: int, hash_sql: str = T_SQL_HASH) -> list[str]:
    """`buckets` classes of rows by their key; rows without one are in the first."""
    if buckets < 1:
        raise ValueError("a read has at least one bucket")
    if buckets == 1:
        return ["1 = 1"]
    place = f"{hash_sql.format(key=key)} % {buckets}"
    first = f"({key} IS NULL OR {place} = 0)"
    return [first, *(f"({key} IS NOT NULL AND {place} = {k})" for k in range(1, buckets))]


def month_starts(window: DateWindow) -> list[str]:
    """The window's start, the firsts of the months inside it, and its end."""
    first, last = date.fromisoformat(window.start[:10]), date.fromisoformat(window.end[:10])
    number, found = first.year * 12 + first.month, [window.start]
    while (start := date(number // 12, number % 12 + 1, 1)) < last:
        found.append(start.isoformat())
        number += 1
    return [*found, window.end] if window.end > found[-1] else found


def month_predicates(column: str, window: DateWindow) -> list[str]:
    """One class for each month that the window touches, and for the rows before, after and without a date."""
    starts = month_starts(window)
    inside = [f"({column} >= '{a}' AND {column} < '{b}')" for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return [f"{column} < '{starts[0]}'", *inside, f"{column} >= '{starts[-1]}'", f"{column} IS NULL"]


def read_predicates(key: str | None, column: str | None, window: DateWindow | None, buckets: int, hash_sql: str = T_SQL_HASH) -> list[str]:
    """The partitions of one table: months of its window, each of them and all else split by its key."""
    hashes = hash_predicates(key, buckets, hash_sql) if key else ["1 = 1"]
    if column is None or window is None:
        return hashes
    *dated, missing = month_predicates(column, window)
    return [*(f"{d} AND {h}" for d in dated for h in hashes), missing]
