"""Date keys and elapsed times on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
DAY = 86400


def date_key(c: Column | str) -> Column:
    """Integer yyyyMMdd of a date or timestamp, NULL for NULL."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def elapsed_seconds(start: str, end: str) -> Column:
    """Exact seconds between two zone-free timestamps as decimal(20,6), negative when end is first."""
    gap = (F.col(end) - F.col(start)).cast("interval second")
    return gap.cast("decimal(20,6)")


def elapsed(start: str, end: str, unit: int) -> Column:
    """Elapsed hours or days, two decimals, halves rounded away from zero."""
    return F.round(elapsed_seconds(start, end) / F.lit(unit), 2).cast("decimal(12,2)")


def period_start(year: str, month: str) -> Column:
    """First day of a (year, month); NULL when either is NULL."""
    return F.make_date(F.col(year), F.col(month), F.lit(1))
