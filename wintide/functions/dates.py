"""Date helpers. "Today" is always an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wintide.functions._cols import ColumnLike, as_col


def elapsed_days(later: ColumnLike, earlier: ColumnLike) -> Column:
    return F.datediff(as_col(later), as_col(earlier))


def elapsed_months31(later: ColumnLike, earlier: ColumnLike) -> Column:
    """31-day months, the first one counted as 1."""
    return (F.floor(F.datediff(as_col(later), as_col(earlier)) / F.lit(31)) + 1).cast("bigint")


def days_left(expires: ColumnLike, as_of: ColumnLike, running: Column) -> Column:
    """Days until ``expires`` for rows that are still running, NULL otherwise."""
    return F.when(running, F.datediff(F.to_date(as_col(expires)), as_col(as_of)))


def yesterday_in(zone: str, instant: ColumnLike) -> Column:
    """The day before the calendar day that ``instant`` (UTC) falls on in ``zone``."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), as_col(instant).cast("timestamp_ntz"))
    return F.date_sub(F.to_date(local), 1)


def quarter_end(day: ColumnLike) -> Column:
    return F.last_day(F.add_months(F.trunc(as_col(day), "quarter"), 2))


def year_quarter(day: ColumnLike) -> Column:
    d = as_col(day)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))
