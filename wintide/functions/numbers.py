"""Arithmetic helpers with the NULL and zero rules the reports rely on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wintide.functions._cols import ColumnLike, as_col


def _all_present(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def strict_greatest(*cols: ColumnLike) -> Column:
    """Largest value, NULL as soon as one input is NULL (Spark's own skips NULLs)."""
    parts = [as_col(c) for c in cols]
    return F.when(_all_present(parts), F.greatest(*parts))


def strict_least(*cols: ColumnLike) -> Column:
    """Smallest value, NULL as soon as one input is NULL."""
    parts = [as_col(c) for c in cols]
    return F.when(_all_present(parts), F.least(*parts))


def ratio(top: ColumnLike, bottom: ColumnLike, safe: bool = True) -> Column:
    """Quotient; a zero divisor gives NULL when ``safe``, else it raises under ANSI mode."""
    if safe:
        return F.try_divide(as_col(top), as_col(bottom))
    return as_col(top) / as_col(bottom)


def pct_change(now: ColumnLike, then: ColumnLike) -> Column:
    """Percent change from ``then`` to ``now``; a zero base counts as one."""
    base = as_col(then)
    return F.try_divide(as_col(now) - base, F.when(base == 0, F.lit(1)).otherwise(base)) * 100.0


def complement(probability: ColumnLike) -> Column:
    return F.try_subtract(F.lit(1.0), as_col(probability))


def weighted_level(level: ColumnLike, quantity: ColumnLike, condition: Column) -> Column:
    """Aggregate: quantity-weighted level, rounded; NULL when the total quantity is zero."""
    lv, qty = as_col(level), as_col(quantity)
    weighted = F.sum(F.when(condition, lv * qty).otherwise(0))
    return F.round(F.try_divide(weighted, F.sum(F.when(condition, qty).otherwise(0))))


def license_floor(seats: Column, licensed: Column, floor: int = 1000) -> Column:
    """Seats, but never under ``floor`` where the BOOLEAN ``licensed`` holds.

    Aggregate the licence as a BOOLEAN (``max(flag = 'Y')``): a text maximum would make the whole
    aggregation sort-based.
    """
    return F.when(licensed, strict_greatest(seats, F.lit(floor))).otherwise(seats)
