"""Value -> label rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wintide.functions._cols import ColumnLike, as_col


def band(
    col: ColumnLike,
    steps: Sequence[tuple[float, str]],
    top: str,
    default: str,
    exact: Mapping[float, str] | None = None,
) -> Column:
    """Label of the first step whose upper bound lies above the value.

    ``exact`` labels single values before the steps are tried; ``top`` takes everything from the
    last bound up; NULL takes ``default``.
    """
    c = as_col(col)
    uppers = [upper for upper, _ in steps]
    if uppers != sorted(uppers):
        raise ValueError("band steps must have ascending upper bounds")
    label = F.when(c.isNull(), F.lit(default))
    for value, text in (exact or {}).items():
        label = label.when(c == value, text)
    for upper, text in steps:
        label = label.when(c < upper, text)
    return label.otherwise(top)


def group_values(
    col: ColumnLike,
    rules: Sequence[tuple[str | None, str | Iterable[str]]],
    default: str | Column | None = None,
) -> Column:
    """First matching rule wins. A rule is (label, values) or (label, LIKE pattern).

    A rule with label None keeps the value itself.
    """
    c = as_col(col)
    label: Column | None = None
    for text, match in rules:
        hit = c.like(match) if isinstance(match, str) else c.isin(*match)
        value = c if text is None else F.lit(text)
        label = F.when(hit, value) if label is None else label.when(hit, value)
    if label is None:
        raise ValueError("at least one rule is needed")
    return label.otherwise(default)


def lifecycle_status(amount: ColumnLike) -> Column:
    """'Customer' while the current amount is positive, else 'Churned' (also when missing)."""
    return F.when(as_col(amount) > 0, "Customer").otherwise("Churned")
