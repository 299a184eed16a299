"""Text and key helpers. All of them stay inside Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wintide.functions._cols import ColumnLike, as_col


def normalize_id(col: ColumnLike, mode: str = "numeric") -> Column:
    """Comparable account key from dirty text such as ``"123.0"``.

    ``numeric`` parses a number, rounds halves away from zero and gives a BIGINT; text that is no
    number gives NULL. ``prefix`` keeps the text before the first dot.
    """
    c = as_col(col)
    if mode == "numeric":
        return F.round(c.cast("string").try_cast("double")).try_cast("bigint")
    if mode == "prefix":
        return F.substring_index(c, ".", 1)
    raise ValueError(f"unknown mode {mode!r}")


def composite_key(*cols: ColumnLike) -> Column:
    """Concatenated id where a NULL part counts as empty text."""
    return F.concat(*[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])


def split_name(col: ColumnLike) -> tuple[Column, Column]:
    """(first word, everything after the first blank); a one-word name fills both."""
    c = as_col(col)
    rest = F.when(c.rlike(r"\s"), F.regexp_extract(c, r"\s(.*)", 1)).otherwise(c)
    return F.substring_index(c, " ", 1), rest


def role_label(left: ColumnLike, right: ColumnLike) -> Column:
    """'Owner' when both sides are equal, else 'Admin' (also when one is NULL)."""
    return F.when(as_col(left) == as_col(right), "Owner").otherwise("Admin")


def presence_flag(condition: Column) -> Column:
    """'1' when the condition holds, '0' when it is false or NULL."""
    return F.when(condition, "1").otherwise("0")


def transition(before: ColumnLike, after: ColumnLike, default: str | None = None) -> Column:
    """``"A to B"``; a missing end state becomes ``default``, a missing start gives NULL."""
    end = as_col(after)
    if default is not None:
        end = F.coalesce(end, F.lit(default))
    return F.concat(as_col(before), F.lit(" to "), end)


def distinct_list(col: ColumnLike, condition: Column | None = None) -> Column:
    """Aggregate: sorted, comma-separated distinct values; NULL when there is none.

    The set holds distinct values only and is merged map-side, so its size follows the catalogue of
    values and not the number of rows.
    """
    c = as_col(col).cast("string")
    values = F.collect_set(c if condition is None else F.when(condition, c))
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), ","))
