"""Accept a column name or a Column everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value
