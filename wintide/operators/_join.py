"""One left/inner/semi join shape used by every operator.

Keys are pairs (left column, right column). The right side is narrowed to what is asked for and its
keys are renamed, so the result has the left columns plus the fetched ones and no ambiguity. No
broadcast hint is set here: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and uses a shuffled join (split by AQE when skewed)
otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = str | Sequence[str | tuple[str, str]]


def key_pairs(on: Keys) -> list[tuple[str, str]]:
    items = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in items]


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Keys,
    columns: Sequence[str | Column] | None = None,
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join ``dim`` to ``df`` and keep the left columns plus ``columns`` (default: all non-keys)."""
    pairs = key_pairs(on)
    right_keys = [r for _, r in pairs]
    if columns is None:
        columns = [c for c in dim.columns if c not in right_keys]
    renamed = [F.col(r).alias(f"__k{i}") for i, r in enumerate(right_keys)]
    right = dim.select(*renamed, *columns)
    conditions = []
    for i, (left, _) in enumerate(pairs):
        rhs = F.col(f"__k{i}")
        conditions.append(F.col(left).eqNullSafe(rhs) if null_safe else F.col(left) == rhs)
    joined = df.join(right, reduce(lambda a, b: a & b, conditions), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__k{i}" for i in range(len(pairs))])


def lookup_many(
    df: DataFrame, dim: DataFrame, on: Keys, columns: Sequence[str | Column] | None = None
) -> DataFrame:
    """Left join for a right side that may repeat one key very often.

    A left join can only split its left side, so a hot right key would stay in one task. Here the
    matches come from an inner join, where either side can be split, and the rows without a match
    from an anti join against distinct keys. ``df`` is read twice; stage it when it is expensive.
    """
    right_keys = [r for _, r in key_pairs(on)]
    matched = lookup(df, dim, on, columns, "inner")
    missed = lookup(df, dim.select(*right_keys).distinct(), on, how="left_anti")
    return matched.unionByName(missed, allowMissingColumns=True)
