"""Wide assembly: left-join chains, source fallback, owner hierarchy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.functions import presence_flag
from wintide.operators._join import Keys, key_pairs, lookup
from wintide.operators.temporal import current_rows, scd2_as_of


@dataclass(frozen=True)
class Feature:
    """One table to attach: its frame, the join keys and an optional '1'/'0' presence column.

    ``unique`` states that the table has one row per key. The plan then holds it to that: see ``one_per_key``.
    """

    df: DataFrame
    on: Keys
    columns: Sequence[str] | None = None
    flag: str | None = None
    unique: bool = False


def account_360(driver: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Attach every feature by a left join.

    Features are joined key by key (in order of first use), so the driver is shuffled once per
    distinct key and not once per change of key; columns come out in the order of ``features``. A
    feature with several rows per key repeats the driver row, as a left join does, unless it is stated to
    be ``unique``: then different rows under one key make the query fail. Give the driver one row per
    account: rows of a hot driver key stay together through the whole chain. If the driver's rows are
    distinct and every feature is unique or distinct, so is the result, without a distinct over its width.
    """
    by_key: dict[tuple[str, ...], list[Feature]] = {}
    for feature in features:
        left_keys = tuple(left for left, _ in key_pairs(feature.on))
        by_key.setdefault(left_keys, []).append(feature)
    out = driver
    for feature in [f for group in by_key.values() for f in group]:
        wanted: list[str | Column] = list(_feature_columns(feature))
        if feature.flag is not None:
            wanted.append(F.lit(True).alias("__hit"))
        right = feature.df
        if feature.unique:
            right_keys = [r for _, r in key_pairs(feature.on)]
            right = one_per_key(right.select(*right_keys, *[c for c in _feature_columns(feature) if c not in right_keys]), right_keys)
        out = lookup(out, right, feature.on, wanted)
        if feature.flag is not None:
            out = out.withColumn(feature.flag, presence_flag(F.col("__hit"))).drop("__hit")
    added = []
    for feature in features:
        added += [*_feature_columns(feature), *([feature.flag] if feature.flag else [])]
    return out.select(*driver.columns, *added)


def _feature_columns(feature: Feature) -> Sequence[str]:
    if feature.columns is not None:
        return feature.columns
    right_keys = [r for _, r in key_pairs(feature.on)]
    return [c for c in feature.df.columns if c not in right_keys]


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The one row of each key; two different rows under one key fail the query that reads them.

    The check is part of the plan, not an action: one aggregate by key gives the least and the greatest
    row, and a filter raises where they differ, naming the key. Repeats of the same row become one,
    and combine before the shuffle, which the following join on the key uses too. Rows with a NULL in
    the key are left out, as nothing joins to them. Columns are of types that can be ordered (no maps).
    """
    others = [c for c in df.columns if c not in keys]
    known = df.dropna(subset=list(keys))
    if not others:
        return known.distinct()
    row = F.struct(*others)
    both = known.groupBy(*keys).agg(F.min(row).alias("__least"), F.max(row).alias("__most"))
    key = F.to_json(F.struct(*keys))
    problem = F.raise_error(F.concat(F.lit("several rows for one key: "), key))
    held = both.filter(F.when(F.col("__least") == F.col("__most"), True).otherwise(problem.cast("boolean")))
    return held.select(*keys, "__least.*")


def coalesce_sources(
    df: DataFrame,
    sources: Sequence[tuple[DataFrame, str | tuple[str, str]]],
    fields: Sequence[str],
) -> DataFrame:
    """Per-field first non-NULL value over several feeds, each joined on its own key."""
    out = df
    for i, (source, key) in enumerate(sources):
        picked = [F.col(f).alias(f"__{i}_{f}") for f in fields if f in source.columns]
        out = lookup(out, source, [key], picked)
    filled = {}
    for f in fields:
        parts = [F.col(f"__{i}_{f}") for i, (s, _) in enumerate(sources) if f in s.columns]
        filled[f] = F.coalesce(*parts)
    out = out.withColumns(filled)
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def owner_chain(
    df: DataFrame,
    account_key: str,
    accounts: DataFrame,
    users: DataFrame,
    roles: DataFrame,
    at: Column | None = None,
    account_columns: Sequence[str | Column] = (),
    user_columns: Sequence[str | Column] = (),
    role_columns: Sequence[str | Column] = (),
    owner: str = "ownerid",
    slice_months: int | None = None,
    reach_of: DataFrame | None = None,
) -> DataFrame:
    """Account -> owner -> role, current rows by default or the versions valid at ``at``.

    ``accounts``(id, owner column), ``users``(id, userroleid) and ``roles``(id) are SCD2 tables.
    Current accounts also leave out deleted ones. Every join is a left join, so ownerless accounts
    stay.
    """
    steps = [
        (accounts, account_key, [F.col(owner).alias("__owner"), *account_columns], "isdeleted"),
        (users, "__owner", [F.col("userroleid").alias("__role"), *user_columns], None),
        (roles, "__role", list(role_columns), None),
    ]
    out = df
    for dim, key, columns, deleted in steps:
        if at is None:
            out = lookup(out, current_rows(dim, not_deleted=deleted), [(key, "id")], columns)
        else:
            out = scd2_as_of(
                out,
                dim,
                [(key, "id")],
                at,
                columns=columns,
                slice_months=slice_months,
                reach_of=reach_of,
            )
    return out.drop("__owner", "__role")
