"""Tenure milestones, windows, month offsets and the lead funnel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.functions import elapsed_days, strict_greatest
from wintide.operators._join import lookup


def milestones(
    df: DataFrame, start: str, days: Sequence[int], as_of: Column, prefix: str = "date_"
) -> DataFrame:
    """``start + n days`` per n; NULL while ``as_of`` has not reached it."""
    reached = {}
    for n in days:
        mark = F.date_add(start, n)
        reached[f"{prefix}{n}"] = F.when(as_of >= mark, mark)
    return df.withColumns(reached)


def tenure_windows(
    accounts: DataFrame,
    events: DataFrame,
    key: str,
    start: str,
    event_date: str,
    amount: str,
    as_of: Column,
    step: int = 30,
    count: int = 15,
    sum_name: str = "exp_arr_{}d",
    count_name: str = "exp_{}d",
) -> DataFrame:
    """Amount and number of events in each window ``(start + step*(n-1), start + step*n]``.

    The first window has no lower bound. Windows not reached by ``as_of`` and empty windows are
    NULL. Account rows that are equal in all columns count once per occurrence.

    Events are summed to (key, day) before they meet the accounts, so one account brings at most
    one row per calendar day through the join, however many events it has.
    """
    daily = (
        events.filter(F.col(key).isNotNull())
        .groupBy(key, F.to_date(event_date).alias("__day"))
        .agg(F.sum(amount).alias("__amount"), F.count(F.lit(1)).alias("__events"))
    )
    joined = lookup(accounts, daily, key)
    since = F.datediff("__day", start)
    window = strict_greatest(F.lit(1), F.ceil(since / F.lit(step)).cast("int"))
    open_window = F.when(as_of >= F.date_add(F.col(start), window * step), window)
    placed = joined.withColumn("__window", open_window)
    sums, counts = [], []
    for n in range(1, count + 1):
        here = F.col("__window") == n
        days = step * n
        sums.append(F.sum(F.when(here, F.col("__amount"))).alias(sum_name.format(days)))
        counts.append(F.sum(F.when(here, F.col("__events"))).alias(count_name.format(days)))
    return placed.groupBy(*accounts.columns).agg(*sums, *counts)


def cohort_rollup(df: DataFrame, dims: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum account measures per cohort; a measure without any value stays NULL."""
    return df.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in measures])


def month_offsets(
    df: DataFrame, start: str, count: int, as_of: Column, name: str = "post_{}mo"
) -> DataFrame:
    """``start + 1..count months`` for accounts whose last offset lies before ``as_of``."""
    months = {name.format(n): F.add_months(start, n) for n in range(1, count + 1)}
    return df.withColumns(months).filter(F.col(name.format(count)) <= F.date_sub(as_of, 1))


def funnel_durations(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Days between stages: name -> (later column, earlier column)."""
    return df.withColumns(
        {n: elapsed_days(F.to_date(late), F.to_date(early)) for n, (late, early) in pairs.items()}
    )


def funnel_rollup(
    leads: DataFrame,
    accounts: DataFrame,
    key: str,
    lead_dims: Sequence[str],
    account_dims: Sequence[str],
    lead_sums: Mapping[str, str],
    account_sums: Mapping[str, str],
    accounts_name: str = "accounts",
    account_identity: Sequence[str] = (),
) -> DataFrame:
    """Cohort counts over leads joined to their accounts.

    Output per (lead dims, account dims): distinct accounts, summed lead measures and account
    measures summed once per lead. ``lead_sums`` / ``account_sums`` map output name -> column.

    Leads are reduced to (account, lead dims) with a row count before the join, so an account that
    owns most leads arrives as a few rows; account measures are then weighted by that count. Equal
    account rows count once; ``account_identity`` adds columns that keep them apart.
    """
    reduced = leads.groupBy(key, *lead_dims).agg(
        F.count(F.lit(1)).alias("__leads"),
        *[F.sum(c).alias(f"__l_{n}") for n, c in lead_sums.items()],
    )
    measures = list(dict.fromkeys(account_sums.values()))
    wanted = accounts.select(key, *account_dims, *measures, *account_identity).distinct()
    joined = lookup(reduced, wanted, key, how="inner")
    return joined.groupBy(*lead_dims, *account_dims).agg(
        F.count_distinct(key).alias(accounts_name),
        *[F.sum(f"__l_{n}").alias(n) for n in lead_sums],
        *[F.sum(F.col(c) * F.col("__leads")).alias(n) for n, c in account_sums.items()],
    )
