"""Point-in-time operators: current rows, as-of versions, snapshots, calendars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.functions import strict_greatest
from wintide.functions._cols import ColumnLike, as_col
from wintide.operators._join import Keys, key_pairs, lookup


def current_rows(
    dim: DataFrame, flag: str = "dw_curr_ind", not_deleted: str | None = None
) -> DataFrame:
    """Live version of a slowly changing dimension, optionally without deleted rows."""
    live = dim.filter(F.col(flag) == "Y")
    return live if not_deleted is None else live.filter(F.col(not_deleted) == "False")


def as_of_instant(date: ColumnLike, floor: Date | None, shift_days: int = 1) -> Column:
    """``max(date, floor) + shift`` as a timestamp; the floor covers facts older than history."""
    day = as_col(date)
    if floor is not None:
        day = strict_greatest(day, F.lit(floor))
    return F.date_add(day, shift_days).cast("timestamp")


def _slice_of(instant: Column, months: int) -> Column:
    return F.floor((F.year(instant) * 12 + F.month(instant)) / F.lit(months))


EDGES, COARSE = 1_024, 32


def _version_ranges(dim: DataFrame, keys: Sequence[str], per_range: int) -> DataFrame:
    """Ranges of the keys with more than ``per_range`` versions: where each begins, and every 32nd of those.

    Counted first, so that percentiles are kept for long histories only; there are few of them, often none.
    """
    counted = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > per_range)
    long = dim.select(*keys, "__from").join(counted, list(keys))
    shares = F.array(*[F.lit(n / EDGES) for n in range(1, EDGES)])
    edges = long.groupBy(*keys).agg(
        F.percentile_approx("__from", shares).alias("__starts"), F.max("__n").alias("__n")
    )
    step = F.greatest(F.lit(1), F.floor(F.lit(EDGES * per_range) / F.col("__n")))
    wanted = F.array_distinct(F.filter("__starts", lambda _, at: (at + 1) % step == 0))
    each = F.filter("__edges", lambda _, at: (at + 1) % COARSE == 0).alias("__coarse")
    return edges.select(*keys, wanted.alias("__edges")).select(*keys, "__edges", each)


def _with_ranges(df: DataFrame, keys: Sequence[str], ranges: DataFrame, names: Sequence[str]) -> DataFrame:
    held = ranges.select(*[F.col(n).alias(f"__r{i}") for i, n in enumerate(names)], "__edges", "__coarse")
    same = [F.col(k) == F.col(f"__r{i}") for i, k in enumerate(keys)]
    return df.join(held, same, "left").drop(*[f"__r{i}" for i in range(len(names))])


def _range_at(instant: Column) -> Column:
    """How many ranges of its key begin up to an instant; 0 for a key without ranges."""

    def upto(begins: Column) -> Column:
        return F.size(F.filter(begins, lambda e: e <= instant))

    whole = upto(F.col("__coarse")) * COARSE
    inside = upto(F.slice("__edges", whole + 1, F.lit(COARSE)))
    return F.when(F.col("__edges").isNull(), 0).otherwise(whole + inside)


def scd2_as_of(
    facts: DataFrame,
    dim: DataFrame,
    on: Keys,
    at: Column,
    start: str = "dw_eff_start",
    end: str = "dw_eff_end",
    columns: Sequence[str] | None = None,
    how: str = "left",
    slice_months: int | None = None,
    reach_of: DataFrame | None = None,
    per_range: int | None = None,
) -> DataFrame:
    """Dimension version valid at ``at``; both interval ends count, so touching versions both match.

    The key is the hash part of the join and the interval its residual. That is right while one key
    has few versions. For keys with very long histories set ``slice_months``: versions are unrolled
    over calendar slices clipped to the facts' own time range and the slice joins the hash key, so
    a hot key spreads over tasks and a fact meets only the versions of its slice. A version meets
    an instant in exactly one slice, so both forms give the same rows. The time range is a scalar
    sub-query over ``reach_of``, a frame that covers all instants (default: the facts; pass the
    narrow base table when the facts are already a long plan).

    ``per_range`` needs no width: a key with more versions than that is dealt over ranges of time that
    begin at percentiles of its own versions' starts (up to 1,024 ranges a key). A version that is open
    when a range begins is carried into it, and the range joins the hash key. So no fact meets all
    versions of a long history, whether they are spread evenly or crowd in one month; keys with few
    versions are joined as in the plain form. The dimension is read once more, to count.
    """
    if slice_months is not None and per_range is not None:
        raise ValueError("either slices or ranges")
    pairs = key_pairs(on)
    right_keys = [r for _, r in pairs]
    if columns is None:
        columns = [c for c in dim.columns if c not in (*right_keys, start, end)]
    probe = facts.withColumn("__at", at)
    right = dim.select(
        *[F.col(r).alias(f"__k{i}") for i, r in enumerate(right_keys)],
        F.col(start).cast("timestamp").alias("__from"),
        F.col(end).cast("timestamp").alias("__to"),
        *columns,
    )
    condition = F.col("__at").between(F.col("__from"), F.col("__to"))
    for i, (left, _) in enumerate(pairs):
        condition = (F.col(left) == F.col(f"__k{i}")) & condition
    if slice_months is not None:
        probe = probe.withColumn("__slice", _slice_of(F.col("__at"), slice_months))
        slices = _slice_of(at, slice_months)
        reach = (facts if reach_of is None else reach_of).agg(
            F.struct(F.min(slices).alias("lo"), F.max(slices).alias("hi"))
        )
        right = (
            right.withColumn("__reach", reach.scalar())
            .withColumn(
                "__lo",
                F.greatest(_slice_of(F.col("__from"), slice_months), F.col("__reach.lo")),
            )
            .withColumn(
                "__hi", F.least(_slice_of(F.col("__to"), slice_months), F.col("__reach.hi"))
            )
            .filter(F.col("__lo") <= F.col("__hi"))
            .withColumn("__s", F.explode(F.sequence("__lo", "__hi")))
            .drop("__reach", "__lo", "__hi")
        )
        condition = (F.col("__slice") == F.col("__s")) & condition
    if per_range is not None:
        names = [f"__k{i}" for i in range(len(pairs))]
        ranges = _version_ranges(right, names, per_range)
        probe = _with_ranges(probe, [left for left, _ in pairs], ranges, names)
        probe = probe.withColumn("__range", _range_at(F.col("__at"))).drop("__edges", "__coarse")
        right = _with_ranges(right.filter(F.col("__from") <= F.col("__to")), names, ranges, names)
        spanned = F.sequence(_range_at(F.col("__from")), _range_at(F.col("__to")))
        right = right.withColumn("__s", F.explode(spanned)).drop("__edges", "__coarse")
        condition = (F.col("__range") == F.col("__s")) & condition
    helper = [f"__k{i}" for i in range(len(pairs))]
    helper += ["__from", "__to", "__at", "__slice", "__range", "__s"]
    return probe.join(right, condition, how).drop(*helper)


def latest_snapshot(df: DataFrame, col: str, of: DataFrame | None = None) -> DataFrame:
    """Rows at the table-wide newest snapshot.

    The maximum is a scalar sub-query: one narrow pre-scan, then a literal that reaches the Parquet
    filters (and prunes partitions where the table is laid out by ``col``).
    """
    newest = (df if of is None else of).agg(F.max(col)).scalar()
    return df.filter(F.col(col) == newest)


def snapshot_join(
    df: DataFrame,
    snap: DataFrame,
    key: str | tuple[str, str],
    df_run: str,
    snap_run: str,
    columns: Sequence[str] | None = None,
    how: str = "left",
) -> DataFrame:
    """Attach a snapshot table at each row's own run date."""
    if columns is None:
        right = key if isinstance(key, str) else key[1]
        columns = [c for c in snap.columns if c not in (right, snap_run)]
    return lookup(df, snap, [key, (df_run, snap_run)], columns, how)


def state_at(
    df: DataFrame,
    facts: DataFrame,
    key: str | tuple[str, str],
    at: Column,
    fact_date: str,
    columns: Sequence[str | Column] | None = None,
    how: str = "left",
) -> DataFrame:
    """Fact row of the key at a computed date, as a plain two-key equi join."""
    right = key if isinstance(key, str) else key[1]
    if columns is None:
        columns = [c for c in facts.columns if c not in (right, fact_date)]
    probe = df.withColumn("__on_date", at)
    joined = lookup(probe, facts, [key, ("__on_date", fact_date)], columns, how)
    return joined.drop("__on_date")


def with_calendar(
    df: DataFrame,
    calendar: DataFrame,
    date: str,
    columns: Sequence[str | Column],
    calendar_date: str = "the_date",
    how: str = "inner",
) -> DataFrame:
    """Calendar attributes of a date; the inner form drops dates outside the calendar."""
    return lookup(df, calendar, [(date, calendar_date)], columns, how)


def reporting_dates(
    df: DataFrame,
    calendar: DataFrame,
    date: str,
    yesterday: ColumnLike,
    min_fiscal_year: int,
) -> DataFrame:
    """Rows on a quarter end or on ``yesterday``, from ``min_fiscal_year`` on.

    The calendar is cut down before the join, so only reporting days remain on its side.
    """
    wanted = (F.col("last_day_of_qtr_ind") == "Y") | (F.col("the_date") == as_col(yesterday))
    days = calendar.filter(wanted & (F.col("fiscal_year") >= min_fiscal_year))
    return lookup(df, days.select("the_date").distinct(), [(date, "the_date")], how="left_semi")
