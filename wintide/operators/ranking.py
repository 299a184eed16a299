"""Newest/oldest row per key, edge events, dominant values and per-region cuts.

Everything here reduces before it shuffles by key: a key that holds a third of the table arrives as
at most one row (or one partial result) per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wintide.operators._join import lookup
from wintide.sources.tables import stage, staging_folder


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    ties: str = "one",
    tie_breakers: Sequence[str] = (),
    newest: bool = True,
) -> DataFrame:
    """Newest (or oldest) row per key by ``order``.

    ``ties="one"`` keeps exactly one row and needs ``tie_breakers`` that make it unique. The rank
    filter becomes a window group limit, applied on the map side before the shuffle.

    ``ties="all"`` keeps every row that shares the winning value. The winner per key is a partial
    aggregate over two columns; joining it back on (key, value) spreads a hot key's rows by value
    and lets AQE split a run of ties, so no task holds a whole group. NULLs sort last for newest
    and first for oldest.
    """
    if ties == "one":
        if not tie_breakers:
            raise ValueError("ties='one' needs tie_breakers for a repeatable result")
        cols = [order, *tie_breakers]
        spec = Window.partitionBy(*keys).orderBy(
            *[F.desc_nulls_last(c) if newest else F.asc_nulls_first(c) for c in cols]
        )
        return df.withColumn("__rn", F.row_number().over(spec)).filter("__rn = 1").drop("__rn")
    if ties != "all":
        raise ValueError(f"unknown ties {ties!r}")
    if newest:
        edge = F.max(order)
    else:
        edge = F.when(F.count(order) == F.count(F.lit(1)), F.min(order))
    best = df.groupBy(*keys).agg(edge.alias("__edge"))
    return lookup(df, best, [*keys, (order, "__edge")], columns=[], how="inner", null_safe=True)


def edge_events(
    events: DataFrame,
    keys: Sequence[str],
    date: str,
    details: Sequence[str],
    amount: str,
    total: str = "amount",
    which: Sequence[str] = ("first", "last"),
    value_sets: Mapping[str, str] | None = None,
) -> DataFrame:
    """First and/or last event per key, as struct columns ``first`` / ``last``.

    Lines are first summed per (key, date, details); the details also break ties (smallest for
    first, largest for last). Both edges come out of one aggregation. Keys with a NULL part are
    dropped: nothing can join to them. ``value_sets`` (name -> column) adds the sorted distinct
    values of a detail column, such as the event types.
    """
    valid = events.dropna(subset=list(keys))
    lines = valid.groupBy(*keys, date, *details).agg(F.sum(amount).alias(total))
    event = F.struct(date, *details, total)
    edges = {"first": F.min(event), "last": F.max(event)}
    sets = [F.array_sort(F.collect_set(c)).alias(n) for n, c in (value_sets or {}).items()]
    return lines.groupBy(*keys).agg(*[edges[w].alias(w) for w in which], *sets)


def dominant_value(
    df: DataFrame, keys: Sequence[str], value: str | Column, weight: str, name: str = "value"
) -> DataFrame:
    """Value with the largest summed weight per key; equal weights give the larger value."""
    v = F.col(value) if isinstance(value, str) else value
    per_value = df.groupBy(*keys, v.alias("__value")).agg(F.sum(weight).alias("__weight"))
    best = F.max(F.struct("__weight", "__value")).getField("__value")
    return per_value.groupBy(*keys).agg(best.alias(name))


FEW_RANKS = 4_096


def quota_cut(
    df: DataFrame,
    region: str,
    rank: str,
    quotas: Mapping[str, int],
    identity: Sequence[str],
    short: str = "none",
    splits: int = 256,
    few: int = FEW_RANKS,
) -> DataFrame:
    """Rows of each region whose rank value is at most the value at the region's quota position.

    Positions count distinct ``identity`` + region + rank rows. Ties at the cut all pass. A region
    with fewer rows than its quota gives nothing (``short="none"``) or all its rows ("all");
    regions without a quota give nothing.

    Nothing is ranked: equal ranks are counted once, and the interval that holds the position is
    narrowed by counting. Approximate percentiles split it into ``splits`` ranges, their exact counts
    tell which one holds the position, and so on until at most ``few`` different ranks are left; those
    are added up on the driver. How the ranges fall changes the work, never the cut, and the cost does
    not depend on the quota. The cuts are then literals in a filter over ``df``.

    The counts are found when this is called, by a few small jobs over a staged table of (region,
    rank, count); without a shared folder each job counts afresh. The driver sees at most ``splits``
    or ``few`` rows per quota. Ranks are numbers, dates or timestamps.
    """
    if short not in ("none", "all"):
        raise ValueError(f"unknown short {short!r}")
    if not quotas:
        raise ValueError("at least one quota is needed")
    if splits < 2 or few < 1:
        raise ValueError("narrowing needs two splits and one rank")
    in_scope = df.filter(F.col(region).isin(*quotas))
    counted = (
        in_scope.select(*identity, F.col(region).alias("__region"), F.col(rank).alias("__rank"))
        .distinct()
        .groupBy("__region", "__rank")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(F.col("__region").alias("region"), F.col("__rank").alias("rank"), F.col("__n").alias("n"))
    )
    if staging_folder(df.sparkSession):
        counted = stage(counted, "quota_cut")
    cuts = _cuts(counted, quotas, splits, few)
    keep = F.lit(False)
    for name, (reached, cut) in cuts.items():
        mine = F.col(region) == name
        if not reached:
            keep = keep | (mine if short == "all" else F.lit(False))
        elif cut is not None:
            keep = keep | (mine & (F.col(rank) <= F.lit(cut)))
    if short == "all":
        for name in quotas.keys() - cuts.keys():
            keep = keep | (F.col(region) == name)
    return in_scope.filter(keep)


def _cuts(counted: DataFrame, quotas: Mapping[str, int], splits: int, few: int) -> dict[str, tuple[bool, object]]:
    """Whether each region reaches its quota, and the rank there; NULL ranks come first."""
    sizes = counted.groupBy("region").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("rank").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("rank").alias("ranks"),
        F.max("rank").alias("top"),
    )
    cuts: dict[str, tuple[bool, object]] = {}
    # per region: position within the interval, its ends (the lower one left out) and its different ranks
    open_: dict[str, tuple[int, object, object, int]] = {}
    for row in sizes.collect():
        quota = quotas[row["region"]]
        cuts[row["region"]] = (row["n"] >= quota, None)
        if row["n"] >= quota > row["nulls"]:
            open_[row["region"]] = (quota - row["nulls"], None, row["top"], row["ranks"])
    while open_:
        small = {name: state for name, state in open_.items() if state[3] <= few}
        for name, cut in _exact(counted, small).items():
            cuts[name] = (True, cut)
        open_ = _narrowed(counted, {n: s for n, s in open_.items() if n not in small}, splits)
    return cuts


def _held(counted: DataFrame, states: Mapping[str, tuple]) -> DataFrame:
    """Counts within the open interval of each region."""
    within = F.lit(False)
    for name, (_, low, top, _) in states.items():
        mine = (F.col("region") == name) & (F.col("rank") <= F.lit(top))
        within = within | (mine if low is None else mine & (F.col("rank") > F.lit(low)))
    return counted.filter(within)


def _exact(counted: DataFrame, states: Mapping[str, tuple]) -> dict[str, object]:
    """The rank at the position, of few enough ranks to add up here."""
    if not states:
        return {}
    found: dict[str, object] = {}
    seen = dict.fromkeys(states, 0)
    for row in sorted(_held(counted, states).collect(), key=lambda r: (r["region"], r["rank"])):
        name = row["region"]
        seen[name] += row["n"]
        if name not in found and seen[name] >= states[name][0]:
            found[name] = row["rank"]
    return found


def _narrowed(counted: DataFrame, states: Mapping[str, tuple], splits: int) -> dict[str, tuple[int, object, object, int]]:
    """The one range of each open interval that holds the position."""
    if not states:
        return {}
    rows = _held(counted, states)
    shares = F.array(*[F.lit(k / splits) for k in range(1, splits)])
    ranges = rows.groupBy("region").agg(F.percentile_approx("rank", shares).alias("edges"))
    # one row for each quota in the call
    placed = rows.join(F.broadcast(ranges), "region").withColumn(
        "range", F.size(F.filter("edges", lambda e: e < F.col("rank")))
    )
    counts = placed.groupBy("region", "range").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("ranks"), F.max("rank").alias("top")
    )
    out: dict[str, tuple[int, object, object, int]] = {}
    left = {name: state[0] for name, state in states.items()}
    low = {name: state[1] for name, state in states.items()}
    for row in sorted(counts.collect(), key=lambda r: (r["region"], r["range"])):
        name = row["region"]
        if name in out:
            continue
        if row["n"] >= left[name]:
            out[name] = (left[name], low[name], row["top"], row["ranks"])
        else:
            left[name] -= row["n"]
            low[name] = row["top"]
    return out
