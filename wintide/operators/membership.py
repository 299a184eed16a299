"""Set membership: semi filters and three-valued flags without nested-loop joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.operators._join import Keys, key_pairs, lookup


def semi_filter(df: DataFrame, keys_df: DataFrame, on: Keys) -> DataFrame:
    """Rows whose key occurs in ``keys_df``.

    The key set is made distinct first: that combines map-side, so a hot key on the right shrinks to
    one row, and the join reuses the same exchange.
    """
    right_keys = [r for _, r in key_pairs(on)]
    return lookup(df, keys_df.select(*right_keys).distinct(), on, how="left_semi")


def is_member(
    df: DataFrame,
    keys_df: DataFrame,
    on: str | tuple[str, str],
    name: str,
    null_aware: bool = True,
) -> DataFrame:
    """Add a BOOLEAN column with the SQL value of ``key IN (set)``.

    TRUE on a hit, FALSE on a miss, NULL when the probe is NULL or a miss meets a set that holds a
    NULL; an empty set gives FALSE. With ``null_aware=False`` every miss is FALSE, which is enough
    when only hits matter. One hash join on distinct keys plus, when NULL-aware, one scalar
    sub-query with a partial aggregate.
    """
    ((left, right),) = key_pairs([on])
    keys = keys_df.select(F.col(right).alias("__member"))
    hits = keys.filter(F.col("__member").isNotNull()).distinct()
    joined = lookup(df, hits, [(left, "__member")], [F.lit(True).alias("__hit")])
    if null_aware:
        facts = keys.agg(
            F.struct(
                F.count(F.lit(1)).alias("size"),
                F.count_if(F.col("__member").isNull()).alias("nulls"),
            )
        ).scalar()
        value = (
            F.when(F.col("__hit"), True)
            .when(facts.getField("size") == 0, False)
            .when(F.col(left).isNull() | (facts.getField("nulls") > 0), F.lit(None))
            .otherwise(False)
        )
    else:
        value = F.coalesce(F.col("__hit"), F.lit(False))
    return joined.withColumn(name, value).drop("__hit")


# 1 MB of bits whatever the tables' size; 5 % of the misses pass at a million keys, 1 % at 450,000.
FILTER_WORDS = 1 << 17

# For the one day of each account that a report looks up: 16 bits a pair let 1.4 % of the other lines pass
# however many accounts there are, up to 8 MB (four million pairs; 3.5 % pass at seven million).
ACCOUNT_FILTER_WORDS = 1 << 20
ACCOUNT_FILTER_BITS = 16


def may_hold(
    df: DataFrame, keys_df: DataFrame, on: Keys, words: int = FILTER_WORDS, key_bits: int | None = None
) -> DataFrame:
    """Rows whose key may occur in ``keys_df``: all that do, and few others while the filter has room.

    A Bloom filter of ``words`` x 64 bits with two bits a key. Its words are OR-ed together by an aggregation
    that combines before the shuffle; the filter itself is a scalar sub-query of fixed size, looked up in
    the scan's own stage. So a semi join that follows shuffles few of the rows it would drop. A set too
    large for the filter fills it, and then everything passes: the exact join must still follow. Keys are
    of the same types on both sides and not floating-point numbers.

    With ``key_bits`` the filter has that many bits for each row of ``keys_df``, and ``words`` is the most it may
    have: the share that passes then does not rise as both tables grow. ``keys_df`` is counted for it, so it should
    be cheap to read twice.
    """
    pairs = key_pairs(on)
    for left, right in pairs:
        kinds = {df.schema[left].dataType.simpleString(), keys_df.schema[right].dataType.simpleString()}
        if len(kinds) > 1 or kinds & {"float", "double"}:
            raise ValueError(f"keys need one type that is not floating-point, not {sorted(kinds)}")

    size = F.lit(words).cast("bigint")
    if key_bits is not None:
        wanted = F.ceil(F.count(F.lit(1)) * key_bits / 64)
        size = keys_df.agg(F.least(F.greatest(wanted, F.lit(1)), size).cast("bigint")).scalar()

    def places(columns: Sequence[str]) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(seed), *columns), size * 64) for seed in (1, 2)]

    spark = df.sparkSession
    bit = (F.col("place") % 64).cast("int")
    taken = keys_df.select(F.explode(F.array(*places([r for _, r in pairs]))).alias("place")).select(
        F.floor(F.col("place") / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits")
    )
    empty = spark.range(words).filter(F.col("id") < size).select(
        F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    filled = taken.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    held = filled.agg(F.transform(in_order, lambda w: w["bits"])).scalar()
    test = F.lit(True)
    for place in places([left for left, _ in pairs]):
        word = F.get(held, F.floor(place / 64).cast("int"))
        test = test & (F.getbit(word, (place % 64).cast("int")) == 1)
    return df.filter(test)


def on_days(
    lines: DataFrame,
    days: DataFrame,
    keys: Sequence[str] = ("crm_account_id", "mrr_date"),
    day: str = "mrr_date",
    filter_words: int | None = None,
    calendar_days: bool = False,
    filter_key_bits: int | None = None,
) -> DataFrame:
    """Lines of the (key, day) pairs in ``days``, cut before anything is aggregated.

    The distinct days alone come first: they are few whatever the tables' size, and prune partitions by
    day. The pairs then follow as a semi join, whose left side may be split where a key or a day is hot.
    With ``filter_words`` a filter of that size (``may_hold``) goes before the join, so that of a long
    history only the lines of the wanted pairs, and few others, are shuffled; ``days`` is read once more.

    ``calendar_days`` states that ``day`` holds dates, so that its distinct values are a calendar's worth at
    most and are broadcast. Spark estimates them by the size of ``days`` and would else deal the lines out by
    day, a few keys for the whole table, before it learns how few they are.
    """
    wanted = days.select(day).distinct()
    on_any = lookup(lines, F.broadcast(wanted) if calendar_days else wanted, [day], how="left_semi")
    if filter_words is not None:
        on_any = may_hold(on_any, days, list(keys), filter_words, filter_key_bits)
    return semi_filter(on_any, days, list(keys))


def membership_flag(
    df: DataFrame,
    keys_df: DataFrame,
    on: str | tuple[str, str],
    name: str,
    yes: Column | object,
    no: Column | object = None,
    negate: bool = False,
) -> DataFrame:
    """Add ``yes`` where the key is (``negate``: is not) in the set, ``no`` elsewhere.

    An undecided (NULL) membership takes ``no`` for both polarities.
    """
    return flags_of_set(df, keys_df, on, [Flag(name, yes, no, negate)])


@dataclass(frozen=True)
class Flag:
    """A column that is ``yes`` where the key is (``negate``: is provably not) in a set, else ``no``."""

    name: str
    yes: Column | object
    no: Column | object = None
    negate: bool = False


def flags_of_set(
    df: DataFrame, keys_df: DataFrame, on: str | tuple[str, str], flags: Sequence[Flag]
) -> DataFrame:
    """Several flags from one set, of both polarities, by one join."""
    out = is_member(df, keys_df, on, "__in", null_aware=any(f.negate for f in flags))
    for flag in flags:
        test = ~F.col("__in") if flag.negate else F.col("__in")
        yes, no = (v if isinstance(v, Column) else F.lit(v) for v in (flag.yes, flag.no))
        out = out.withColumn(flag.name, F.when(test, yes).otherwise(no))
    return out.drop("__in")


def exclude_members_unless(
    df: DataFrame, keys_df: DataFrame, on: str | tuple[str, str], keep: Column
) -> DataFrame:
    """Rows kept by ``keep``, plus rows whose key is provably not in the set."""
    out = is_member(df, keys_df, on, "__in")
    return out.filter(keep | ~F.col("__in")).drop("__in")


def flagged_accounts(
    accounts: DataFrame,
    customers: DataFrame,
    billing: DataFrame,
    batches: list[str],
    types: list[str],
) -> DataFrame:
    """Distinct accounts whose billing batch or billing type marks them.

    ``accounts``(account_id), ``customers``(account_id, crm_account_id, billing_batch) and
    ``billing``(account_id, account_type) share a comparable ``account_id``; each side is reduced to
    distinct rows before it is shuffled.
    """
    joined = lookup(accounts.select("account_id").distinct(), customers.distinct(), "account_id", how="inner")
    joined = lookup(joined, billing.distinct(), "account_id", how="inner")
    marked = F.col("billing_batch").isin(*batches) | F.col("account_type").isin(*types)
    return joined.filter(marked).distinct()
