from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from wintide.operators import (
    Flag,
    exclude_members_unless,
    flagged_accounts,
    flags_of_set,
    is_member,
    lookup,
    lookup_many,
    may_hold,
    membership_flag,
    on_days,
    semi_filter,
)

SETS = {"plain": [(1,), (1,), (3,)], "with_null": [(1,), (None,)], "only_null": [(None,)], "empty": []}


@pytest.fixture
def probe(frame):
    return frame("k int", [(1,), (2,), (3,), (None,)])


def by_sql(name: str, columns: str) -> list[tuple]:
    """Answer of an engine with three-valued IN (Spark's own projected IN gives FALSE for NULL)."""
    values = ", ".join(f"({'NULL' if v is None else v})" for (v,) in SETS[name]) or "(NULL)"
    keys = f"SELECT m::INT AS m FROM (VALUES {values}) t(m) {'' if SETS[name] else 'WHERE FALSE'}"
    sql = f"WITH s AS ({keys}), p AS (SELECT * FROM (VALUES (1), (2), (3), (NULL)) t(k)) SELECT {columns} FROM p"
    rows = duckdb.connect().execute(sql).fetchall()
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", SETS)
def test_is_member_is_three_valued(frame, probe, name):
    keys = frame("m int", SETS[name])
    expected = by_sql(name, "k, k IN (SELECT m FROM s)")
    assert rows_of(is_member(probe, keys, ("k", "m"), "hit")) == expected


@pytest.mark.parametrize("name", SETS)
def test_flags_in_both_polarities(frame, probe, name):
    keys = frame("m int", SETS[name])
    out = membership_flag(probe, keys, ("k", "m"), "a", "y", "n")
    out = membership_flag(out, keys, ("k", "m"), "b", "y", "n", negate=True)
    expected = by_sql(
        name,
        "k, CASE WHEN k IN (SELECT m FROM s) THEN 'y' ELSE 'n' END,"
        " CASE WHEN k NOT IN (SELECT m FROM s) THEN 'y' ELSE 'n' END",
    )
    assert rows_of(out) == expected


@pytest.mark.parametrize("name", SETS)
def test_both_polarities_by_one_join(frame, probe, name):
    keys = frame("m int", SETS[name])
    out = flags_of_set(probe, keys, ("k", "m"), [Flag("a", "y", "n"), Flag("b", "y", "n", negate=True)])
    apart = membership_flag(membership_flag(probe, keys, ("k", "m"), "a", "y", "n"), keys, ("k", "m"), "b", "y", "n", negate=True)
    assert rows_of(out) == rows_of(apart)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


@pytest.mark.parametrize("words", [1, 64, 1 << 12])
def test_may_hold_loses_no_member(spark, frame, words):
    """However small the filter; with room, few others pass."""
    df = spark.range(20_000).select("id", (F.col("id") % 7).cast("string").alias("day"))
    keys = df.filter("id % 100 = 0").select("id", "day")
    passed = may_hold(df, keys, ["id", "day"], words)
    assert passed.filter("id % 100 = 0").count() == 200
    others = passed.filter("id % 100 <> 0").count()
    assert others < 100 if words == 1 << 12 else others > 0
    assert may_hold(df, keys.filter("id < 0"), ["id", "day"], words).count() == 0
    nulls = frame("id bigint, day string", [(1, None), (None, None)])
    assert may_hold(nulls, nulls, ["id", "day"], 64).count() == 2
    for ddl in ("id int, day string", "id double, day string"):
        with pytest.raises(ValueError, match="one type"):
            may_hold(frame(ddl, []), keys, ["id", "day"], words)


def test_filter_grows_with_its_keys(spark):
    """The share of others that pass does not rise with the tables; the bound on the words still holds."""
    for rows in (2_000, 200_000):
        df = spark.range(rows).select("id", (F.col("id") % 7).cast("string").alias("day"))
        keys = df.filter("id % 10 = 0")
        passed = may_hold(df, keys, ["id", "day"], 1 << 14, key_bits=16)
        assert passed.filter("id % 10 = 0").count() == rows / 10
        assert passed.count() < rows / 10 + 0.03 * rows
        assert may_hold(df, keys, ["id", "day"], 4, key_bits=16).count() == rows or rows == 2_000
    for words in (1, 1 << 12):
        assert may_hold(df, keys.filter("id < 0"), ["id", "day"], words, key_bits=16).count() == 0


def test_days_are_cut_below_the_shuffle(spark):
    """With nothing to broadcast: the filter stands in the scan's stage, the exact join above the shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(30_000).select((F.col("id") % 500).alias("k"), (F.col("id") % 60).alias("day"), "id")
        wanted = lines.groupBy("k").agg(F.min("day").alias("day")).filter("k % 10 > 0")
        plain = on_days(lines, wanted, ["k", "day"], "day")
        filtered = on_days(lines, wanted, ["k", "day"], "day", filter_words=1 << 10)
        assert rows_of(filtered, "id") == rows_of(plain, "id") and plain.count() > 450
        text = filtered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        above = text[: text.index("getbit")]
        assert "Exchange" in above and above.count("SortMergeJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_not_dealt_out_by_day(spark):
    """With nothing to broadcast by size: a calendar's days are broadcast, the lines shuffled by pair only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("day")
        lines = spark.range(6_000).select((F.col("id") % 500).alias("k"), day, "id")
        wanted = lines.groupBy("k").agg(F.min("day").alias("day")).filter("k % 10 > 0")
        cut = on_days(lines, wanted, ["k", "day"], "day", filter_words=1 << 10, calendar_days=True)
        text = cut._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [day" in text and text.count("SortMergeJoin") == 1
        assert rows_of(cut, "id") == rows_of(on_days(lines, wanted, ["k", "day"], "day"), "id") != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_semi_filter_keeps_row_count(frame, probe):
    keys = frame("m int", [(1,), (1,), (3,), (None,)])
    assert rows_of(semi_filter(probe, keys, [("k", "m")])) == [(1,), (3,)]


def test_exclude_members_unless(frame):
    df = frame("k int, vip boolean", [(1, False), (1, True), (2, False), (None, False), (None, True)])
    keys = frame("k int", [(1,)])
    out = exclude_members_unless(df, keys, "k", F.col("vip"))
    assert rows_of(out, "k", "vip") == [(1, True), (2, False), (None, True)]


def test_flagged_accounts(frame):
    accounts = frame("account_id string", [("1",), ("2",), ("3",), ("4",)])
    customers = frame(
        "account_id string, crm_account_id string, billing_batch string",
        [("1", "c1", "Batch13"), ("2", "c2", "Batch1"), ("3", "c3", None), ("9", "c9", "Batch13")],
    )
    billing = frame(
        "account_id string, account_type string",
        [("1", "ok"), ("2", "Fraudulent"), ("3", "ok"), ("9", "ok"), (None, "Fraudulent")],
    )
    out = flagged_accounts(accounts, customers, billing, ["Batch13"], ["Fraudulent"])
    assert rows_of(out, "crm_account_id") == [("c1",), ("c2",)]


def test_lookup_many_equals_left_join(frame):
    df = frame("k int, v string", [(1, "a"), (1, "b"), (2, "c"), (None, "d")])
    many = frame("k int, w string", [(1, "x"), (1, "y"), (3, "z"), (None, "n")])
    plain, split = lookup(df, many, "k"), lookup_many(df, many, "k")
    assert split.columns == plain.columns
    assert rows_of(split) == rows_of(plain)
    assert split.count() == 6
