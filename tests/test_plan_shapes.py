"""Physical plans of the operators: what reaches the scan and what shrinks before a shuffle."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from wintide.operators import (
    edge_events,
    latest_per_key,
    latest_snapshot,
    lookup,
    product_rollup,
    semi_filter,
    tenure_windows,
    trailing_sum,
    typed_metrics,
)
from wintide.sources import write_table

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{DATA}/orders.parquet")


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshot_maximum_reaches_the_scan_as_a_filter(orders):
    text = plan(latest_snapshot(orders, "o_orderdate"))
    assert "EqualTo(o_orderdate,ScalarSubquery" in text
    assert "Join" not in text


def test_snapshot_maximum_prunes_partitions(spark, orders, tmp_path):
    path = f"{tmp_path}/by_day.parquet"
    daily = orders.filter("o_orderkey < 20").withColumn("day", F.to_date("o_orderdate"))
    write_table(daily, path, partition_by=["day"])
    stored = spark.read.parquet(path)
    newest = latest_snapshot(stored, "day")
    assert "PartitionFilters: [isnotnull(day" in plan(newest)
    assert newest.count() == daily.filter(F.col("day") == daily.agg(F.max("day")).first()[0]).count()
    scan = [line for line in plan(newest).splitlines() if "PartitionFilters" in line][0]
    assert "Subquery" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_rank_filter_is_applied_before_the_shuffle(orders):
    text = plan(latest_per_key(orders, ["o_custkey"], "o_orderdate", tie_breakers=["o_orderkey"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_ties_come_from_an_aggregate_not_a_window(orders, shuffled_joins):
    text = plan(latest_per_key(orders, ["o_custkey"], "o_orderdate", ties="all"))
    assert "Window" not in text
    assert "partial_max(o_orderdate" in text
    # the facts are spread by key and value, so a hot key does not meet in one partition
    assert "hashpartitioning(coalesce(o_custkey" in text and "coalesce(o_orderdate" in text


def test_trailing_filter_and_columns_reach_the_scan(orders):
    sums = {"spend": F.col("o_totalprice")}
    text = plan(trailing_sum(orders, "o_custkey", "o_orderdate", sums, F.lit(date(2001, 8, 1))))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate" in text


def test_typed_metrics_needs_no_row_expansion(orders):
    out = typed_metrics(orders, ["o_custkey"], "o_orderkey", "o_orderpriority", "o_totalprice", {"a": ["x"], "b": ["y"]})
    text = plan(out)
    assert "Expand" not in text and "SortAggregate" not in text
    assert text.count("Exchange") == 2


def test_edge_events_share_one_pass(orders):
    text = plan(edge_events(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], "o_totalprice"))
    assert text.count("FileScan") == 1 and "Window" not in text


def test_semi_filter_reduces_the_key_side_first(orders, shuffled_joins):
    text = plan(semi_filter(orders.select("o_custkey", "o_orderkey"), orders.filter("o_totalprice > 1"), "o_custkey"))
    assert "LeftSemi" in text
    assert "HashAggregate(keys=[__k0" in text or "HashAggregate(keys=[o_custkey" in text


def test_tenure_events_are_daily_before_the_join(orders, shuffled_joins):
    events = orders.withColumnRenamed("o_custkey", "id")
    wins = events.groupBy("id").agg(F.to_date(F.min("o_orderdate")).alias("win"))
    text = plan(tenure_windows(wins, events, "id", "win", "o_orderdate", "o_totalprice", F.lit(date(2001, 8, 1))))
    join = text.index("SortMergeJoin")
    assert "hashpartitioning(id" in text[join:]
    assert text.count("Exchange hashpartitioning") == 3  # wins, events by (key, day), events by key


def test_line_rollup_first_level_is_hash_based(frame):
    lines = frame(
        "mrr_date date, crm_account_id string, product_line string, product_offering string, product_plan string,"
        " base_product_plan string, productrateplancharge_id string, baseplan_quantity bigint, net_arr double",
        [],
    )
    products = frame("productrateplancharge_id string, product_type_derived string, enterpriselicense_ind string", [])
    levels = frame("product_plan string, plan_type int", [])
    text = plan(product_rollup(lines, products, levels))
    assert "SortAggregate" not in text
    assert "HashAggregate(keys=[mrr_date" in text


def test_lookup_sets_no_broadcast_hint(orders, shuffled_joins):
    joined = lookup(orders, orders.select("o_custkey", F.lit(1).alias("one")).distinct(), "o_custkey")
    assert "SortMergeJoin" in plan(joined)
