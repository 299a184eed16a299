"""One key holds a third of all rows: results stay whole and equal to plain SQL."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from wintide.operators import (
    dominant_value,
    edge_events,
    latest_per_key,
    lookup,
    lookup_many,
    quota_cut,
    scd2_as_of,
    typed_metrics,
)

ROWS = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    i = F.col("id")
    return spark.range(ROWS, numPartitions=8).select(
        i,
        F.when(i % 3 == 0, F.lit(0)).otherwise(i % 997).alias("k"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.pmod(F.xxhash64("id"), F.lit(300))).cast("int")).alias("d"),
        F.concat(F.lit("t"), (i % 5).cast("string")).alias("type"),
        (i % 101).cast("double").alias("amt"),
    )


@pytest.fixture(scope="module")
def plain(skewed):
    con = duckdb.connect()
    con.register("s", skewed.toPandas())
    con.execute("CREATE TABLE skewed AS SELECT id, k, CAST(d AS DATE) AS d, type, amt FROM s")
    return con


def expected(con, sql):
    return sorted(con.execute(sql).fetchall(), key=lambda r: [(v is None, str(v)) for v in r])


def test_latest_with_ties(skewed, plain):
    out = latest_per_key(skewed, ["k"], "d", ties="all")
    sql = "SELECT k, id FROM skewed QUALIFY rank() OVER (PARTITION BY k ORDER BY d DESC) = 1"
    assert rows_of(out, "k", "id") == expected(plain, sql)


def test_edges(skewed, plain):
    out = edge_events(skewed, ["k"], "d", ["id"], "amt")
    sql = "SELECT k, arg_min(id, (d, id)), arg_max(id, (d, id)) FROM skewed GROUP BY 1"
    assert rows_of(out, "k", "first.id", "last.id") == expected(plain, sql)


def test_typed_metrics(skewed, plain):
    out = typed_metrics(skewed, ["k"], "id", "type", "amt", {"a": ["t1", "t2"]}, "n_{}")
    sql = """SELECT k, count(DISTINCT id), count(DISTINCT id) FILTER (WHERE type IN ('t1', 't2')),
      coalesce(sum(amt) FILTER (WHERE type IN ('t1', 't2')), 0) FROM skewed GROUP BY 1"""
    assert rows_of(out, "k", "num_events", "n_a", "a_amount") == expected(plain, sql)


def test_dominant_value(skewed, plain):
    sql = """SELECT k, max(type) FROM (SELECT k, type, sum(amt) AS w FROM skewed GROUP BY ALL) t
      JOIN (SELECT k, max(w) AS w FROM (SELECT k, type, sum(amt) AS w FROM skewed GROUP BY ALL) GROUP BY 1) USING (k, w) GROUP BY 1"""
    assert rows_of(dominant_value(skewed, ["k"], "type", "amt")) == expected(plain, sql)


def test_quota_cut_over_two_regions(skewed, plain):
    ranked = skewed.select("id", F.when(F.col("k") == 0, "hot").otherwise("cold").alias("region"), F.col("amt").cast("int").alias("r"))
    out = quota_cut(ranked, "region", "r", {"hot": 4500, "cold": 3500}, ["id"])
    sql = """WITH r AS (SELECT id, CASE WHEN k = 0 THEN 'hot' ELSE 'cold' END AS region, CAST(amt AS INT) AS r FROM skewed),
      p AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY r) AS pos FROM r),
      c AS (SELECT region, r AS cut FROM p WHERE pos = CASE region WHEN 'hot' THEN 4500 ELSE 3500 END)
      SELECT id FROM r JOIN c USING (region) WHERE r <= cut"""
    assert rows_of(out, "id") == expected(plain, sql)


@pytest.mark.parametrize("split", [{}, {"slice_months": 1}, {"per_range": 8}])
def test_as_of_with_a_long_history_on_the_hot_key(spark, skewed, plain, split):
    n = F.col("id").cast("int")
    start = F.date_add(F.lit("2019-12-01").cast("date"), n)
    history = spark.range(360).select(
        F.lit(0).cast("bigint").alias("key"),
        n.alias("version"),
        start.cast("timestamp").alias("dw_eff_start"),
        F.date_add(start, 1).cast("timestamp").alias("dw_eff_end"),
    )
    out = scd2_as_of(
        skewed.select("id", "k", "d"), history, [("k", "key")], F.col("d").cast("timestamp"), **split
    )
    got = out.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("version").alias("v")).filter("k = 0")
    sql = """SELECT count(*), CAST(sum(version) AS BIGINT) FROM skewed JOIN range(360) v(version)
      ON d BETWEEN DATE '2019-12-01' + CAST(version AS INT) AND DATE '2019-12-02' + CAST(version AS INT) WHERE k = 0"""
    assert rows_of(got, "n", "v") == expected(plain, sql)


def test_ranges_spread_the_hot_key(spark, skewed, eager_skew_split):
    """No task joins a large part of the hot key's pairs: the range is part of the shuffle's key."""
    n = F.col("id").cast("int")
    day = F.date_add(F.lit("2019-12-01").cast("date"), n).cast("timestamp")
    history = spark.range(360).select((F.col("id") % 2).alias("key"), day.alias("dw_eff_start"), day.alias("dw_eff_end"), n.alias("v"))
    at = F.col("d").cast("timestamp")
    out = scd2_as_of(skewed.select("id", "k", "d"), history, [("k", "key")], at, per_range=8)
    text = final_plan(out)
    assert re.search(r"hashpartitioning\([^)]*__range#\d+", text) and re.search(r"hashpartitioning\([^)]*__s#\d+", text)


def test_hot_right_side(spark, skewed, plain):
    keys = spark.range(1000).select(F.col("id").alias("key"))
    out = lookup_many(keys, skewed.select("k", "id"), [("key", "k")])
    sql = "SELECT key, id FROM range(1000) r(key) LEFT JOIN skewed ON k = key"
    assert rows_of(out, "key", "id") == expected(plain, sql)


@pytest.fixture
def eager_skew_split(spark):
    """Sort-merge joins only, and AQE thresholds small enough for the test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_left_key_is_split(spark, skewed, eager_skew_split):
    dim = spark.range(1000).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    joined = lookup(skewed.select("k", "id", "type"), dim, [("k", "key")])
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    # also below an aggregation on the join key, at the price of one more shuffle
    assert "SortMergeJoin(skew=true)" in final_plan(joined.groupBy("k").agg(F.max("id"), F.max("name")))


def test_hot_right_key_is_split_only_by_lookup_many(spark, skewed, eager_skew_split):
    keys = spark.range(1000).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    events = skewed.select("k", "id", "type")
    assert "skew=true" not in final_plan(lookup(keys, events, [("key", "k")]))
    assert "SortMergeJoin(skew=true)" in final_plan(lookup_many(keys, events, [("key", "k")]))
