"""Relational building blocks: projections, filters, joins, aggregates, windows, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.registry import AS_OF, Tables, as_of_date, query
from wintide.functions import (
    complement,
    distinct_list,
    quarter_end,
    ratio,
    strict_greatest,
    strict_least,
    year_quarter,
    yesterday_in,
)
from wintide.operators import latest_per_key, lookup


@query("""
SELECT c_custkey AS account_id, c_name AS account_name, c_mktsegment AS segment, c_acctbal AS balance
FROM customer
""")
def customer_projection(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


@query("""
SELECT * EXCLUDE (l_tax, l_discount, l_shipdate), l_extendedprice / l_quantity AS unit_price
FROM lineitem
""")
def star_except(t: Tables) -> DataFrame:
    df = t.lineitem.drop("l_tax", "l_discount", "l_shipdate")
    return df.select("*", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))


@query("SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders")
def distinct_rows(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderpriority", "o_orderstatus").distinct()


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus NOT IN ('P')
  AND (o_orderpriority IN ('1-URGENT', '2-HIGH')
       OR (o_orderpriority LIKE '%NOT%' AND o_orderdate >= DATE '1999-01-01'))
  AND o_orderdate BETWEEN TIMESTAMP '1996-02-01' AND TIMESTAMP '2000-12-31'
  AND o_totalprice IS NOT NULL AND o_totalprice <> 0
""")
def literal_filters(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    late_unset = F.col("o_orderpriority").like("%NOT%") & (day >= F.lit("1999-01-01").cast("timestamp_ntz"))
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("1996-02-01", "2000-12-31"))
    return t.orders.filter(
        ~F.col("o_orderstatus").isin("P")
        & (high | late_unset)
        & day.between(lo, hi)
        & F.col("o_totalprice").isNotNull()
        & (F.col("o_totalprice") != 0)
    ).select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
SELECT o_orderkey, c_name, c_mktsegment, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def inner_join(t: Tables) -> DataFrame:
    joined = lookup(t.orders, t.customer, [("o_custkey", "c_custkey")], how="inner")
    return joined.select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice")


@query("""
WITH peak AS (
  SELECT o_custkey, o_orderpriority, max(o_totalprice) AS top_price FROM orders GROUP BY ALL)
SELECT o_orderkey, top_price
FROM orders JOIN peak USING (o_custkey, o_orderpriority)
""")
def two_key_join(t: Tables) -> DataFrame:
    keys = ["o_custkey", "o_orderpriority"]
    peak = t.orders.groupBy(*keys).agg(F.max("o_totalprice").alias("top_price"))
    return lookup(t.orders, peak, keys, how="inner").select("o_orderkey", "top_price")


@query("""
SELECT c_custkey, c_name, n_name AS big_nation
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey IN (1, 3)
""")
def left_join_filtered_right(t: Tables) -> DataFrame:
    nations = t.nation.filter(F.col("n_regionkey").isin(1, 3)).select(
        "n_nationkey", F.col("n_name").alias("big_nation")
    )
    out = lookup(t.customer, nations, [("c_nationkey", "n_nationkey")])
    return out.select("c_custkey", "c_name", "big_nation")


@query("""
SELECT l_orderkey, l_linenumber, p_brand, p_size, l_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey AND p_size >= 40
""")
def inner_join_filtered_right(t: Tables) -> DataFrame:
    parts = t.part.filter("p_size >= 40")
    out = lookup(t.lineitem, parts, [("l_partkey", "p_partkey")], ["p_brand", "p_size"], "inner")
    return out.select("l_orderkey", "l_linenumber", "p_brand", "p_size", "l_quantity")


@query("""
SELECT event_id, c_name FROM events
JOIN customer ON 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') = c_name
""")
def key_expression_join(t: Tables) -> DataFrame:
    digits = F.lpad(F.col("user_id").cast("string"), 9, "0")
    named = t.events.withColumn("customer_name", F.concat(F.lit("Customer#"), digits))
    joined = lookup(named, t.customer, [("customer_name", "c_name")], ["c_custkey"], "inner")
    return joined.select("event_id", F.col("customer_name").alias("c_name"))


@query("""
SELECT o_orderkey, c_name FROM orders JOIN customer
  ON o_custkey = c_custkey AND (o_totalprice > 400000 OR c_mktsegment = 'MACHINERY')
""")
def or_residual_join(t: Tables) -> DataFrame:
    joined = lookup(t.orders, t.customer, [("o_custkey", "c_custkey")], how="inner")
    keep = (F.col("o_totalprice") > 400000) | (F.col("c_mktsegment") == "MACHINERY")
    return joined.filter(keep).select("o_orderkey", "c_name")


@query("""
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
""")
def left_join_made_inner(t: Tables) -> DataFrame:
    """A filter on the right side drops unmatched rows, so it is written as an inner join."""
    urgent = t.orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    joined = lookup(t.customer, urgent, [("c_custkey", "o_custkey")], ["o_orderkey"], "inner")
    return joined.select("c_custkey", "o_orderkey")


@query("""
WITH newest AS (
  SELECT o_custkey, o_orderkey, o_totalprice FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT c_custkey, o_orderkey AS newest_order, o_totalprice AS newest_price
FROM customer LEFT JOIN newest ON c_custkey = o_custkey
""", maybe_null=["newest_order"])
def left_join_on_latest(t: Tables) -> DataFrame:
    newest = latest_per_key(t.orders, ["o_custkey"], "o_orderdate", tie_breakers=["o_orderkey"]).select(
        "o_custkey",
        F.col("o_orderkey").alias("newest_order"),
        F.col("o_totalprice").alias("newest_price"),
    )
    out = lookup(t.customer, newest, [("c_custkey", "o_custkey")])
    return out.select("c_custkey", "newest_order", "newest_price")


@query("""
SELECT s_suppkey, n_name, r_name FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
""")
def dimension_chain(t: Tables) -> DataFrame:
    out = lookup(t.supplier, t.nation, [("s_nationkey", "n_nationkey")])
    out = lookup(out, t.region, [("n_regionkey", "r_regionkey")])
    return out.select("s_suppkey", "n_name", "r_name")


@query("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
  round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
  min(l_discount) AS min_discount, max(l_discount) AS max_discount, count(*) AS lines
FROM lineitem GROUP BY ALL
""")
def group_totals(t: Tables) -> DataFrame:
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum(revenue), 4).alias("revenue"),
        F.min("l_discount").alias("min_discount"),
        F.max("l_discount").alias("max_discount"),
        F.count(F.lit(1)).alias("lines"),
    )


@query("""
SELECT o_custkey, count(DISTINCT o_orderpriority) AS priorities,
  max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS top_closed
FROM orders GROUP BY ALL
""")
def distinct_count_and_conditional_max(t: Tables) -> DataFrame:
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0)
    return t.orders.groupBy("o_custkey").agg(
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.max(closed).alias("top_closed"),
    )


@query("""
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities,
  string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority)
    FILTER (WHERE o_orderstatus = 'F' AND o_totalprice > 300000) AS large_closed
FROM orders GROUP BY ALL
""")
def distinct_lists(t: Tables) -> DataFrame:
    large = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)
    return t.orders.groupBy("o_custkey").agg(
        distinct_list("o_orderpriority").alias("priorities"),
        distinct_list("o_orderpriority", large).alias("large_closed"),
    )


@query("""
SELECT o_custkey,
  CASE WHEN sum(o_totalprice) < 1000000 THEN 'small' WHEN sum(o_totalprice) < 3000000 THEN 'medium'
       ELSE 'large' END AS spend_band,
  CASE WHEN max(o_orderpriority) = '5-LOW' THEN 'has low' ELSE 'no low' END AS low_flag,
  round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) / sum(o_totalprice), 6) AS closed_share
FROM orders GROUP BY ALL
""")
def expressions_over_aggregates(t: Tables) -> DataFrame:
    total = F.sum("o_totalprice")
    closed = F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0))
    return t.orders.groupBy("o_custkey").agg(
        F.when(total < 1000000, "small").when(total < 3000000, "medium").otherwise("large").alias("spend_band"),
        F.when(F.max("o_orderpriority") == "5-LOW", "has low").otherwise("no low").alias("low_flag"),
        F.round(ratio(closed, total), 6).alias("closed_share"),
    )


@query("""
WITH per_order AS (
  SELECT l_orderkey, round(sum(l_extendedprice), 2) AS order_value, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT o_custkey, max(order_value) AS top_order, CAST(sum(n) AS BIGINT) AS lines, count(*) AS orders
FROM per_order JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
""")
def two_level_aggregation(t: Tables) -> DataFrame:
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("order_value"), F.count(F.lit(1)).alias("n")
    )
    joined = lookup(per_order, t.orders, [("l_orderkey", "o_orderkey")], ["o_custkey"], "inner")
    return joined.groupBy("o_custkey").agg(
        F.max("order_value").alias("top_order"),
        F.sum("n").alias("lines"),
        F.count(F.lit(1)).alias("orders"),
    )


@query("SELECT max(o_totalprice) AS top_price, count(*) AS orders, CAST(max(o_orderdate) AS DATE)::VARCHAR AS newest FROM orders")
def global_aggregate(t: Tables) -> DataFrame:
    return t.orders.agg(
        F.max("o_totalprice").alias("top_price"),
        F.count(F.lit(1)).alias("orders"),
        F.to_date(F.max("o_orderdate")).alias("newest"),
    )


@query("""
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, event_type, n FROM daily
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, day, event_type) = 1
""")
def window_over_grouped_rows(t: Tables) -> DataFrame:
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    spec = Window.partitionBy("user_id").orderBy(F.desc("n"), "day", "event_type")
    top = daily.withColumn("rn", F.row_number().over(spec)).filter("rn = 1")
    return top.select("user_id", "event_type", "n")


@query("""
WITH spend AS (
  SELECT o_custkey, o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL)
SELECT o_custkey, o_orderstatus, orders FROM spend
QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY orders DESC) = 1
""")
def rank_by_aggregate(t: Tables) -> DataFrame:
    """Ties on the aggregate all stay. A customer has one row per status here, so a window is safe."""
    spend = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    spec = Window.partitionBy("o_custkey").orderBy(F.desc("orders"))
    return spend.withColumn("rank", F.rank().over(spec)).filter("rank = 1").drop("rank")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_custkey")
def sort_rows(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_acctbal").orderBy("c_custkey")


@query("""
SELECT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'
UNION SELECT o_custkey FROM orders WHERE o_totalprice > 300000
UNION SELECT user_id FROM events WHERE event_type = 'purchase'
""")
def union_distinct(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    large = t.orders.filter("o_totalprice > 300000").select("o_custkey")
    buyers = t.events.filter("event_type = 'purchase'").select("user_id")
    return urgent.union(large).union(buyers).distinct()


@query("""
SELECT p_partkey, p_brand || '/' || p_type AS label, split_part(p_name, ' ', 1) AS first_word,
  regexp_extract(p_name, '\\s(.*)', 1) AS rest, substr(p_type, 1, 3) AS short_type,
  lower(p_type) AS lower_type
FROM part
""")
def text_functions(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.concat("p_brand", F.lit("/"), "p_type").alias("label"),
        F.substring_index("p_name", " ", 1).alias("first_word"),
        F.regexp_extract("p_name", r"\s(.*)", 1).alias("rest"),
        F.substring("p_type", 1, 3).alias("short_type"),
        F.lower("p_type").alias("lower_type"),
    )


@query(f"""
SELECT o_orderkey, (o_orderdate::DATE + 45)::VARCHAR AS plus_days,
  (o_orderdate::DATE + INTERVAL 3 MONTH)::DATE::VARCHAR AS plus_months,
  (o_orderdate::DATE - INTERVAL 1 YEAR)::DATE::VARCHAR AS minus_year,
  CAST(date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') AS INTEGER) AS age_days,
  last_day(date_trunc('quarter', o_orderdate)::DATE + INTERVAL 2 MONTH)::VARCHAR AS quarter_end,
  year(o_orderdate) || 'Q' || quarter(o_orderdate) AS year_quarter
FROM orders
""")
def date_functions(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_add(day, 45).alias("plus_days"),
        F.add_months(day, 3).alias("plus_months"),
        F.add_months(day, -12).alias("minus_year"),
        F.datediff(as_of_date(), day).alias("age_days"),
        quarter_end(day).alias("quarter_end"),
        year_quarter(day).alias("year_quarter"),
    )


@query("""
SELECT event_id, ((ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')::DATE - 1)::VARCHAR AS local_yesterday
FROM events
""")
def day_before_in_zone(t: Tables) -> DataFrame:
    return t.events.select("event_id", yesterday_in("America/Los_Angeles", "ts").alias("local_yesterday"))


@query("""
WITH p AS (SELECT *, CASE WHEN p_size > 10 THEN p_size END AS known_size FROM part)
SELECT p_partkey,
  CASE WHEN known_size IS NOT NULL THEN greatest(known_size, 25) END AS at_least_25,
  CASE WHEN known_size IS NOT NULL THEN least(known_size, 25) END AS at_most_25,
  CAST(floor(p_retailprice / 7) AS BIGINT) AS sevenths,
  p_retailprice / nullif(p_size - 10, 0) AS per_size,
  round(1 - p_size / 100.0, 4) AS remainder_share,
  CAST(trunc(p_size / 2.0 + 0.5) AS BIGINT) AS half_up,
  coalesce(known_size, -1) AS size_or_default
FROM p
""", maybe_null=["at_least_25", "at_most_25"])
def math_functions(t: Tables) -> DataFrame:
    known = F.when(F.col("p_size") > 10, F.col("p_size"))
    return t.part.select(
        "p_partkey",
        strict_greatest(known, F.lit(25)).alias("at_least_25"),
        strict_least(known, F.lit(25)).alias("at_most_25"),
        F.floor(F.col("p_retailprice") / 7).alias("sevenths"),
        ratio("p_retailprice", F.col("p_size") - 10).alias("per_size"),
        F.round(complement(F.col("p_size") / 100.0), 4).alias("remainder_share"),
        F.round(F.col("p_size") / 2.0).cast("bigint").alias("half_up"),
        F.coalesce(known, F.lit(-1)).alias("size_or_default"),
    )
