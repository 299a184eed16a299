"""Composite lifecycle operators over the driver tables.

Reading of the tables: a customer is an account, an order an opportunity (date = close date,
priority = type, price = amount, status 'F' = closed), the first order the win, line items are
revenue lines and events the activity log.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.registry import AS_OF, Tables, as_of_date, query
from wintide.functions import (
    band,
    composite_key,
    distinct_list,
    days_left,
    elapsed_days,
    elapsed_months31,
    group_values,
    license_floor,
    lifecycle_status,
    normalize_id,
    pct_change,
    quarter_end,
    role_label,
    split_name,
    strict_greatest,
    strict_least,
    transition,
    weighted_level,
    year_quarter,
)
from wintide.operators import (
    Feature,
    Flag,
    account_360,
    any_like,
    as_of_instant,
    classify_set,
    coalesce_sources,
    cohort_rollup,
    current_rows,
    dominant_value,
    edge_events,
    engagement_score,
    exclude_members_unless,
    flagged_accounts,
    flags_of_set,
    funnel_durations,
    funnel_rollup,
    is_member,
    latest_per_key,
    latest_snapshot,
    lookup,
    milestones,
    month_offsets,
    more_than,
    on_days,
    only,
    owner_chain,
    preaggregate_join,
    quota_cut,
    reporting_dates,
    scd2_as_of,
    semi_filter,
    snapshot_join,
    state_at,
    tenure_windows,
    trailing_sum,
    typed_metrics,
    with_calendar,
    within,
)
from wintide.sources import TableSet, attach_database, fresh_place, read_table, stage, write_table

PRIORITY_GROUPS = {
    "high": ["1-URGENT", "2-HIGH"],
    "medium": ["3-MEDIUM"],
    "low": ["4-NOT SPECIFIED", "5-LOW"],
}


def closed_orders(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate").alias("day")
    return t.orders.filter("o_orderstatus = 'F'").select("*", day)


def wins(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("win_date"))


WINS = "wins AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS win_date FROM orders GROUP BY 1)"
CLOSED = "closed AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'F')"


# ---- edge events -------------------------------------------------------------------------------


@query(f"""
WITH {WINS}, {CLOSED},
firsts AS (SELECT * FROM closed
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) = 1)
SELECT o_custkey, win_date::VARCHAR AS win_date, o_orderkey AS first_order, day::VARCHAR AS first_date,
  o_totalprice AS first_amount, CAST(day - win_date AS INTEGER) AS days_to_first,
  CAST(floor((day - win_date) / 31) + 1 AS BIGINT) AS months_to_first
FROM firsts JOIN wins USING (o_custkey) WHERE day > win_date
""")
def first_order_after_win(t: Tables) -> DataFrame:
    """First closed order per customer, only where it lies strictly after the win date."""
    first = edge_events(closed_orders(t), ["o_custkey"], "day", ["o_orderkey"], "o_totalprice", which=["first"])
    joined = lookup(first, wins(t), "o_custkey", how="inner")
    return joined.filter(F.col("first.day") > F.col("win_date")).select(
        "o_custkey",
        "win_date",
        F.col("first.o_orderkey").alias("first_order"),
        F.col("first.day").alias("first_date"),
        F.col("first.amount").alias("first_amount"),
        elapsed_days("first.day", "win_date").alias("days_to_first"),
        elapsed_months31("first.day", "win_date").alias("months_to_first"),
    )


@query(f"""
WITH {CLOSED}
SELECT o_custkey,
  arg_min(o_orderkey, (day, o_orderkey)) AS first_order, min(day)::VARCHAR AS first_date,
  arg_max(o_orderkey, (day, o_orderkey)) AS last_order, max(day)::VARCHAR AS last_date,
  arg_max(o_totalprice, (day, o_orderkey)) AS last_amount
FROM closed GROUP BY 1
""")
def first_last_event(t: Tables) -> DataFrame:
    both = edge_events(closed_orders(t), ["o_custkey"], "day", ["o_orderkey"], "o_totalprice")
    return both.select(
        "o_custkey",
        F.col("first.o_orderkey").alias("first_order"),
        F.col("first.day").alias("first_date"),
        F.col("last.o_orderkey").alias("last_order"),
        F.col("last.day").alias("last_date"),
        F.col("last.amount").alias("last_amount"),
    )


@query(f"""
WITH {CLOSED}
SELECT o_custkey, o_orderkey, day::VARCHAR AS first_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' ELSE o_orderpriority END AS type_group
FROM closed
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY day, o_orderkey) = 1
""")
def first_event_by_type(t: Tables) -> DataFrame:
    """Ranked by raw type, then grouped: two raw types of one group give two firsts."""
    keys = ["o_custkey", "o_orderpriority"]
    first = edge_events(closed_orders(t), keys, "day", ["o_orderkey"], "o_totalprice", which=["first"])
    rest = ["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return first.select(
        "o_custkey",
        F.col("first.o_orderkey").alias("o_orderkey"),
        F.col("first.day").alias("first_date"),
        group_values("o_orderpriority", [("high", PRIORITY_GROUPS["high"]), (None, rest)]).alias("type_group"),
    )


# ---- latest rows and snapshots -----------------------------------------------------------------


@query("""
SELECT user_id, event_id, CAST(ts AS DATE)::VARCHAR AS day FROM events
QUALIFY rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1
""")
def latest_per_key_with_ties(t: Tables) -> DataFrame:
    daily = t.events.select("user_id", "event_id", F.to_date("ts").alias("day"))
    return latest_per_key(daily, ["user_id"], "day", ties="all")


@query("""
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key_single(t: Tables) -> DataFrame:
    newest = latest_per_key(t.events, ["user_id", "event_type"], "ts", tie_breakers=["event_id"])
    return newest.select("event_id", "user_id", "event_type", "value")


@query("""
SELECT user_id, event_id FROM events
QUALIFY rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) = 1
""")
def oldest_per_key_with_ties(t: Tables) -> DataFrame:
    daily = t.events.select("user_id", "event_id", F.to_date("ts").alias("day"))
    return latest_per_key(daily, ["user_id"], "day", ties="all", newest=False).drop("day")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_snapshot_rows(t: Tables) -> DataFrame:
    return latest_snapshot(t.orders, "o_orderdate").select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, max(value) AS top FROM events GROUP BY ALL),
drivers AS (SELECT user_id, CAST(max(ts) AS DATE) AS run_day FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT user_id, run_day::VARCHAR AS run_day, n, top FROM drivers
LEFT JOIN daily USING (user_id) WHERE run_day = day
""")
def snapshot_at_own_run(t: Tables) -> DataFrame:
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top")
    )
    drivers = t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(
        F.to_date(F.max("ts")).alias("run_day")
    )
    return snapshot_join(drivers, daily, "user_id", "run_day", "day")


@query("""
WITH newest AS (SELECT * FROM events
  QUALIFY rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1)
SELECT DISTINCT user_id FROM newest WHERE value > 20
""")
def last_state_with_amount(t: Tables) -> DataFrame:
    """Users whose latest day holds a large event; the filter comes after the ranking."""
    daily = t.events.select("user_id", "value", F.to_date("ts").alias("day"))
    return latest_per_key(daily, ["user_id"], "day", ties="all").filter("value > 20").select("user_id").distinct()


# ---- slowly changing dimensions ----------------------------------------------------------------

HISTORY = """history AS (
  SELECT o_custkey AS id, year(o_orderdate) AS y, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority,
    make_date(year(o_orderdate), 1, 1)::TIMESTAMP AS valid_from,
    make_date(year(o_orderdate) + 1, 1, 1)::TIMESTAMP AS valid_to,
    CASE WHEN year(o_orderdate) = 2001 THEN 'Y' ELSE 'N' END AS dw_curr_ind
  FROM orders GROUP BY ALL)"""
SHIPMENTS = """shipments AS (
  SELECT l_orderkey, l_linenumber, l_partkey, o_custkey,
    (greatest(l_shipdate::DATE, DATE '1996-07-01') + 1)::TIMESTAMP AS at_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
AS_OF_SQL = f"""
WITH {HISTORY}, {SHIPMENTS}
SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, priority
FROM shipments LEFT JOIN history ON id = o_custkey AND at_ts BETWEEN valid_from AND valid_to
"""


def priority_history(t: Tables) -> DataFrame:
    """One version per customer and year; versions touch on New Year's midnight."""
    y = F.year("o_orderdate")
    return (
        t.orders.groupBy(F.col("o_custkey").alias("id"), y.alias("y"))
        .agg(F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("priority"))
        .select(
            "id",
            "priority",
            F.make_date("y", F.lit(1), F.lit(1)).cast("timestamp").alias("dw_eff_start"),
            F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).cast("timestamp").alias("dw_eff_end"),
            F.when(F.col("y") == 2001, "Y").otherwise("N").alias("dw_curr_ind"),
        )
    )


def shipments(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("ship_day"))
    return lookup(lines, t.orders, [("l_orderkey", "o_orderkey")], ["o_custkey"], "inner")


@query(f"WITH {HISTORY} SELECT id, priority FROM history WHERE dw_curr_ind = 'Y'")
def scd2_current(t: Tables) -> DataFrame:
    return current_rows(priority_history(t)).select("id", "priority")


@query(AS_OF_SQL)
def scd2_as_of_ship_date(t: Tables) -> DataFrame:
    at = as_of_instant("ship_day", date(1996, 7, 1))
    out = scd2_as_of(shipments(t), priority_history(t), [("o_custkey", "id")], at, columns=["priority"])
    return out.drop("ship_day")


@query(AS_OF_SQL)
def scd2_as_of_by_slice(t: Tables) -> DataFrame:
    """Same rows as the plain form, with versions unrolled over half-year slices."""
    at = as_of_instant("ship_day", date(1996, 7, 1))
    ship_days = t.lineitem.select(F.to_date("l_shipdate").alias("ship_day"))
    out = scd2_as_of(
        shipments(t),
        priority_history(t),
        [("o_custkey", "id")],
        at,
        columns=["priority"],
        slice_months=6,
        reach_of=ship_days,
    )
    return out.drop("ship_day")


@query(AS_OF_SQL)
def scd2_as_of_by_range(t: Tables) -> DataFrame:
    """Same rows, keys with more than two versions dealt over ranges of their own versions."""
    at = as_of_instant("ship_day", date(1996, 7, 1))
    on = [("o_custkey", "id")]
    out = scd2_as_of(shipments(t), priority_history(t), on, at, columns=["priority"], per_range=2)
    return out.drop("ship_day")


# A third of all orders share one key, which has a version for every day of its orders.
HOT_KEY = "CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END"


@query(f"""
WITH daily AS (
  SELECT {HOT_KEY} AS id, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY ALL),
history AS (
  SELECT id, top, n, day::TIMESTAMP AS valid_from,
    coalesce(lead(day) OVER (PARTITION BY id ORDER BY day), DATE '2002-01-01')::TIMESTAMP AS valid_to FROM daily),
shipped AS (
  SELECT {HOT_KEY} AS id, l_shipdate::DATE::TIMESTAMP AS at_ts, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT s.id, count(*) AS matched, count(DISTINCT at_ts) AS days, max(top) AS top, sum(n)::BIGINT AS orders_seen
FROM shipped s JOIN history h ON h.id = s.id AND at_ts BETWEEN valid_from AND valid_to GROUP BY 1
""")
def scd2_as_of_hot_key(t: Tables) -> DataFrame:
    """A third of all shipments and thousands of touching versions under one key; both versions count at a touch."""
    key = F.when(F.col("o_custkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).alias("id")
    day = F.to_date("o_orderdate").alias("day")
    daily = t.orders.groupBy(key, day).agg(F.max("o_totalprice").alias("top"), F.count(F.lit(1)).alias("n"))
    following = F.lead("day").over(Window.partitionBy("id").orderBy("day"))
    history = daily.select(
        "id",
        "top",
        "n",
        F.col("day").cast("timestamp").alias("dw_eff_start"),
        F.coalesce(following, F.lit(date(2002, 1, 1))).cast("timestamp").alias("dw_eff_end"),
    )
    lines = t.lineitem.select("l_orderkey", F.to_date("l_shipdate").alias("ship_day"))
    shipped = lookup(lines, t.orders, [("l_orderkey", "o_orderkey")], [key], "inner")
    at = F.col("ship_day").cast("timestamp")
    met = scd2_as_of(shipped, history, "id", at, how="inner", per_range=64)
    days = met.groupBy("id", "ship_day").agg(
        F.count(F.lit(1)).alias("m"), F.max("top").alias("top"), F.sum("n").alias("seen")
    )
    return days.groupBy("id").agg(
        F.sum("m").alias("matched"),
        F.count(F.lit(1)).alias("days"),
        F.max("top").alias("top"),
        F.sum("seen").alias("orders_seen"),
    )


@query(f"""
WITH {WINS}, daily AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, top AS top_at_win, n AS orders_at_win
FROM wins LEFT JOIN daily USING (o_custkey) WHERE day = win_date AND win_date >= DATE '1995-06-01'
UNION ALL
SELECT o_custkey, top, n FROM (SELECT * FROM wins WHERE win_date < DATE '1995-06-01') w
LEFT JOIN (SELECT * FROM daily WHERE day = DATE '1995-06-01') d USING (o_custkey)
""", maybe_null=["orders_at_win"])
def state_at_win(t: Tables) -> DataFrame:
    """Fact row at the win date, moved up to the start of history where that is later."""
    daily = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(
        F.max("o_totalprice").alias("top_at_win"), F.count(F.lit(1)).alias("orders_at_win")
    )
    at = strict_greatest("win_date", F.lit(date(1995, 6, 1)))
    return state_at(wins(t), daily, "o_custkey", at, "day").drop("win_date")


@query(f"""
WITH daily AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS top FROM orders GROUP BY ALL),
ends AS (
  SELECT o_custkey, max(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 1 END) AS churn_date
  FROM orders GROUP BY 1),
probe AS (SELECT o_custkey, least(DATE '{AS_OF}', coalesce(churn_date - 1, DATE '9999-12-31')) AS day FROM ends)
SELECT o_custkey, top AS last_active_top FROM probe LEFT JOIN daily USING (o_custkey, day)
""")
def state_at_last_active(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    daily = t.orders.groupBy("o_custkey", day.alias("day")).agg(F.max("o_totalprice").alias("last_active_top"))
    ends = t.orders.groupBy("o_custkey").agg(
        F.max(F.when(F.col("o_orderstatus") != "P", F.date_add(day, 1))).alias("churn_date")
    )
    last_day = F.coalesce(F.date_sub("churn_date", 1), F.lit(date(9999, 12, 31)))
    return state_at(ends, daily, "o_custkey", strict_least(as_of_date(), last_day), "day").drop("churn_date")


# ---- ranking -----------------------------------------------------------------------------------


@query("""
WITH w AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
r AS (SELECT * FROM w QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY n DESC) = 1)
SELECT o_custkey, max(o_orderpriority) AS main_priority FROM r GROUP BY 1
""")
def dominant_priority(t: Tables) -> DataFrame:
    weighted = t.orders.select("o_custkey", "o_orderpriority", F.lit(1).alias("one"))
    return dominant_value(weighted, ["o_custkey"], "o_orderpriority", "one", "main_priority")


# Position at which each region is cut; the last one is larger than any region here.
QUOTAS = {"AMERICA": 100, "EUROPE": 50, "ASIA": 10, "AFRICA": 4_000_000_000_000_000_000}
RANKED = """ranked AS (
  SELECT c_custkey, r_name, CAST(floor(c_acctbal / 10) AS BIGINT) AS rank_value
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
quotas AS (SELECT * FROM (VALUES ('AMERICA', 100), ('EUROPE', 50), ('ASIA', 10), ('AFRICA', 4000000000000000000)) q(r_name, n)),
positions AS (
  SELECT r_name, rank_value, row_number() OVER (PARTITION BY r_name ORDER BY rank_value) AS pos FROM ranked),
cuts AS (SELECT r_name, rank_value AS cut FROM positions JOIN quotas USING (r_name) WHERE pos = n)"""


def ranked_customers(t: Tables) -> DataFrame:
    named = lookup(t.customer, t.nation, [("c_nationkey", "n_nationkey")], ["n_regionkey"], "inner")
    named = lookup(named, t.region, [("n_regionkey", "r_regionkey")], ["r_name"], "inner")
    return named.select("c_custkey", "r_name", F.floor(F.col("c_acctbal") / 10).alias("rank_value"))


@query(f"WITH {RANKED} SELECT c_custkey, r_name, rank_value FROM ranked JOIN cuts USING (r_name) WHERE rank_value <= cut")
def quota_cut_by_region(t: Tables) -> DataFrame:
    return quota_cut(ranked_customers(t), "r_name", "rank_value", QUOTAS, ["c_custkey"])


@query(f"""
WITH {RANKED} SELECT c_custkey, r_name, rank_value FROM ranked LEFT JOIN cuts USING (r_name)
WHERE (rank_value <= cut OR cut IS NULL) AND r_name IN (SELECT r_name FROM quotas)
""")
def quota_cut_keep_short_regions(t: Tables) -> DataFrame:
    return quota_cut(ranked_customers(t), "r_name", "rank_value", QUOTAS, ["c_custkey"], short="all")


# ---- ids, labels, lists ------------------------------------------------------------------------


@query("""
WITH dirty AS (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_custkey || '.0' WHEN 1 THEN o_custkey || '.5'
    WHEN 2 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS ref FROM orders)
SELECT o_orderkey, CAST(trunc(try_cast(ref AS DOUBLE) + 0.5) AS BIGINT) AS numeric_id,
  split_part(ref, '.', 1) AS prefix_id FROM dirty
""", maybe_null=["numeric_id"])
def normalize_ids(t: Tables) -> DataFrame:
    cust = F.col("o_custkey").cast("string")
    turn = F.col("o_orderkey") % 4
    ref = (
        F.when(turn == 0, F.concat(cust, F.lit(".0")))
        .when(turn == 1, F.concat(cust, F.lit(".5")))
        .when(turn == 2, F.col("o_orderpriority"))
        .otherwise(cust)
    )
    return t.orders.select(
        "o_orderkey", normalize_id(ref).alias("numeric_id"), normalize_id(ref, "prefix").alias("prefix_id")
    )


@query("""
SELECT c_custkey, CASE WHEN c_acctbal = 1863.84 THEN 'exact' WHEN c_acctbal < 0 THEN 'debt'
  WHEN c_acctbal < 2500 THEN 'A. <2.5K' WHEN c_acctbal < 7500 THEN 'B. 2.5-7.5K' ELSE 'C. 7.5K+' END AS balance_band
FROM customer
""")
def band_balance(t: Tables) -> DataFrame:
    steps = [(0, "debt"), (2500, "A. <2.5K"), (7500, "B. 2.5-7.5K")]
    label = band("c_acctbal", steps, "C. 7.5K+", "Unknown", exact={1863.84: "exact"})
    return t.customer.select("c_custkey", label.alias("balance_band"))


@query(f"""
WITH {WINS}, ages AS (
  SELECT o_custkey, CASE WHEN o_custkey % 5 > 0 THEN (DATE '{AS_OF}' - win_date) / 365.0 END AS years FROM wins)
SELECT o_custkey, CASE WHEN years IS NULL THEN 'Unknown' WHEN years < 5 THEN '<5 yr' WHEN years < 6 THEN '5-6 yr'
  ELSE '6+ yrs' END AS tenure FROM ages
""")
def band_tenure(t: Tables) -> DataFrame:
    years = F.when(F.col("o_custkey") % 5 > 0, F.datediff(as_of_date(), "win_date") / 365.0)
    label = band(years, [(5, "<5 yr"), (6, "5-6 yr")], "6+ yrs", "Unknown")
    return wins(t).select("o_custkey", label.alias("tenure"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
  WHEN o_orderpriority LIKE '%LOW' THEN 'low' WHEN o_orderpriority = '3-MEDIUM' THEN '3-MEDIUM'
  ELSE 'other' END AS priority_group FROM orders
""")
def group_priority(t: Tables) -> DataFrame:
    rules = [("high", ["1-URGENT", "2-HIGH"]), ("low", "%LOW"), (None, ["3-MEDIUM"])]
    return t.orders.select("o_orderkey", group_values("o_orderpriority", rules, "other").alias("priority_group"))


PRODUCT_LINES = """bought AS (
  SELECT o_custkey, p_type, p_brand FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey)"""


@query(f"""
WITH {PRODUCT_LINES}, sets AS (
  SELECT o_custkey, count(DISTINCT p_type) AS types, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS type_list,
    count(*) FILTER (WHERE p_type NOT IN ('SMALL', 'MEDIUM', 'LARGE')) AS unsized FROM bought GROUP BY 1)
SELECT o_custkey, type_list,
  CASE WHEN type_list = 'PROMO' THEN 'Promo-only'
    WHEN unsized = 0 THEN 'Sized only'
    WHEN type_list LIKE '%STANDARD%' THEN 'Standard' WHEN types > 1 THEN 'Multi' ELSE 'Other' END AS mix
FROM sets
""")
def product_mix(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey")
    bought = lookup(lines, t.orders, [("l_orderkey", "o_orderkey")], ["o_custkey"], "inner")
    bought = lookup(bought, t.part, [("l_partkey", "p_partkey")], ["p_type"], "inner")
    rules = [
        ("Promo-only", only("p_type", "PROMO")),
        ("Sized only", within("p_type", ["SMALL", "MEDIUM", "LARGE"])),
        ("Standard", any_like("p_type", "%STANDARD%")),
        ("Multi", more_than("p_type", 1)),
    ]
    extra = [distinct_list("p_type").alias("type_list")]
    return classify_set(bought, ["o_custkey"], ["p_type"], rules, "Other", "mix", extra)


@query("""
SELECT o_custkey, count(DISTINCT o_orderkey) AS num_events,
  count(DISTINCT o_orderkey) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS num_high,
  count(DISTINCT o_orderkey) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS num_medium,
  count(DISTINCT o_orderkey) FILTER (WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')) AS num_low,
  round(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice ELSE 0 END), 2) AS high_amount,
  round(sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice ELSE 0 END), 2) AS medium_amount,
  round(sum(CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN o_totalprice ELSE 0 END), 2) AS low_amount,
  round(sum(o_totalprice), 2) AS total_amount
FROM orders GROUP BY 1
""")
def typed_counts_and_sums(t: Tables) -> DataFrame:
    out = typed_metrics(
        t.orders, ["o_custkey"], "o_orderkey", "o_orderpriority", "o_totalprice", PRIORITY_GROUPS, "num_{}"
    )
    money = [c for c in out.columns if c.endswith("_amount")]
    return out.withColumns({c: F.round(c, 2) for c in money})


@query("""
WITH b AS (SELECT l_suppkey, max(CASE WHEN p_size = 50 THEN 'Y' ELSE 'N' END) AS licence,
    max(CAST(l_quantity AS BIGINT)) AS seats
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT l_suppkey, CASE WHEN licence = 'Y' THEN greatest(seats, 60) ELSE seats END AS seats FROM b
""")
def licence_seat_floor(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_quantity")
    sized = lookup(lines, t.part, [("l_partkey", "p_partkey")], ["p_size"], "inner")
    licensed = F.max(F.col("p_size") == 50)
    seats = license_floor(F.max(F.col("l_quantity").cast("bigint")), licensed, 60)
    return sized.groupBy("l_suppkey").agg(seats.alias("seats"))


@query("""
SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN p_size * l_quantity ELSE 0 END)
  / nullif(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 0)) AS avg_level,
  max(CASE WHEN l_returnflag = 'R' THEN p_size ELSE 0 END) AS max_level
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def weighted_levels(t: Tables) -> DataFrame:
    lines = lookup(t.lineitem, t.part, [("l_partkey", "p_partkey")], ["p_size"], "inner")
    returned = F.col("l_returnflag") == "R"
    return lines.groupBy("l_suppkey").agg(
        weighted_level("p_size", "l_quantity", returned).alias("avg_level"),
        F.max(F.when(returned, F.col("p_size")).otherwise(0)).alias("max_level"),
    )


# ---- membership --------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def semi_filter_large_buyers(t: Tables) -> DataFrame:
    large = t.orders.filter("o_totalprice > 450000")
    return semi_filter(t.customer, large, [("c_custkey", "o_custkey")]).select("c_custkey", "c_name")


@query("""
WITH s AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')
SELECT c_custkey, CASE WHEN c_custkey IN (FROM s) THEN c_custkey END AS buyer,
  CASE WHEN c_custkey NOT IN (FROM s) THEN c_custkey END AS non_buyer FROM customer
""", maybe_null=["buyer", "non_buyer"])
def membership_flags(t: Tables) -> DataFrame:
    buyers = t.events.filter("event_type = 'purchase'").select("user_id")
    on, key = ("c_custkey", "user_id"), F.col("c_custkey")
    both = [Flag("buyer", key), Flag("non_buyer", key, negate=True)]
    return flags_of_set(t.customer, buyers, on, both).select("c_custkey", "buyer", "non_buyer")


@query("""
WITH s AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS k FROM orders),
p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_custkey END AS probe FROM customer)
SELECT c_custkey, CAST(probe IN (FROM s) AS VARCHAR) AS member FROM p
""")
def membership_with_nulls(t: Tables) -> DataFrame:
    """Three-valued IN: NULL probes and a NULL inside the set stay undecided."""
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("k")
    keys = t.orders.select(key)
    probe = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey")).alias("probe"))
    out = is_member(probe, keys, ("probe", "k"), "member")
    return out.select("c_custkey", F.col("member").cast("string").alias("member"))


@query("""
SELECT c_custkey FROM customer
WHERE c_mktsegment = 'BUILDING' OR c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def exclude_unless(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    keep = F.col("c_mktsegment") == "BUILDING"
    return exclude_members_unless(t.customer, urgent, ("c_custkey", "o_custkey"), keep).select("c_custkey")


@query("""
SELECT DISTINCT c_custkey AS account_id, c_name AS crm_account_id FROM customer
JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY' OR o_orderpriority = '1-URGENT'
""")
def fraud_accounts(t: Tables) -> DataFrame:
    accounts = t.customer.select(F.col("c_custkey").alias("account_id"))
    customers = t.customer.select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("crm_account_id"),
        F.col("c_mktsegment").alias("billing_batch"),
    )
    billing = t.orders.select(F.col("o_custkey").alias("account_id"), F.col("o_orderpriority").alias("account_type"))
    marked = flagged_accounts(accounts, customers, billing, ["MACHINERY"], ["1-URGENT"])
    return marked.select("account_id", "crm_account_id").distinct()


# ---- cohorts -----------------------------------------------------------------------------------

DAYS = range(30, 451, 30)


@query(f"""
WITH {WINS} SELECT o_custkey, {", ".join(
    f"CASE WHEN DATE '{AS_OF}' >= win_date + {n} THEN (win_date + {n})::VARCHAR END AS date_{n}" for n in DAYS)}
FROM wins
""")
def tenure_milestones(t: Tables) -> DataFrame:
    return milestones(wins(t), "win_date", DAYS, as_of_date()).drop("win_date")


def _window_sql(n: int) -> str:
    lower = "" if n == 30 else f"AND day > win_date + {n - 30}"
    test = f"DATE '{AS_OF}' >= win_date + {n} AND day <= win_date + {n} {lower}"
    return (
        f"round(sum(CASE WHEN {test} THEN o_totalprice END), 2) AS exp_arr_{n}d, "
        f"CAST(sum(CASE WHEN {test} THEN 1 END) AS BIGINT) AS exp_{n}d"
    )


WINDOWS = f"""{WINS}, {CLOSED}, windows AS (
  SELECT wins.o_custkey, win_date, {", ".join(_window_sql(n) for n in DAYS)}
  FROM wins LEFT JOIN closed USING (o_custkey) GROUP BY ALL)"""


def windowed_customers(t: Tables) -> DataFrame:
    out = tenure_windows(
        wins(t), closed_orders(t), "o_custkey", "win_date", "day", "o_totalprice", as_of_date()
    )
    return out.withColumns({f"exp_arr_{n}d": F.round(f"exp_arr_{n}d", 2) for n in DAYS})


@query(f"WITH {WINDOWS} SELECT * EXCLUDE (win_date) FROM windows", maybe_null=[
        "exp_30d", "exp_60d", "exp_90d", "exp_120d", "exp_150d", "exp_180d", "exp_210d",
        "exp_240d", "exp_270d", "exp_300d", "exp_330d", "exp_360d", "exp_390d",
        "exp_420d", "exp_450d",
    ])
def tenure_window_sums(t: Tables) -> DataFrame:
    return windowed_customers(t).drop("win_date")


@query(f"""
WITH {WINDOWS}
SELECT CAST(year(win_date) AS INTEGER) AS win_year, c_mktsegment,
  {", ".join(f"round(sum(exp_arr_{n}d), 2) AS exp_arr_{n}d, CAST(sum(exp_{n}d) AS BIGINT) AS exp_{n}d" for n in range(30, 361, 30))}
FROM windows JOIN customer ON o_custkey = c_custkey GROUP BY ALL
""", maybe_null=[
        "exp_30d", "exp_60d", "exp_90d", "exp_120d", "exp_150d", "exp_180d", "exp_210d",
        "exp_240d", "exp_270d", "exp_300d", "exp_330d", "exp_360d",
    ])
def cohort_windows(t: Tables) -> DataFrame:
    named = lookup(windowed_customers(t), t.customer, [("o_custkey", "c_custkey")], ["c_mktsegment"], "inner")
    money = [f"exp_arr_{n}d" for n in range(30, 361, 30)]
    counts = [f"exp_{n}d" for n in range(30, 361, 30)]
    rolled = cohort_rollup(
        named.withColumn("win_year", F.year("win_date")), ["win_year", "c_mktsegment"], money + counts
    )
    return rolled.withColumns({m: F.round(m, 2) for m in money})


@query(f"""
WITH {WINS} SELECT o_custkey, {", ".join(
    f"(win_date + INTERVAL {n} MONTH)::DATE::VARCHAR AS post_{n}mo" for n in range(1, 13))}
FROM wins WHERE (win_date + INTERVAL 12 MONTH)::DATE <= DATE '{AS_OF}' - 2000
""")
def month_offsets_after_win(t: Tables) -> DataFrame:
    as_of = F.date_sub(as_of_date(), 1999)
    return month_offsets(wins(t), "win_date", 12, as_of).drop("win_date")


@query(f"""
SELECT o_orderkey, CAST(floor(date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') / 31) + 1 AS BIGINT) AS age_months
FROM orders
""")
def age_in_months31(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", elapsed_months31(as_of_date(), F.to_date("o_orderdate")).alias("age_months"))


STAGES = """stages AS (
  SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS created,
    min(ts) FILTER (WHERE event_type = 'click') AS qualified,
    max(ts) FILTER (WHERE event_type = 'purchase') AS closed,
    round(sum(value) FILTER (WHERE event_type = 'purchase'), 2) AS bookings
  FROM events GROUP BY 1)"""


@query(f"""
WITH {STAGES} SELECT user_id, bookings,
  CAST(date_diff('day', created::DATE, closed::DATE) AS INTEGER) AS lead_to_win_days,
  CAST(date_diff('day', qualified::DATE, closed::DATE) AS INTEGER) AS mql_to_win_days
FROM stages
""")
def funnel_stage_days(t: Tables) -> DataFrame:
    def at(kind: str, edge) -> F.Column:
        return edge(F.when(F.col("event_type") == kind, F.col("ts")))

    stages = t.events.groupBy("user_id").agg(
        at("signup", F.min).alias("created"),
        at("click", F.min).alias("qualified"),
        at("purchase", F.max).alias("closed"),
        F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), 2).alias("bookings"),
    )
    days = {"lead_to_win_days": ("closed", "created"), "mql_to_win_days": ("closed", "qualified")}
    return funnel_durations(stages, days).drop("created", "qualified", "closed")


@query("""
SELECT event_type, c_mktsegment, count(DISTINCT user_id) AS accounts,
  CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS BIGINT) AS mqls, round(sum(value), 2) AS bookings,
  round(sum(c_acctbal), 2) AS balance
FROM events JOIN customer ON user_id = c_custkey GROUP BY ALL
""")
def funnel_cohorts(t: Tables) -> DataFrame:
    leads = t.events.withColumn("mql", F.when(F.col("value") > 20, 1).otherwise(0))
    accounts = t.customer.withColumnRenamed("c_custkey", "user_id")
    out = funnel_rollup(
        leads,
        accounts,
        "user_id",
        ["event_type"],
        ["c_mktsegment"],
        {"mqls": "mql", "bookings": "value"},
        {"balance": "c_acctbal"},
    )
    return out.withColumns({c: F.round(c, 2) for c in ("bookings", "balance")})


@query("""
WITH f AS (SELECT user_id,
    max(CASE WHEN event_type = 'view' AND value > 60 THEN 1 ELSE 0 END) AS e1,
    CASE WHEN user_id % 7 > 0 THEN max(CASE WHEN event_type = 'click' AND value > 80 THEN 1 ELSE 0 END) END AS e2,
    max(CASE WHEN event_type = 'view' AND value > 30 THEN 1 ELSE 0 END) AS a1,
    max(CASE WHEN event_type = 'click' AND value > 50 THEN 1 ELSE 0 END) AS a2,
    max(CASE WHEN event_type = 'purchase' AND value > 100 THEN 1 ELSE 0 END) AS p1,
    max(CASE WHEN event_type = 'purchase' AND value > 50 THEN 1 ELSE 0 END) AS p2
  FROM events GROUP BY 1)
SELECT user_id, CAST(p1 + p2 AS INTEGER) AS core_products_paid, CAST(a1 * p1 + a2 * p2 AS INTEGER) AS core_products_activated,
  CAST(coalesce(e1 + e2, 0) AS INTEGER) AS num_engaged_products,
  CASE WHEN e1 + e2 >= 1 THEN 'Engaged' ELSE 'Not Engaged' END AS engaged_flag
FROM f
""")
def engagement_scores(t: Tables) -> DataFrame:
    def seen(kind: str, floor: float) -> F.Column:
        return F.max(F.when((F.col("event_type") == kind) & (F.col("value") > floor), 1).otherwise(0))

    flags = t.events.groupBy("user_id").agg(
        seen("view", 60).alias("is_engaged_views"),
        F.when(F.col("user_id") % 7 > 0, seen("click", 80)).alias("is_engaged_clicks"),
        seen("view", 30).alias("is_activated_views"),
        seen("click", 50).alias("is_activated_clicks"),
        seen("purchase", 100).alias("is_paying_views"),
        seen("purchase", 50).alias("is_paying_clicks"),
    )
    scored = engagement_score(flags, ["views", "clicks"])
    return scored.select(
        "user_id", "core_products_paid", "core_products_activated", "num_engaged_products", "engaged_flag"
    )


@query(f"""
SELECT o_custkey, round(sum(o_totalprice), 2) AS spend,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS closed
FROM orders WHERE o_orderdate >= DATE '{AS_OF}' - INTERVAL 12 MONTH GROUP BY 1
""")
def trailing_year(t: Tables) -> DataFrame:
    sums = {"spend": F.col("o_totalprice"), "closed": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)}
    out = trailing_sum(t.orders, "o_custkey", "o_orderdate", sums, as_of_date())
    return out.withColumn("spend", F.round("spend", 2))


@query("""
WITH c AS (SELECT o_custkey, count(*) FILTER (WHERE year(o_orderdate) = 1995) AS before,
    count(*) FILTER (WHERE year(o_orderdate) = 2000) AS after FROM orders GROUP BY 1)
SELECT o_custkey, after - before AS diff,
  (after - before) / CASE WHEN before = 0 THEN 1 ELSE before END * 100.0 AS change_pct FROM c
""")
def percent_change(t: Tables) -> DataFrame:
    year = F.year("o_orderdate")
    counts = t.orders.groupBy("o_custkey").agg(
        F.count_if(year == 1995).alias("before"), F.count_if(year == 2000).alias("after")
    )
    return counts.select(
        "o_custkey",
        (F.col("after") - F.col("before")).alias("diff"),
        pct_change("after", "before").alias("change_pct"),
    )


@query("""
SELECT o_custkey, min(o_orderpriority) FILTER (WHERE year(o_orderdate) < 1997) || ' to ' ||
  coalesce(max(o_orderpriority) FILTER (WHERE year(o_orderdate) >= 2001), 'Churned') AS change
FROM orders GROUP BY 1
""")
def transition_labels(t: Tables) -> DataFrame:
    year, priority = F.year("o_orderdate"), F.col("o_orderpriority")
    before, after = F.min(F.when(year < 1997, priority)), F.max(F.when(year >= 2001, priority))
    return t.orders.groupBy("o_custkey").agg(transition(before, after, "Churned").alias("change"))


@query("""
WITH first AS (SELECT user_id, min(CAST(ts AS DATE)) AS day FROM events GROUP BY 1)
SELECT user_id, day::VARCHAR AS day, count(*) AS events, round(sum(value), 2) AS value
FROM events JOIN first USING (user_id) WHERE CAST(ts AS DATE) = day GROUP BY ALL
""")
def first_day_activity(t: Tables) -> DataFrame:
    """Each user's events on the first day: of a long log, little more than those lines is shuffled."""
    log = t.events.select("user_id", "value", F.to_date("ts").alias("day"))
    first = log.groupBy("user_id").agg(F.min("day").alias("day"))
    lines = on_days(log, first, ["user_id", "day"], "day", filter_words=1 << 17, calendar_days=True)
    return lines.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value")
    )


# ---- assembly ----------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, c_name, n_name AS owner_name, r_name AS role_name FROM orders
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
""")
def owner_hierarchy(t: Tables) -> DataFrame:
    """Account -> owner -> role over current rows; a missing link leaves NULLs."""
    live = F.lit("Y").alias("dw_curr_ind")
    accounts = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("ownerid"),
        "c_name",
        F.when(F.col("c_acctbal") < 0, "True").otherwise("False").alias("isdeleted"),
        live,
    )
    users = t.nation.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_regionkey").alias("userroleid"),
        F.col("n_name").alias("owner_name"),
        live,
    )
    roles = t.region.select(
        F.col("r_regionkey").alias("id"),
        F.col("r_name").alias("role_name"),
        F.when(F.col("r_name") == "ASIA", "N").otherwise("Y").alias("dw_curr_ind"),
    )
    out = owner_chain(
        t.orders,
        "o_custkey",
        accounts,
        users,
        roles,
        account_columns=["c_name"],
        user_columns=["owner_name"],
        role_columns=["role_name"],
    )
    return out.select("o_orderkey", "c_name", "owner_name", "role_name")


@query("""
WITH spend AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS spend, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
lines AS (SELECT o_custkey, max(l_quantity) AS top_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
active AS (SELECT user_id, CAST(max(ts) AS DATE)::VARCHAR AS last_seen FROM events GROUP BY 1)
SELECT c_custkey, c_name, n_name, spend, orders, top_quantity, last_seen,
  CASE WHEN active.user_id IS NOT NULL THEN '1' ELSE '0' END AS active_flag
FROM customer LEFT JOIN spend ON c_custkey = spend.o_custkey LEFT JOIN lines ON c_custkey = lines.o_custkey
LEFT JOIN active ON c_custkey = user_id LEFT JOIN nation ON c_nationkey = n_nationkey
""", maybe_null=["orders"])
def account_360_view(t: Tables) -> DataFrame:
    spend = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("spend"), F.count(F.lit(1)).alias("orders")
    )
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.max("l_quantity").alias("top"))
    owned = lookup(per_order, t.orders, [("l_orderkey", "o_orderkey")], ["o_custkey"], "inner")
    lines = owned.groupBy("o_custkey").agg(F.max("top").alias("top_quantity"))
    active = t.events.groupBy("user_id").agg(F.to_date(F.max("ts")).alias("last_seen"))
    features = [
        Feature(spend, [("c_custkey", "o_custkey")]),
        Feature(lines, [("c_custkey", "o_custkey")]),
        Feature(active, [("c_custkey", "user_id")], flag="active_flag"),
        Feature(t.nation, [("c_nationkey", "n_nationkey")], ["n_name"]),
    ]
    driver = t.customer.select("c_custkey", "c_name", "c_nationkey")
    return account_360(driver, features).drop("c_nationkey")


@query("""
WITH a AS (SELECT o_custkey, max(CASE WHEN o_totalprice > 350000 THEN o_totalprice END) AS top,
  max(CASE WHEN o_totalprice > 350000 THEN o_orderpriority END) AS label FROM orders GROUP BY 1),
b AS (SELECT user_id, max(value) AS top, max(event_type) AS label FROM events GROUP BY 1)
SELECT c_custkey, coalesce(a.top, b.top) AS top, coalesce(a.label, b.label) AS label
FROM customer LEFT JOIN a ON c_custkey = o_custkey LEFT JOIN b ON c_custkey = user_id
""")
def first_non_null_source(t: Tables) -> DataFrame:
    large = F.col("o_totalprice") > 350000
    orders = t.orders.groupBy("o_custkey").agg(
        F.max(F.when(large, F.col("o_totalprice"))).alias("top"),
        F.max(F.when(large, F.col("o_orderpriority"))).alias("label"),
    )
    activity = t.events.groupBy("user_id").agg(F.max("value").alias("top"), F.max("event_type").alias("label"))
    sources = [(orders, ("c_custkey", "o_custkey")), (activity, ("c_custkey", "user_id"))]
    return coalesce_sources(t.customer.select("c_custkey"), sources, ["top", "label"])


CALENDAR = """days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS the_date FROM orders),
calendar AS (SELECT the_date, CAST(year(the_date) AS INTEGER) AS fiscal_year, strftime(the_date, '%Y-%m') AS month_year,
  year(the_date) || 'Q' || quarter(the_date) AS year_quarter,
  CASE WHEN the_date = last_day(date_trunc('quarter', the_date)::DATE + INTERVAL 2 MONTH) THEN 'Y' ELSE 'N' END AS last_day_of_qtr_ind
  FROM days WHERE the_date < DATE '2001-06-01' OR the_date > DATE '2001-06-10')"""


def order_calendar(t: Tables) -> DataFrame:
    day = F.col("the_date")
    days = t.orders.select(F.to_date("o_orderdate").alias("the_date")).distinct()
    open_days = days.filter((day < date(2001, 6, 1)) | (day > date(2001, 6, 10)))
    return open_days.select(
        "the_date",
        F.year(day).alias("fiscal_year"),
        F.date_format(day, "yyyy-MM").alias("month_year"),
        year_quarter(day).alias("year_quarter"),
        F.when(day == quarter_end(day), "Y").otherwise("N").alias("last_day_of_qtr_ind"),
    )


@query(f"""
WITH {CALENDAR} SELECT o_orderkey, fiscal_year, month_year, year_quarter
FROM orders JOIN calendar ON CAST(o_orderdate AS DATE) = the_date
""")
def calendar_attributes(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    out = with_calendar(orders, order_calendar(t), "day", ["fiscal_year", "month_year", "year_quarter"])
    return out.drop("day")


@query(f"""
WITH {CALENDAR} SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS day
FROM orders JOIN calendar ON CAST(o_orderdate AS DATE) = the_date
  AND (last_day_of_qtr_ind = 'Y' OR the_date = DATE '{AS_OF}' - 1) AND fiscal_year >= 1998
""")
def quarter_end_or_yesterday(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return reporting_dates(orders, order_calendar(t), "day", F.date_sub(as_of_date(), 1), 1998)


@query(f"""
WITH recent AS (SELECT o_custkey, sum(o_totalprice) AS amount FROM orders
  WHERE o_orderdate >= DATE '{AS_OF}' - INTERVAL 6 MONTH GROUP BY 1)
SELECT c_custkey, CASE WHEN amount > 0 THEN 'Customer' ELSE 'Churned' END AS status
FROM customer LEFT JOIN recent ON c_custkey = o_custkey
""")
def lifecycle_states(t: Tables) -> DataFrame:
    recent = trailing_sum(t.orders, "o_custkey", "o_orderdate", {"amount": F.col("o_totalprice")}, as_of_date(), 6)
    out = lookup(t.customer, recent, [("c_custkey", "o_custkey")])
    return out.select("c_custkey", lifecycle_status("amount").alias("status"))


@query("""
SELECT s_suppkey, CASE WHEN s_name = 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AND s_suppkey % 4 > 0
  THEN 'Owner' ELSE 'Admin' END AS role,
  CASE WHEN s_suppkey % 4 > 0 THEN s_name ELSE '' END || coalesce(CAST(s_suppkey AS VARCHAR), '') AS key
FROM supplier JOIN customer ON c_custkey = s_suppkey - s_suppkey % 3
""")
def roles_and_composite_keys(t: Tables) -> DataFrame:
    """A NULL name is no owner and counts as empty text in the key."""
    known = F.when(F.col("s_suppkey") % 4 > 0, F.col("s_name"))
    probe = t.supplier.withColumn("head", F.col("s_suppkey") - F.col("s_suppkey") % 3)
    joined = lookup(probe, t.customer, [("head", "c_custkey")], columns=[], how="inner")
    expected = F.concat(F.lit("Supplier#"), F.lpad(F.col("head").cast("string"), 9, "0"))
    return joined.select(
        "s_suppkey",
        role_label(known, expected).alias("role"),
        composite_key(known, "s_suppkey").alias("key"),
    )


@query("""
WITH n AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN split_part(p_name, ' ', 1)
  ELSE p_name || ' ' || p_type END AS name FROM part)
SELECT p_partkey, split_part(name, ' ', 1) AS first_name,
  CASE WHEN name LIKE '% %' THEN substr(name, position(' ' IN name) + 1) ELSE name END AS last_name FROM n
""")
def split_names(t: Tables) -> DataFrame:
    turn = F.col("p_partkey") % 3
    name = (
        F.when(turn == 0, F.col("p_name"))
        .when(turn == 1, F.substring_index("p_name", " ", 1))
        .otherwise(F.concat("p_name", F.lit(" "), "p_type"))
    )
    first, last = split_name(name)
    return t.part.select("p_partkey", first.alias("first_name"), last.alias("last_name"))


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(date_diff('day', DATE '{AS_OF}', o_orderdate::DATE + 30) AS INTEGER) END AS days_left
FROM orders WHERE o_orderstatus IN ('F', 'O') OR (o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '2000-01-01')
""", maybe_null=["days_left"])
def eligible_accounts(t: Tables) -> DataFrame:
    """State in a set, or expired after a date; running rows also get their days left."""
    status = F.col("o_orderstatus")
    recent = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    kept = t.orders.filter(status.isin("F", "O") | ((status == "P") & recent))
    left = days_left(F.date_add(F.to_date("o_orderdate"), 30), as_of_date(), status == "O")
    return kept.select("o_orderkey", left.alias("days_left"))


@query("""
WITH k AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS top FROM events GROUP BY ALL),
d AS (SELECT user_id, CAST(min(ts) AS DATE) AS day FROM events GROUP BY 1)
SELECT user_id, top, CASE WHEN top > 50 THEN 1 ELSE 0 END AS large_flag FROM d LEFT JOIN k USING (user_id, day)
""")
def preaggregated_feature(t: Tables) -> DataFrame:
    drivers = t.events.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("day"))
    feature = t.events.select("user_id", "value", F.to_date("ts").alias("day"))
    out = preaggregate_join(drivers, feature, ["user_id", "day"], [F.max("value").alias("top")])
    return out.select("user_id", "top", F.when(F.col("top") > 50, 1).otherwise(0).alias("large_flag"))


@query("""
SELECT o_custkey, o_orderstatus, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY ALL
""")
def staged_totals(t: Tables) -> DataFrame:
    """A roll-up written to the shared folder and read back."""
    totals = t.orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.round(F.sum("o_totalprice"), 2).alias("spend")
    )
    return stage(totals, "staged_totals")


@query("""
SELECT o_custkey, n AS orders, coalesce(m, 0) AS events, spend FROM
  (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS spend FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1)
  LEFT JOIN (SELECT user_id, count(*) AS m FROM events GROUP BY 1) ON user_id = o_custkey
""")
def stored_reports_joined(t: Tables) -> DataFrame:
    """Two reports stored in buckets of the account and read back: the join between them shuffles nothing.

    The first is written twice, the second time replacing only the partition of one order status.
    """
    spark, place = t.spark, fresh_place(t.spark, "stored_reports")
    buckets = (int(spark.conf.get("spark.sql.shuffle.partitions")), ["account"])
    per_account = t.orders.groupBy(F.col("o_custkey").alias("account"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("spend")
    )
    by_status = f"{place}/by_status"
    write_table(per_account.withColumn("spend", F.lit(0.0)), by_status, partition_by=["o_orderstatus"])
    for status in ("F", "P"):
        mine = per_account.filter(F.col("o_orderstatus") == status)
        write_table(mine, by_status, partition_by=["o_orderstatus"], mode="overwrite_partitions")
    closed = read_table(spark, by_status).filter("o_orderstatus <> 'O'").groupBy("account")
    totals = closed.agg(F.sum("orders").alias("orders"), F.round(F.sum("spend"), 2).alias("spend"))
    events = t.events.groupBy(F.col("user_id").alias("account")).agg(F.count(F.lit(1)).alias("events"))
    names = [f"stored_{n}_{place.rsplit('-', 1)[1]}" for n in ("spend", "events")]
    for name, report in zip(names, (totals, events)):
        write_table(report, name, as_table=True, bucket_by=buckets, location=f"{place}/{name}")
    spends, counts = (read_table(spark, n) for n in names)
    joined = lookup(spends.hint("merge"), counts, "account", ["events"])
    return joined.select(
        F.col("account").alias("o_custkey"), "orders", F.coalesce("events", F.lit(0)).alias("events"), "spend"
    )


@query("""
SELECT n_name, count(*) AS accounts, sum(coalesce(n, 0))::BIGINT AS events FROM customer
JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) ON user_id = c_custkey
GROUP BY 1
""")
def tables_of_several_databases(t: Tables) -> DataFrame:
    """One report over three databases: accounts, geography and usage, each table found by its logical name."""
    place = fresh_place(t.spark, "databases")
    databases = {"sales": ["customer"], "geo": ["nation"], "usage": ["events"]}
    names = {}
    for database, tables in databases.items():
        named = f"{database}_{place.rsplit('-', 1)[1]}"
        paths = {table: f"{t.folder}/{table}.parquet" for table in tables}
        names |= attach_database(t.spark, named, paths, f"{place}/{database}")
    tables = TableSet(t.spark, names=names)
    per_user = tables["events"].groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    accounts = lookup(tables["customer"], tables["nation"], [("c_nationkey", "n_nationkey")], ["n_name"], "inner")
    joined = lookup(accounts, per_user, [("c_custkey", "user_id")], ["n"])
    return joined.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("accounts"), F.sum(F.coalesce("n", F.lit(0))).alias("events")
    )
