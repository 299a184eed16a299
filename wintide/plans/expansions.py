"""Closed expansions: the event set and the per-account history that several reports share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wintide.operators import edge_events, lookup, set_label, typed_metrics
from wintide.plans import rules

EDGE_DETAILS = ["opportunity_id", "yyyyqq_closed", "yyyymm_closed", "type_of_expansion"]


def closed_expansions(opportunities: DataFrame) -> DataFrame:
    return opportunities.filter(
        (F.col("stage_name") == rules.CLOSED_STAGE)
        & F.col("type").like(rules.EXPANSION_TYPE)
        & ~F.col("type_of_expansion").isin(*rules.NOT_EXPANSIONS)
    )


def expansion_history(opportunities: DataFrame, accounts: DataFrame) -> DataFrame:
    """First, last and typed expansions of accounts whose first one lies after their win date.

    ``accounts``: crm_account_id, account_win_date. One pass gives both edges and the set of types,
    one gives all typed counts and sums; both are one row per account before they meet the accounts.
    """
    closed = closed_expansions(opportunities)
    edges = edge_events(
        closed,
        ["accountid"],
        "close_date",
        EDGE_DETAILS,
        "total_booking_arr_usd",
        "arr",
        value_sets={"__types": "type_of_expansion"},
    )
    metrics = typed_metrics(
        closed,
        ["accountid"],
        "opportunity_id",
        "type_of_expansion",
        "total_booking_arr_usd",
        rules.EXPANSION_GROUPS,
        count_name="num_{}_events",
        sum_name="{}_exp_arr",
        total_count="num_expansions",
        total_sum="total_exp_arr",
    )
    history = lookup(edges, metrics, "accountid", how="inner")
    dated = lookup(accounts.distinct(), history, [("crm_account_id", "accountid")], how="inner")
    dated = dated.filter(F.to_date("first.close_date") > F.col("account_win_date"))
    counts = [F.col(f"num_{g}_events").alias(c) for g, c in rules.EXPANSION_COUNTS.items()]
    return dated.select(
        "crm_account_id",
        "account_win_date",
        F.col("first.yyyymm_closed").alias("first_expansion_yyyymm"),
        F.col("first.yyyyqq_closed").alias("first_expansion_yyyyqq"),
        F.to_date("first.close_date").alias("first_expansion_date"),
        F.col("first.type_of_expansion").alias("first_expansion_type"),
        F.coalesce("first.arr", F.lit(0.0)).alias("first_expansion_arr"),
        F.to_date("last.close_date").alias("last_expansion_date"),
        F.col("last.type_of_expansion").alias("last_expansion_type"),
        F.coalesce("last.arr", F.lit(0.0)).alias("last_expansion_arr"),
        "num_expansions",
        F.when(F.size("__types") > 0, F.array_join("__types", ",")).alias("types_of_exp"),
        set_label({"type": F.col("__types")}, rules.ACCOUNT_EXPANSION_RULES, "Other").alias(
            "account_exp_type"
        ),
        *counts,
        *[f"{g}_exp_arr" for g in rules.EXPANSION_GROUPS],
        "total_exp_arr",
    )


EDGE_COLUMNS = [
    "first_expansion_yyyymm",
    "first_expansion_yyyyqq",
    "first_expansion_date",
    "first_expansion_type",
    "first_expansion_arr",
    "last_expansion_date",
    "last_expansion_type",
    "last_expansion_arr",
    "num_expansions",
]
METRIC_COLUMNS = [
    *rules.EXPANSION_COUNTS.values(),
    *[f"{g}_exp_arr" for g in rules.EXPANSION_GROUPS],
    "total_exp_arr",
]
