"""Small-business chain: accounts today -> accounts at win -> expansion history."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.functions import (
    band,
    elapsed_days,
    elapsed_months31,
    group_values,
    license_floor,
    pct_change,
    strict_greatest,
    transition,
)
from wintide.operators import (
    ACCOUNT_FILTER_BITS,
    ACCOUNT_FILTER_WORDS,
    classify_set,
    current_rows,
    dominant_value,
    latest_per_key,
    lookup,
    may_hold,
    membership_flag,
    reporting_dates,
    on_days,
    semi_filter,
    with_calendar,
)
from wintide.plans import rules
from wintide.plans.expansions import EDGE_COLUMNS, METRIC_COLUMNS, expansion_history

Tables = Mapping[str, DataFrame]
ACCOUNT_DAY = ["crm_account_id", "mrr_date"]


def newest_customer(t: Tables) -> DataFrame:
    """Newest billing record per account, without internal and test customers."""
    labels = ["billing_account_type_clean", "crm_business_unit", "crm_owner_region_clean"]
    live = current_rows(t["customer_dim"]).filter(
        ~F.col("billing_account_type_clean").isin(*rules.EXCLUDED_BILLING_TYPES)
        & F.col("crm_account_id").isNotNull()
    )
    grouped = live.groupBy("crm_account_id", "date_extraction", *labels).agg(
        F.min("sales_model").alias("sales_model")
    )
    return latest_per_key(
        grouped, ["crm_account_id"], "date_extraction", tie_breakers=[*labels, "sales_model"]
    ).select("crm_account_id", "crm_business_unit", "sales_model")


# The three feature families below read different columns of the revenue lines. Each first reduces
# the lines to what it needs per account and day (map-side), and only then is joined to days or
# labelled: a day that holds most of the table arrives as one row per product or charge.


def paid_products(lines: DataFrame) -> DataFrame:
    """Distinct paid products per account and day."""
    paid = lines.filter(F.col("crm_account_id").isNotNull() & (F.col("net_arr_usd") > 0))
    return paid.select(*ACCOUNT_DAY, "product_line", "product_offering", "product_plan").distinct()


def seat_charges(lines: DataFrame) -> DataFrame:
    """Paid seats per account, day, product line and charge."""
    offering = F.col("product_offering")
    kept = lines.filter(
        F.col("crm_account_id").isNotNull()
        & ~offering.like("%Talk Partner%")
        & ~offering.like("%Starter%")
        & (F.col("net_arr") > 0)
    )
    return kept.groupBy(*ACCOUNT_DAY, "product_line", "productrateplancharge_id").agg(
        F.sum("baseplan_quantity").alias("seats")
    )


def term_revenue(lines: DataFrame) -> DataFrame:
    """Revenue per account, day and contract term."""
    term = F.coalesce("currentterm", "currentterm_prior_qtr_end").alias("term_months")
    known = lines.filter(F.col("crm_account_id").isNotNull())
    return known.groupBy(*ACCOUNT_DAY, term).agg(F.sum("net_mrr_usd").alias("net_mrr_usd"))


def product_labels(products: DataFrame) -> DataFrame:
    """``customer_type`` and ``support_plans`` per account and day, out of one aggregation.

    ``support_plans`` holds the sorted plan groups of each support line: an account with two such lines
    has two entries, one without any none. Sets hold catalogue values only.
    """
    line, plan = F.col("product_line"), group_values("product_plan", rules.SUPPORT_PLAN_GROUPS, "Other")
    pairs = F.collect_set(F.when(line.like("%Support%"), F.struct(line.alias("line"), plan.alias("plan"))))

    def plans_of(own: Column) -> Column:
        known = F.filter(pairs, lambda p: (p["line"] == own) & p["plan"].isNotNull())
        return F.nullif(F.array_join(F.array_sort(F.transform(known, lambda p: p["plan"])), ","), F.lit(""))

    lines = F.array_distinct(F.transform(pairs, lambda p: p["line"]))
    return classify_set(
        products,
        ACCOUNT_DAY,
        ["product_offering", "product_line"],
        rules.CUSTOMER_TYPE_RULES,
        "Other",
        "customer_type",
        extra=[F.transform(lines, plans_of).alias("support_plans")],
    )


def paid_seats(charges: DataFrame, products: DataFrame) -> DataFrame:
    """Seats per account and day: summed per product line, largest line, licence floor."""
    known = lookup(
        charges,
        current_rows(products),
        "productrateplancharge_id",
        ["enterpriselicense_ind"],
        how="inner",
    )
    seats = F.when(F.col("product_line").isin(*rules.SEAT_LINES), F.col("seats"))
    per_line = known.groupBy(*ACCOUNT_DAY, "product_line").agg(
        F.max(F.col("enterpriselicense_ind") == "Y").alias("ela"), F.sum(seats.otherwise(0)).alias("seats")
    )
    floored = license_floor(F.max("seats"), F.max("ela"))
    return per_line.groupBy(*ACCOUNT_DAY).agg(floored.alias("paid_core_agents"))


def contract_terms(
    revenue: DataFrame, calendar: DataFrame, yesterday: Column, min_fiscal_year: int
) -> DataFrame:
    """Contract term that carries the most revenue, on reporting days."""
    reported = reporting_dates(revenue, calendar, "mrr_date", yesterday, min_fiscal_year)
    return dominant_value(reported, ACCOUNT_DAY, "term_months", "net_mrr_usd", "term_months")


def market_segments(t: Tables) -> DataFrame:
    mapped = lookup(
        current_rows(t["crm_accounts"]).select("id", "employee_range__c"),
        t["employee_mapping"],
        [("employee_range__c", "employee_range")],
        ["employee_range_band", "market_segment"],
    )
    return mapped.select(
        F.col("id").alias("crm_account_id"),
        "employee_range_band",
        F.coalesce("market_segment", F.lit("SMB")).alias("market_segment"),
    ).distinct()


def _described(df: DataFrame, t: Tables) -> DataFrame:
    """Attach customer, segment and CRM attributes by account."""
    out = lookup(df, newest_customer(t), "crm_account_id")
    out = lookup(out, market_segments(t), "crm_account_id", ["market_segment"])
    crm = current_rows(t["crm_accounts"], not_deleted="isdeleted").select(
        "id",
        F.coalesce("employee_range__c", "num_employees__c").alias("employee_size_granular"),
        F.coalesce("industry", F.lit("Unknown")).alias("industry"),
    )
    return lookup(out, crm, [("crm_account_id", "id")])


def _on_win_days(lines: DataFrame, win_days: DataFrame) -> DataFrame:
    return on_days(
        lines, win_days, filter_words=ACCOUNT_FILTER_WORDS, calendar_days=True, filter_key_bits=ACCOUNT_FILTER_BITS
    )


def _or_unknown(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit("Unknown"))


def _term_label() -> Column:
    return F.when(F.col("term_months") >= 12, "Annual").otherwise("Monthly")


def _sub_band(col: str) -> Column:
    return band(col, rules.SUB_ARR_BANDS, rules.SUB_ARR_TOP, "Unknown", rules.NO_REVENUE)


def accounts_today(
    t: Tables,
    snapshot: date,
    as_of: Column,
    yesterday: Column,
    min_fiscal_year: int = 2015,
    history_start: date = rules.REVENUE_START,
) -> DataFrame:
    """Account table of one snapshot day, compared with each account's state at win.

    Today's features read one day of revenue lines; at-win features read the accounts' own win days,
    cut out before they are aggregated. Joins on the same key follow each other, so the account table is shuffled once per key.
    """
    base = t["revenue_by_account"].filter(
        (F.col("mrr_date") == F.lit(snapshot))
        & F.col("crm_owner_region_clean").isNotNull()
        & F.col("crm_account_id").isNotNull()
        & (F.col("net_arr_usd") > 0)
    )
    base = semi_filter(base, t["calendar"], [("mrr_date", "the_date")])
    base = lookup(
        base, t["win_dates"], "crm_account_id", [F.col("win_date").alias("account_win_date")], "inner"
    )
    today = t["revenue_lines"].filter(F.col("mrr_date") == F.lit(snapshot))
    seats_today = t["revenue_lines_snapshot"].filter(F.col("mrr_date") == F.lit(snapshot))
    products = paid_products(today)

    key = F.col("crm_account_id")
    out = _described(base, t)
    out = membership_flag(out, t["startups"], "crm_account_id", "startup_account", key)
    out = lookup(out, product_labels(products), ACCOUNT_DAY)
    seats = paid_seats(seat_charges(seats_today), t["product_dim"])
    out = lookup(out, seats, ACCOUNT_DAY, [F.col("paid_core_agents").alias("paid_agents_today")])
    terms = contract_terms(term_revenue(today), t["calendar"], yesterday, min_fiscal_year)
    out = lookup(out, terms, ACCOUNT_DAY)
    labelled = out.select(
        "support_plans",
        "crm_account_id",
        "startup_account",
        "mrr_date",
        F.col("crm_owner_region_clean").alias("region"),
        _or_unknown("crm_business_unit").alias("business_unit"),
        _or_unknown("sales_model").alias("sales_model"),
        _term_label().alias("term"),
        "crm_arr_band_primary",
        "crm_arr_band_secondary",
        _sub_band("net_arr_usd").alias("sub_arr_band"),
        _or_unknown("market_segment").alias("employee_segment_rollup"),
        "employee_size_granular",
        "industry",
        "customer_type",
        "paid_agents_today",
        F.col("net_arr_usd").alias("net_arr"),
        F.col("net_arr_usd_prior_qtr_end").alias("prior_arr"),
        "account_win_date",
        elapsed_months31(as_of, "account_win_date").alias("age_months"),
        elapsed_days(as_of, "account_win_date").alias("age_days"),
    ).distinct()

    at_win = strict_greatest("account_win_date", F.lit(history_start))
    win_day = strict_greatest("win_date", F.lit(history_start))
    win_days = t["win_dates"].select("crm_account_id", win_day.alias("mrr_date"))
    won_products = paid_products(_on_win_days(t["revenue_lines"], win_days))
    won_seats = seat_charges(_on_win_days(t["revenue_lines_snapshot"], win_days))

    on = ["crm_account_id", ("__at_win", "mrr_date")]
    out = labelled.withColumn("__at_win", at_win)
    won_labels = [F.col("customer_type").alias("customer_type_at_win"), F.col("support_plans").alias("__plans_at_win")]
    out = lookup(out, product_labels(won_products), on, won_labels)
    seats_at_win = paid_seats(won_seats, t["product_dim"])
    out = lookup(out, seats_at_win, on, [F.col("paid_core_agents").alias("paid_core_agents_at_win")])
    out = out.withColumn("__plan_now", F.explode_outer("support_plans"))
    out = out.withColumn("__plan_at_win", F.explode_outer("__plans_at_win"))
    return out.select(
        *labelled.columns[1:],
        "customer_type_at_win",
        transition("customer_type_at_win", "customer_type").alias("cust_type_win_to_now"),
        F.coalesce("__plan_now", F.lit("")).alias("support_plan_now"),
        F.coalesce("__plan_at_win", F.lit("")).alias("support_plan_at_win"),
        transition("__plan_at_win", "__plan_now").alias("support_plan_win_to_now"),
        "paid_core_agents_at_win",
        (F.col("paid_agents_today") - F.col("paid_core_agents_at_win")).alias("agent_diff"),
        pct_change("paid_agents_today", "paid_core_agents_at_win").alias("agent_change_pct"),
    ).distinct()


def accounts_at_win(
    t: Tables,
    yesterday: Column,
    min_fiscal_year: int = 2015,
    history_start: date = rules.REVENUE_START,
) -> DataFrame:
    """Account state on the win day, next to today's (reads ``smb_accounts``, the table above).

    That table has no NULL key, so one join answers both "still a customer" and "no longer one".
    """
    at_win = strict_greatest("account_win_date", F.lit(history_start))
    winners = t["win_dates"].select("crm_account_id", F.col("win_date").alias("account_win_date"))
    won = winners.withColumn("mrr_date", at_win)
    accounts = t["revenue_by_account"].select(*ACCOUNT_DAY, "crm_owner_region_clean", "net_arr_usd")
    # all days of an account are there, one is wanted: cut them before they are shuffled, or summed where they are derived
    accounts = may_hold(accounts, won, ACCOUNT_DAY, ACCOUNT_FILTER_WORDS, ACCOUNT_FILTER_BITS)
    out = lookup(won, accounts, ACCOUNT_DAY, how="inner")
    calendar = [
        F.col("fiscal_year").alias("win_year"),
        F.col("month_year").alias("win_yyyymm"),
        F.col("year_quarter").alias("win_yyyyqq"),
    ]
    out = with_calendar(out, t["calendar"], "mrr_date", calendar)
    lines = _on_win_days(t["revenue_lines"], won.select(*ACCOUNT_DAY))
    products, revenue = paid_products(lines), term_revenue(lines)
    today = t["smb_accounts"].select(
        "crm_account_id",
        F.col("customer_type").alias("__type_now"),
        F.col("support_plan_now"),
        F.col("support_plan_at_win").alias("__stored_plan"),
        F.lit(True).alias("__active"),
    )
    out = lookup(out, today, "crm_account_id")
    out = _described(out, t)
    key = F.col("crm_account_id")
    out = membership_flag(out, t["smb_startups"], "crm_account_id", "startup_account", key)
    out = lookup(out, product_labels(products), ACCOUNT_DAY)
    out = out.withColumn("support_plan", F.explode_outer("support_plans"))
    out = lookup(out, contract_terms(revenue, t["calendar"], yesterday, min_fiscal_year), ACCOUNT_DAY)
    plan_at_win = F.coalesce("__stored_plan", "support_plan", F.lit(""))
    primary = band(
        "net_arr_usd", rules.PRIMARY_ARR_BANDS, rules.PRIMARY_ARR_TOP, "Unknown", rules.NO_REVENUE
    )
    return out.select(
        "crm_account_id",
        "mrr_date",
        "account_win_date",
        F.when(F.col("__active"), key).alias("active_account"),
        F.when(F.col("__active").isNull(), key).alias("churn_account"),
        "startup_account",
        F.col("crm_owner_region_clean").alias("region"),
        _or_unknown("crm_business_unit").alias("business_unit"),
        _or_unknown("sales_model").alias("sales_model"),
        _term_label().alias("term"),
        _or_unknown("market_segment").alias("employee_segment_rollup"),
        "employee_size_granular",
        "industry",
        F.coalesce("__type_now", F.lit("Churned")).alias("customer_type_now"),
        F.col("customer_type").alias("customer_type_at_win"),
        transition("customer_type", "__type_now", "Churned").alias("cust_type_win_to_now"),
        "support_plan_now",
        plan_at_win.alias("support_plan_at_win"),
        transition(plan_at_win, "support_plan_now", "Churned").alias("support_plan_win_to_now"),
        "win_year",
        "win_yyyymm",
        "win_yyyyqq",
        F.col("net_arr_usd").alias("arr_at_win"),
        primary.alias("primary_arr_band_at_win"),
        _sub_band("net_arr_usd").alias("sub_arr_band_at_win"),
    ).distinct()


def account_expansions(t: Tables) -> DataFrame:
    """Every account at win with its expansion history (reads ``smb_accounts_at_win``)."""
    accounts = t["smb_accounts_at_win"]
    history = expansion_history(
        t["opportunities"], accounts.select("crm_account_id", "account_win_date")
    ).withColumnRenamed("account_win_date", "__win")
    out = lookup(accounts, history, "crm_account_id")
    key = F.col("crm_account_id")
    out = membership_flag(out, t["expansion_accounts"], "crm_account_id", "exp_account", key)
    listed = F.col("exp_account").isNotNull()
    days = F.when(listed, elapsed_days("first_expansion_date", "__win"))
    months = F.when(listed, elapsed_months31("first_expansion_date", "__win"))
    return out.select(
        *accounts.columns,
        "exp_account",
        days.alias("days_to_first_expansion"),
        months.alias("months_to_first_expansion"),
        *EDGE_COLUMNS,
        "types_of_exp",
        "account_exp_type",
        *METRIC_COLUMNS,
    ).distinct()
