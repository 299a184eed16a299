"""Mid-market chain: granular accounts -> expansions -> tenure cohorts, and the lead funnel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.functions import (
    band,
    elapsed_days,
    elapsed_months31,
    group_values,
    lifecycle_status,
    normalize_id,
    strict_greatest,
    strict_least,
)
from wintide.operators import (
    ACCOUNT_FILTER_BITS,
    ACCOUNT_FILTER_WORDS,
    as_of_instant,
    cohort_rollup,
    current_rows,
    edge_events,
    engagement_score,
    flagged_accounts,
    funnel_durations,
    funnel_rollup,
    latest_snapshot,
    lookup,
    membership_flag,
    month_offsets,
    owner_chain,
    product_rollup,
    scd2_as_of,
    on_days,
    semi_filter,
    tenure_windows,
    with_calendar,
)
from wintide.plans import rules
from wintide.plans.expansions import (
    EDGE_COLUMNS,
    METRIC_COLUMNS,
    closed_expansions,
    expansion_history,
)

Tables = Mapping[str, DataFrame]


def fraud_accounts(t: Tables) -> DataFrame:
    """Accounts in the fraud billing batch or of the fraud billing type."""
    key = F.col("account_id").cast("string").alias("account_id")
    customers = current_rows(t["customer_dim"]).select(
        normalize_id("instance_ref", "prefix").alias("account_id"), "crm_account_id", "billing_batch"
    )
    billing = current_rows(t["billing_accounts"]).select(
        normalize_id("instance_ref").cast("string").alias("account_id"),
        F.col("accounttype__c").alias("account_type"),
    )
    return flagged_accounts(
        t["instances_raw"].select(key), customers, billing, rules.FRAUD_BATCHES, rules.FRAUD_ACCOUNT_TYPES
    )


def product_usage(t: Tables) -> DataFrame:
    """Engagement metrics of paying accounts on calendar days."""
    paying = t["engagement"].filter(~F.col("product_combo").isin("No Paid Products"))
    dated = semi_filter(paying, t["calendar"], [("run_at", "the_date")])
    scored = engagement_score(dated, rules.ENGAGED_PRODUCTS)
    return scored.select(
        "run_at",
        "crm_account_id",
        F.col("product_combo").alias("core_product_combo"),
        "core_products_activated",
        "num_engaged_products",
        "engaged_flag",
    ).distinct()


def charge_totals(lines: DataFrame) -> DataFrame:
    """Paid lines summed per account, day and charge: all the roll-up needs of them."""
    charge = [
        "mrr_date",
        "crm_account_id",
        "product_line",
        "product_offering",
        "product_plan",
        "base_product_plan",
        "productrateplancharge_id",
    ]
    return lines.filter(F.col("net_arr") > 0).groupBy(*charge).agg(
        F.sum("baseplan_quantity").alias("baseplan_quantity"), F.sum("net_arr").alias("net_arr")
    )


def product_states(t: Tables, history_start: date = rules.REVENUE_START) -> DataFrame:
    """Products, seats and plan level of every account at win and when last active.

    Only the revenue lines of those two days per account are read, summed per charge and rolled up.
    """
    ages = latest_snapshot(t["customer_age"], "the_date").select(
        "crm_account_id", "the_date", "win_date", "churn_date"
    ).distinct()
    at_win = strict_greatest("win_date", F.lit(history_start))
    last_day = F.coalesce(F.date_sub("churn_date", 1), F.lit(rules.OPEN_END))
    last_active = strict_least("the_date", last_day)
    # both days of an account as two rows, so that the roll-up is joined once
    role = F.explode(F.array(*[F.struct(F.lit(n).alias("role"), d.alias("day")) for n, d in (("win", at_win), ("last", last_active))]))
    roles = ages.withColumn("__role", role).withColumn("__day", F.col("__role.day"))
    days = roles.select("crm_account_id", F.col("__day").alias("mrr_date"))
    lines = on_days(
        t["revenue_lines"],
        days,
        filter_words=ACCOUNT_FILTER_WORDS,
        calendar_days=True,
        filter_key_bits=ACCOUNT_FILTER_BITS,
    )
    lines = charge_totals(lines)
    products = product_rollup(lines, current_rows(t["product_dim"]), t["product_plan_matrix"])
    fields = [
        "avg_support_plan",
        "max_support_plan",
        "product_combo",
        "paid_agents",
        "paid_support_agents",
    ]
    out = lookup(roles, products, ["crm_account_id", ("__day", "mrr_date")], fields)
    states = [
        F.max(F.when(F.col("__role.role") == name, F.col(f))).alias(f"{f}{suffix}")
        for name, suffix in (("win", "_at_win"), ("last", ""))
        for f in fields
    ]
    return out.groupBy(*ages.columns).agg(*states).drop("win_date", "churn_date").distinct()


def _agent_band(col: str) -> Column:
    return band(col, rules.AGENT_BANDS, rules.AGENT_TOP, "n/a", rules.AGENT_EXACT)


def accounts_granular(
    t: Tables,
    dimension_start: date = rules.DIMENSION_START,
    history_start: date = rules.REVENUE_START,
    slice_months: int | None = None,
    with_win: bool = False,
) -> DataFrame:
    """One row per cohort account and snapshot: win, today, owner, usage and changes.

    ``with_win`` adds win_date and net_arr_change_from_win, which the expansion-by-type report
    reads. ``slice_months`` switches the dimension look-ups to time slices (long histories).
    """
    cohort = t["cohort"].filter(
        F.col("crm_account_id").isNotNull()
        & F.col("crm_owner_region_clean").isNotNull()
        & (F.col("day_type") == "max")
    )
    arr = (
        latest_snapshot(t["revenue_lines"], "mrr_date")
        .groupBy("crm_account_id")
        .agg(F.sum("net_arr_usd").alias("net_arr_usd"))
    )
    # Joins on the same key follow each other: account, owner chain, then account and day.
    out = lookup(cohort, arr, "crm_account_id")
    out = membership_flag(
        out, fraud_accounts(t), "crm_account_id", "fraud_flag", "Fraudulent", "Not Fraudulent"
    )
    at = as_of_instant("mrr_date", dimension_start)
    out = owner_chain(
        out,
        "crm_account_id",
        t["crm_accounts"],
        t["crm_users"],
        t["crm_roles"],
        at=at,
        account_columns=["employee_range__c", "num_employees__c"],
        role_columns=[F.col("name").alias("__role_name")],
        slice_months=slice_months,
        reach_of=cohort,
    )
    teams = [F.col("vp_team__c").alias("region_vp"), F.col("dir_team__c").alias("subregion_dir")]
    out = scd2_as_of(
        out,
        t["role_attributes"],
        [("__role_name", "role_label__c")],
        at,
        columns=teams,
        slice_months=slice_months,
        reach_of=cohort,
    )
    out = lookup(
        out,
        t["employee_mapping"],
        [("employee_range__c", "employee_range")],
        ["employee_range_band"],
    )
    ages = t["customer_age"].select(
        "crm_account_id", "the_date", "win_date", "win_year_mo", "win_year_quarter", "win_year"
    )
    out = lookup(out, ages, ["crm_account_id", ("mrr_date", "the_date")])
    out = lookup(out, product_usage(t), ["crm_account_id", ("mrr_date", "run_at")])
    states = product_states(t, history_start)
    out = lookup(out, states, ["crm_account_id", ("mrr_date", "the_date")])

    def or_smb(col: str) -> Column:
        return F.coalesce(F.col(col), F.lit("SMB")).alias(col)

    extra = ["win_date", "net_arr_change_from_win"] if with_win else []
    return out.select(
        "mrr_date",
        "crm_account_id",
        "win_year_mo",
        "age_months",
        "industry",
        "crm_owner_region_clean",
        "region_vp",
        "subregion_dir",
        "win_year_quarter",
        "win_year",
        "fraud_flag",
        "paid_agents_at_win",
        "paid_support_agents_at_win",
        _agent_band("paid_agents_at_win").alias("agent_band_at_win"),
        "max_support_plan_at_win",
        "product_combo_at_win",
        "sales_model_at_win",
        "term_at_win",
        "product_mix_at_win",
        or_smb("market_segment_at_win"),
        "crm_arr_band_ops_at_win",
        "crm_arr_sub_band_ops_at_win",
        "net_arr_usd_at_win",
        F.col("paid_agents").alias("paid_agents_today"),
        F.col("paid_support_agents").alias("paid_support_agents_today"),
        _agent_band("paid_agents").alias("agent_band"),
        "max_support_plan",
        "product_combo",
        "sales_model",
        "term",
        "product_mix",
        or_smb("market_segment"),
        F.coalesce("employee_range__c", "num_employees__c").alias("employee_size"),
        F.coalesce("employee_range_band", F.lit("1 - 99")).alias("employee_range_band"),
        "crm_arr_band_ops",
        "crm_arr_sub_band_ops",
        "engaged_flag",
        "num_engaged_products",
        "core_products_activated",
        "core_product_combo",
        "max_plan_change_type",
        "agent_change_type",
        "paid_agents_change_from_win",
        "term_change_from_win",
        "product_mix_change_from_win",
        "market_segment_change_from_win",
        "crm_arr_band_ops_change_from_win",
        "crm_arr_sub_band_ops_change_from_win",
        "sales_model_change_from_win",
        lifecycle_status("net_arr_usd").alias("active_status"),
        "net_arr_usd",
        *extra,
    ).distinct()


def expansions_granular(t: Tables) -> DataFrame:
    """Granular accounts with their expansion history (reads ``mm_accounts``)."""
    ages = t["customer_age"].select("crm_account_id", F.col("win_date").alias("account_win_date"))
    ages = semi_filter(ages, t["mm_accounts"], "crm_account_id")
    history = expansion_history(t["opportunities"], ages)
    hit = F.lit(True).alias("__expanded")
    wanted = [c for c in history.columns if c != "crm_account_id"]
    out = lookup(t["mm_accounts"], history, "crm_account_id", [*wanted, hit])
    return out.select(
        "crm_account_id",
        F.when(F.col("__expanded"), F.col("crm_account_id")).alias("exp_account"),
        "account_win_date",
        "win_year_quarter",
        "win_year_mo",
        "win_year",
        "active_status",
        F.col("crm_owner_region_clean").alias("crm_owner_region"),
        "agent_band_at_win",
        "max_support_plan_at_win",
        "product_combo_at_win",
        "sales_model_at_win",
        "term_at_win",
        "product_mix_at_win",
        "market_segment_at_win",
        "market_segment",
        "product_mix_change_from_win",
        "market_segment_change_from_win",
        elapsed_days("first_expansion_date", "account_win_date").alias("days_to_first_expansion"),
        elapsed_months31("first_expansion_date", "account_win_date").alias(
            "months_to_first_expansion"
        ),
        *EDGE_COLUMNS,
        *METRIC_COLUMNS,
    ).distinct()


def expansions_by_type(t: Tables, churn_cutoff: date) -> DataFrame:
    """First expansion of each type per account, with churn (reads ``mm_accounts_at_quarter``).

    First is ranked by the raw type and grouped afterwards, so two raw types of one group give two
    rows.
    """
    accounts = t["mm_accounts_at_quarter"]
    types = [v for _, values in rules.FIRST_EXPANSION_TYPES for v in values]
    closed = closed_expansions(t["opportunities"]).filter(F.col("type_of_expansion").isin(*types))
    group = group_values("type_of_expansion", rules.FIRST_EXPANSION_TYPES)
    details = ["opportunity_id", "yyyyqq_closed", "yyyymm_closed"]
    first = edge_events(
        closed,
        ["accountid", "type_of_expansion"],
        "close_date",
        details,
        "total_booking_arr_usd",
        "arr",
        which=["first"],
    ).withColumn("type_group", group)
    per_opportunity = closed.groupBy("accountid", group.alias("type_group"), "opportunity_id").agg(
        F.sum("total_booking_arr_usd").alias("arr")
    )
    totals = per_opportunity.groupBy("accountid", "type_group").agg(
        F.sum("arr").alias("total_exp_arr_by_type"),
        F.count("opportunity_id").alias("total_exp_by_type"),
    )
    typed = lookup(first, totals, ["accountid", "type_group"])
    winners = accounts.select("crm_account_id", "win_date").distinct()
    typed = lookup(winners, typed, [("crm_account_id", "accountid")], how="inner")
    expansions = typed.filter(F.to_date("first.close_date") > F.col("win_date")).select(
        "crm_account_id",
        F.col("first.yyyymm_closed").alias("first_expansion_yyyymm"),
        F.col("first.yyyyqq_closed").alias("first_expansion_yyyyqq"),
        F.to_date("first.close_date").alias("first_expansion_date"),
        elapsed_months31("first.close_date", "win_date").alias("months_to_first_expansion"),
        elapsed_days("first.close_date", "win_date").alias("days_to_first_expansion"),
        F.col("type_group").alias("first_expansion_type_grouped"),
        F.coalesce("first.arr", F.lit(0.0)).alias("first_expansion_arr"),
        F.coalesce("total_exp_arr_by_type", F.lit(0.0)).alias("total_exp_arr_by_type"),
        F.coalesce("total_exp_by_type", F.lit(0)).alias("total_exp_by_type"),
        F.lit(True).alias("__expanded"),
    ).distinct()

    gone = t["customer_age"].select("crm_account_id", "churn_date").filter(
        F.col("churn_date") <= F.lit(churn_cutoff)
    )
    quarter = [
        F.col("year_quarter").alias("churn_year_quarter"),
        F.col("fiscal_year").alias("churn_year"),
    ]
    churned = with_calendar(gone.distinct(), t["calendar"], "churn_date", quarter)

    out = accounts.filter(F.col("fraud_flag") == "Not Fraudulent")
    out = lookup(out, expansions, "crm_account_id")
    churn_hit = F.lit(True).alias("__churned")
    churn_columns = ["churn_date", "churn_year_quarter", "churn_year", churn_hit]
    out = lookup(out, churned, "crm_account_id", churn_columns)
    key = F.col("crm_account_id")
    era = F.col("win_year_quarter").isin(*rules.SUITE_ERA)
    end = F.when(F.col("active_status") == "Churned", F.col("churn_date")).otherwise(F.col("mrr_date"))
    return (
        out.select(
            "crm_account_id",
            F.when(F.col("__expanded"), key).alias("exp_account"),
            F.when(F.col("__churned"), key).alias("churned_account"),
            F.when(era, "Post-Suite").otherwise("Pre-Suite").alias("segment"),
            "active_status",
            "win_date",
            "win_year_quarter",
            "win_year_mo",
            "win_year",
            "churn_date",
            "churn_year_quarter",
            "churn_year",
            F.col("crm_owner_region_clean").alias("crm_owner_region"),
            "agent_band_at_win",
            "max_support_plan_at_win",
            "product_combo_at_win",
            "sales_model_at_win",
            "term_at_win",
            "product_mix_at_win",
            "product_mix",
            "market_segment_at_win",
            "market_segment",
            "employee_size",
            "crm_arr_band_ops_at_win",
            "crm_arr_sub_band_ops_at_win",
            "product_mix_change_from_win",
            "market_segment_change_from_win",
            "first_expansion_yyyymm",
            "first_expansion_yyyyqq",
            "first_expansion_date",
            "months_to_first_expansion",
            "days_to_first_expansion",
            "first_expansion_type_grouped",
            "first_expansion_arr",
            "total_exp_arr_by_type",
            "total_exp_by_type",
            F.col("net_arr_change_from_win").alias("arr_change_from_win"),
            elapsed_months31(end, "win_date").alias("age_months"),
        )
        .distinct()
        .orderBy("crm_account_id")
    )


EXPANSION_COHORT = [
    "win_year",
    "active_status",
    "crm_owner_region",
    "max_support_plan_at_win",
    "sales_model_at_win",
    "term_at_win",
    "product_mix_at_win",
    "market_segment_at_win",
    "market_segment",
]


def expansion_windows(
    t: Tables, as_of: Column, step: int = 30, computed: int = 15, returned: int = 12
) -> DataFrame:
    """Expansion amount and volume per 30-day tenure window and cohort (reads ``mm_expansions``)."""
    expanded = t["mm_expansions"].filter(F.col("days_to_first_expansion") > 0)
    accounts = expanded.select("crm_account_id", "account_win_date", *EXPANSION_COHORT)
    events = (
        closed_expansions(t["opportunities"])
        .groupBy(
            F.col("accountid").alias("crm_account_id"),
            "opportunity_id",
            F.to_date("close_date").alias("close_date"),
            "type_of_expansion",
        )
        .agg(F.sum("total_booking_arr_usd").alias("arr"))
    )
    windows = tenure_windows(
        accounts,
        events,
        "crm_account_id",
        "account_win_date",
        "close_date",
        "arr",
        as_of,
        step,
        computed,
    )
    days = [step * n for n in range(1, returned + 1)]
    measures = [f"exp_arr_{n}d" for n in days] + [f"exp_{n}d" for n in days]
    return cohort_rollup(windows, EXPANSION_COHORT, measures)


def instance_months(
    t: Tables, as_of: Column, won_from: date = date(2016, 1, 1), min_age_months: int = 12
) -> DataFrame:
    """Month marks after win for each customer instance of a mature account.

    Reads ``mm_expansions_by_type``, which has several rows per account; accounts are made distinct
    first, so each instance comes out once.
    """
    accounts = t["mm_expansions_by_type"]
    mature = accounts.filter(
        (F.col("win_date") >= F.lit(won_from)) & (F.col("age_months") >= min_age_months)
    ).select("crm_account_id", "win_date")
    marked = month_offsets(mature.distinct(), "win_date", 12, as_of)
    customers = t["instances"].filter(F.col("derived_account_type").like("%Customer%")).select(
        F.col("sfdc_crm_id").alias("crm_account_id"),
        "account_id",
        group_values("plan_name", rules.INSTANCE_PLAN_GROUPS, "Other").alias("support_plan_grouped"),
        "derived_account_type",
    )
    out = lookup(customers.distinct(), marked, "crm_account_id", how="inner")
    months = [f"post_{n}mo" for n in range(1, 13)]
    return out.select(
        "crm_account_id", "win_date", "account_id", "support_plan_grouped", "derived_account_type", *months
    )


def won_leads(
    t: Tables,
    quarters: Sequence[str] = tuple(rules.FUNNEL_QUARTERS),
    sources: Sequence[str] = tuple(rules.FUNNEL_SOURCES),
) -> DataFrame:
    """Leads that became new business: stage durations, source group and bookings."""
    won = t["leads"].filter(
        F.col("type").like("%New%")
        & (F.col("opportunity_stage_name") == rules.CLOSED_STAGE)
        & F.col("yyyyqq_created").isin(*quarters)
        & F.col("derived_source_granular").isin(*sources)
    )
    spans = {
        "lead_to_win_days": ("opp_close_date", "lead_created_date"),
        "mql_to_win_days": ("opp_close_date", "mql_date"),
        "opp_to_win_days": ("opp_close_date", "opp_created_date"),
        "mql_to_opp_days": ("opp_created_date", "mql_date"),
    }
    size = F.col("employee_range_at_signup_rollup")
    leads = won.select(
        F.col("id").alias("lead_id"),
        "mql",
        F.col("converted_accountid").alias("crm_account_id"),
        F.col("converted_opportunityid").alias("opp_id"),
        F.to_date("created_date").alias("lead_created_date"),
        F.col("yyyymm_created").alias("lead_created_month"),
        F.col("yyyyqq_created").alias("lead_created_quarter"),
        F.to_date("mql_date").alias("mql_date"),
        F.to_date("opportunity_created_date").alias("opp_created_date"),
        F.to_date("opportunity_close_date").alias("opp_close_date"),
        F.when(size.isin("1 - 99", "Unknown"), "1 - 99").otherwise(size).alias("employee_range_at_signup"),
        group_values("derived_source_granular", rules.SOURCE_GROUPS, "Partner/Outbound/Other").alias(
            "derived_source_grouped"
        ),
        "derived_source_granular",
        F.when(F.col("mql") == 1, "MQL").alias("mql_flag"),
        "lead_region",
        "total_booking_arr_usd",
    )
    keys = [c for c in leads.columns if c != "total_booking_arr_usd"]
    bookings = leads.groupBy(*keys).agg(F.sum("total_booking_arr_usd").alias("bookings"))
    return funnel_durations(bookings, spans)


FUNNEL_LEAD_DIMS = [
    "derived_source_granular",
    "employee_range_at_signup",
    "lead_region",
    "lead_created_quarter",
]
FUNNEL_ACCOUNT_DIMS = [
    "active_status",
    "crm_owner_region_clean",
    "agent_band_at_win",
    "max_support_plan_at_win",
    "product_combo_at_win",
    "sales_model_at_win",
    "term_at_win",
    "product_mix_at_win",
    "market_segment_at_win",
    "market_segment",
    "crm_arr_band_ops_at_win",
    "product_mix_change_from_win",
    "market_segment_change_from_win",
]


def leads_to_accounts(
    t: Tables,
    quarters: Sequence[str] = tuple(rules.FUNNEL_QUARTERS),
    sources: Sequence[str] = tuple(rules.FUNNEL_SOURCES),
) -> DataFrame:
    """Won leads rolled up with their accounts per cohort (reads ``mm_accounts``)."""
    honest = t["mm_accounts"].filter(F.col("fraud_flag") == "Not Fraudulent")
    return funnel_rollup(
        won_leads(t, quarters, sources),
        honest,
        "crm_account_id",
        FUNNEL_LEAD_DIMS,
        FUNNEL_ACCOUNT_DIMS,
        {"mqls": "mql", "new_biz_bookings": "bookings"},
        {"arr_at_win": "net_arr_usd_at_win", "arr_today": "net_arr_usd"},
        account_identity=["max_plan_change_type"],
    ).withColumnRenamed("crm_owner_region_clean", "crm_owner_region")
