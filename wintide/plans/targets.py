"""Target lists: ranked cross-sell accounts and product accounts with their admins."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.functions import (
    band,
    distinct_list,
    normalize_id,
    role_label,
    split_name,
)
from wintide.operators import (
    as_of_instant,
    current_rows,
    is_member,
    latest_per_key,
    latest_snapshot,
    lookup,
    owner_chain,
    quota_cut,
    scd2_as_of,
    set_label,
    snapshot_join,
    trailing_sum,
)
from wintide.plans import rules

Tables = Mapping[str, DataFrame]


def cross_sell_targets(
    t: Tables, quotas: Mapping[str, int] | None = None, short: str = "none"
) -> DataFrame:
    """Best-ranked non-suite accounts per region with owner, admin agents and CRM contact."""
    scores = t["cross_sell_scores"].filter(
        F.col("subregion_dir").like("%Velocity%") & ~F.col("product_mix_at_cross_sell").isin("Suite")
    )
    kept = quota_cut(
        scores,
        "region_vp",
        "gb_rank",
        quotas or rules.CROSS_SELL_QUOTAS,
        ["crm_account_id", "subregion_dir"],
        short,
    )
    owned = owner_chain(
        kept.select("crm_account_id", "region_vp", "subregion_dir").distinct(),
        "crm_account_id",
        t["crm_accounts"],
        t["crm_users"],
        t["crm_roles"],
        user_columns=[
            F.col("name").alias("sfdc_account_owner"),
            F.col("email").alias("sfdc_account_owner_email"),
        ],
        role_columns=[F.col("name").alias("sfdc_account_owner_role")],
    )
    contacts = current_rows(t["crm_contacts"], not_deleted="isdeleted").select(
        "accountid", "email", F.col("id").alias("sfdc_contact_id")
    )
    admins = (
        t["agents"]
        .filter((F.col("is_active") == 1) & (F.col("agent_type") == "Admin"))
        .select("agent_name", "agent_type", "agent_email")
        .distinct()
    )
    out = lookup(owned, contacts, [("crm_account_id", "accountid")], how="inner")
    out = lookup(
        out,
        admins.withColumn("__email", F.col("agent_email")),
        [("email", "__email")],
        how="inner",
    )
    return out.select(
        "crm_account_id",
        "region_vp",
        "subregion_dir",
        "sfdc_account_owner",
        "sfdc_account_owner_role",
        "sfdc_account_owner_email",
        "agent_name",
        "agent_type",
        "agent_email",
        "sfdc_contact_id",
    ).distinct()


def paid_plans(t: Tables, dimension_start: date = rules.DIMENSION_START) -> DataFrame:
    """Paid products, plan levels and seats per billing account and instance, newest snapshot.

    Lines are summed per charge before the dimension joins, so that a billing account with very
    many lines brings one row per charge.
    """
    lines = latest_snapshot(t["revenue_lines"], "mrr_date").filter(
        F.col("crm_account_id").isNotNull() & (F.col("net_arr_usd") > 0)
    )
    charge = ["product_line", "product_offering", "productrateplancharge_id"]
    plan = F.coalesce("base_product_plan", "product_plan").alias("__plan")
    paid = F.when(F.col("net_arr") > 0, F.col("baseplan_quantity")).otherwise(0)
    lines = lines.groupBy("mrr_date", "crm_account_id", "account_id", *charge, plan).agg(
        F.sum(paid).alias("seats")
    )
    at = as_of_instant("mrr_date", dimension_start)
    out = scd2_as_of(
        lines, t["customer_dim"], [("account_id", "billing_account_id")], at, columns=["instance_ref"]
    )
    out = lookup(
        out, current_rows(t["product_dim"]), "productrateplancharge_id", columns=[], how="inner"
    )
    out = lookup(out, t["product_plan_matrix"], [("__plan", "product_plan")], ["plan_type"])
    line = F.col("product_line")

    def level(name: str) -> Column:
        return F.max(F.when(line == name, F.col("plan_type")).otherwise(0))

    keys = ["mrr_date", "crm_account_id", "account_id", "instance_ref"]
    per_line = out.groupBy(*keys, "product_line").agg(
        distinct_list("product_offering").alias("offerings"),
        level("Suite").alias("suite"),
        level("Guide").alias("guide"),
        F.sum("seats").alias("seats"),
    )
    instance = normalize_id("instance_ref", "prefix").alias("instance_id")
    return per_line.groupBy("mrr_date", "crm_account_id", "account_id", instance).agg(
        distinct_list("product_line").alias("product_mix"),
        distinct_list("offerings").alias("product_plan"),
        F.max("seats").alias("paid_agents"),
        F.max("suite").alias("max_suite_plan"),
        F.max("guide").alias("max_guide_plan"),
    )


def billing_profiles(t: Tables, on_day: Column) -> DataFrame:
    """Revenue, mix and bands per account, billing account and region on one day."""
    lines = t["revenue_lines"].filter(
        (F.col("mrr_date") == on_day)
        & F.col("crm_account_id").isNotNull()
        & (F.col("net_arr") > 0)
    )
    sets = {i: F.collect_set(i) for i in ("product_offering", "product_line")}
    total = F.sum("net_arr_usd")
    return lines.groupBy("mrr_date", "crm_account_id", "account_id", "crm_owner_region_clean").agg(
        F.when(F.max("currentterm") > 1, "Annual+").otherwise("Monthly").alias("term"),
        set_label(sets, rules.PRODUCT_MIX_RULES, "Other").alias("product_mix"),
        band(total, rules.OPS_ARR_BANDS, rules.OPS_ARR_TOP, "n/a", rules.NO_REVENUE).alias(
            "crm_arr_band_ops"
        ),
        band(total, rules.OPS_PRIMARY_BANDS, rules.OPS_PRIMARY_TOP, "n/a", rules.NO_REVENUE).alias(
            "crm_arr_band_primary"
        ),
        F.coalesce(total, F.lit(0.0)).alias("net_arr_usd"),
    )


def account_profiles(t: Tables, history_start: date = rules.REVENUE_START) -> DataFrame:
    """Tenure, revenue profile, segment and owner of each account on the newest day."""
    newest = t["customer_age_view"].agg(F.max("the_date")).scalar()
    ages = latest_snapshot(t["customer_age_view"], "the_date").filter(
        F.col("the_date") >= F.lit(history_start)
    )
    profiles = billing_profiles(t, newest).withColumnRenamed("account_id", "billing_id")
    out = lookup(ages, profiles, ["crm_account_id", ("the_date", "mrr_date")], how="inner")
    customers = (
        current_rows(t["customer_dim"])
        .groupBy("billing_account_id", "instance_ref")
        .agg(F.min("sales_model").alias("sales_model"))
    )
    out = lookup(out, customers, [("billing_id", "billing_account_id")])
    out = owner_chain(
        out,
        "crm_account_id",
        t["crm_accounts"],
        t["crm_users"],
        t["crm_roles"],
        account_columns=[
            F.col("name").alias("company"),
            "employee_range__c",
            F.col("success_owner__c").alias("__success"),
        ],
        user_columns=[
            F.col("id").alias("sfdc_account_owner_id"),
            F.col("name").alias("sfdc_account_owner"),
            F.col("email").alias("sfdc_account_owner_email"),
        ],
        role_columns=[F.col("name").alias("sfdc_account_owner_role")],
    )
    out = lookup(
        out,
        t["role_regions"],
        [("sfdc_account_owner_role", "userrole")],
        [F.col("market_segment").alias("__role_segment")],
    )
    out = lookup(
        out,
        t["range_segments"],
        [("employee_range__c", "range")],
        [F.col("market_segment").alias("__range_segment")],
    )
    success = current_rows(t["crm_users"]).select(
        "id",
        F.concat("firstname", "lastname").alias("success_owner"),
        F.col("email").alias("success_owner_email"),
    )
    return lookup(out, success, [("__success", "id")])


def bill_contacts(t: Tables) -> DataFrame:
    accounts = current_rows(t["billing_accounts"]).select("instance_ref", "billtocontact_id")
    contacts = t["billing_contacts"].select("id", "workemail")
    out = lookup(accounts, contacts, [("billtocontact_id", "id")])
    return out.withColumn("instance_id", normalize_id("instance_ref", "prefix")).select(
        "instance_id", "billtocontact_id", "workemail"
    ).distinct()


def social_accounts(t: Tables) -> DataFrame:
    """Accounts one of whose newest social lines still carries revenue."""
    social = t["revenue_lines"].filter(F.lower("product_offering").like("%social%"))
    paid = F.col("net_arr_usd") > 0
    newest = social.groupBy("crm_account_id").agg(
        F.max("mrr_date").alias("newest"), F.max(F.when(paid, F.col("mrr_date"))).alias("newest_paid"), F.count_if(paid).alias("paid")
    )
    undated = F.col("newest").isNull() & (F.col("paid") > 0)
    return newest.filter((F.col("newest") == F.col("newest_paid")) | undated).select("crm_account_id")


def _plan_label(col: str, product: str) -> Column:
    level = F.col(col)
    return (
        F.when(level == 4, f"{product} Enterprise")
        .when(level == 3, f"{product} Professional")
        .otherwise("N/A")
    )


def product_targets(
    t: Tables,
    as_of: Column,
    dimension_start: date = rules.DIMENSION_START,
    history_start: date = rules.REVENUE_START,
) -> DataFrame:
    """Suite, guide and social-channel customers with every active admin of their instances.

    All account features are joined and the product filter applied per account before the admins
    are attached.
    """
    out = account_profiles(t, history_start).withColumn("instance_id", normalize_id("instance_ref", "prefix"))
    plans = paid_plans(t, dimension_start).select(
        "crm_account_id",
        "instance_id",
        "product_plan",
        "paid_agents",
        "max_suite_plan",
        "max_guide_plan",
    )
    out = lookup(out, plans, ["crm_account_id", "instance_id"])
    instances = t["instances"].filter(
        F.col("billing_id").isNotNull() & (F.col("derived_account_type") == "Customer")
    ).select(
        "sfdc_crm_id",
        F.col("account_id").cast("string").alias("__instance"),
        "account_id",
        "subdomain",
        "latest_run_at",
        "derived_account_type",
        "cust_owner_email",
    )
    out = lookup(
        out, instances, [("crm_account_id", "sfdc_crm_id"), ("instance_id", "__instance")], how="inner"
    )
    billing = current_rows(t["customer_dim"]).select(
        "instance_ref", "billing_country", "billing_currency"
    )
    out = lookup(out, billing.distinct(), "instance_ref")
    channels = {
        "__facebook": F.col("new_channel_facebook_msg") + F.col("new_channel_facebook_post"),
        "__twitter": F.col("new_channel_twitter")
        + F.col("new_channel_twitter_dm")
        + F.col("new_channel_twitter_fave"),
    }
    out = lookup(out, trailing_sum(t["tickets"], "account_id", "run_at", channels, as_of), "account_id")
    settings = latest_per_key(t["instance_settings"], ["account_id"], "run_at", ties="all")
    out = lookup(out, settings, "account_id", ["num_facebook_pages", "num_twitter_handles"])
    out = lookup(out, bill_contacts(t), "instance_id")
    out = is_member(out, social_accounts(t), "crm_account_id", "__social")

    plan = F.col("product_plan")
    uses = (F.col("__facebook") > 0) | (F.col("__twitter") > 0)
    suite = plan.like("%Suite%")
    guide = plan.like("%Guide Professional%") | plan.like("%Guide Enterprise%")
    wanted = out.filter(suite | guide | (~suite & ~F.col("__social") & uses))
    admins = t["agents"].filter((F.col("is_active") == 1) & (F.col("agent_type") == "Admin"))
    admins = lookup(admins, t["locales"], "locale_id", [F.col("name").alias("language")])
    admins = admins.select("account_id", "run_at", "agent_id", "agent_name", "agent_email", "language")
    wanted = snapshot_join(
        wanted, admins.distinct(), "account_id", "latest_run_at", "run_at", how="inner"
    )
    first, last = split_name("agent_name")
    years = band("age_years", rules.AGE_BANDS, rules.AGE_TOP, "Unknown")
    segment = F.coalesce("__role_segment", "__range_segment", F.lit("SMB"))
    return wanted.select(
        "crm_account_id",
        "billing_id",
        "instance_id",
        "account_id",
        "subdomain",
        "company",
        "win_year_mo",
        "win_date",
        F.col("suite_date").alias("suite_win_date"),
        F.substring(F.col("suite_date").cast("string"), 1, 7).alias("suite_win_year_mo"),
        F.col("age_months").alias("account_tenure_months"),
        years.alias("age_range_band"),
        "sales_model",
        "term",
        "product_mix",
        segment.alias("market_segment"),
        F.col("crm_owner_region_clean").alias("crm_owner_region"),
        "billing_country",
        "billing_currency",
        "crm_arr_band_ops",
        "crm_arr_band_primary",
        "sfdc_account_owner_id",
        "sfdc_account_owner",
        "sfdc_account_owner_role",
        "sfdc_account_owner_email",
        "success_owner",
        "success_owner_email",
        "product_plan",
        _plan_label("max_suite_plan", "Suite").alias("max_suite_plan"),
        _plan_label("max_guide_plan", "Guide").alias("max_guide_plan"),
        "paid_agents",
        "derived_account_type",
        role_label("cust_owner_email", "agent_email").alias("agent_type"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.col("agent_name").alias("agent_full_name"),
        "agent_id",
        "agent_email",
        "language",
        F.when(F.col("__facebook") > 0, 1).otherwise(0).alias("facebook_usage_account_flag"),
        F.when(F.col("__twitter") > 0, 1).otherwise(0).alias("twitter_usage_account_flag"),
        "num_twitter_handles",
        "num_facebook_pages",
        F.col("billtocontact_id").alias("rev_ops_billto_contactid"),
        F.col("workemail").alias("revops_bill_to_email"),
        F.when(F.col("__social"), 1).otherwise(0).alias("social_sku"),
    ).distinct()
