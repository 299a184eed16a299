"""The composed reports over inputs derived from the driver tables.

The oracle of a report is written on its own in DuckDB's dialect over the same inputs; reports that
read an earlier report get that report's oracle as a common table expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.domain import AS_OF, INPUTS, SNAPSHOT, Domain, prelude
from checks.registry import Tables, query
from wintide import plans
from wintide.functions import yesterday_in
from wintide.operators import current_rows, product_rollup
from wintide.plans import rules
from wintide.plans.midmarket import charge_totals
from wintide.sources import stage

TODAY = date.fromisoformat(AS_OF)
DAY = date.fromisoformat(SNAPSHOT)
FISCAL_FROM = 1996
HISTORY_FROM = date(1995, 9, 30)
DIMENSION_FROM = date(1997, 5, 3)
TRIAL_FROM = date(2001, 1, 1)


def as_of() -> F.Column:
    return F.lit(TODAY)


def yesterday() -> F.Column:
    noon = F.lit(f"{AS_OF} 20:00:00").cast("timestamp_ntz")
    return yesterday_in("America/Los_Angeles", noon)


# read several times by the reports that start from revenue lines
REVENUE_STORED = ("sold", "win_dates", "lifetimes")
# These read few of the sold lines: cut before the join with their orders, that costs less time than storing all.
MM_STORED = ("lifetimes",)


def domain(t: Tables, stored: Sequence[str] = ()) -> Domain:
    return Domain(t.spark, t.folder, stored)


def case_bands(col: str, steps: list, top: str, default: str, exact: dict) -> str:
    parts = [f"WHEN {col} = {v} THEN '{text}'" for v, text in exact.items()]
    parts += [f"WHEN {col} < {upper} THEN '{text}'" for upper, text in steps]
    return f"CASE {' '.join(parts)} WHEN {col} IS NOT NULL THEN '{top}' ELSE '{default}' END"


def sub_band(col: str) -> str:
    return case_bands(col, rules.SUB_ARR_BANDS, rules.SUB_ARR_TOP, "Unknown", rules.NO_REVENUE)


# ---- small business ----------------------------------------------------------------------------

SMB_FEATURES = (
    """newest_customer AS (
  SELECT crm_account_id, arg_max(crm_business_unit, date_extraction) AS bu, min(sales_model) AS model
  FROM customer_dim WHERE dw_curr_ind = 'Y' AND billing_account_type_clean = 'Customer' GROUP BY 1)""",
    """mixes AS (
  SELECT crm_account_id, mrr_date, CASE WHEN bool_and(product_offering = 'Support Starter') THEN 'Starter-only'
    WHEN bool_or(contains(product_line, 'Suite')) THEN 'Suite' WHEN bool_and(product_line = 'Support') THEN 'Support-only'
    WHEN bool_and(product_line = 'Chat') THEN 'Chat-only' WHEN min(product_line) <> max(product_line) THEN 'Other Multi-Product'
    ELSE 'Other' END AS mix FROM revenue_lines WHERE net_arr_usd > 0 GROUP BY ALL)""",
    """line_plans AS (
  SELECT crm_account_id, mrr_date, product_line, string_agg(DISTINCT g, ',' ORDER BY g) AS plans
  FROM (SELECT *, CASE WHEN product_plan IN ('Essential', 'Starter') THEN 'Support Essential'
      WHEN product_plan = 'Team' THEN 'Support Team' WHEN product_plan = 'Professional' THEN 'Support Professional'
      ELSE 'Support Enterprise' END AS g
    FROM revenue_lines WHERE net_arr_usd > 0 AND product_line = 'Support') GROUP BY ALL)""",
    """seats AS (
  SELECT crm_account_id, mrr_date, CAST(CASE WHEN bool_or(ela) THEN greatest(max(n), 1000) ELSE max(n) END AS BIGINT) AS seats
  FROM (SELECT crm_account_id, mrr_date, product_line, bool_or(enterpriselicense_ind = 'Y') AS ela,
      coalesce(sum(baseplan_quantity) FILTER (WHERE product_line IN ('Support', 'Chat', 'Talk')), 0) AS n
    FROM revenue_lines JOIN product_dim USING (productrateplancharge_id)
    WHERE dw_curr_ind = 'Y' AND net_arr > 0 AND product_offering <> 'Talk Partner' AND NOT contains(product_offering, 'Starter')
    GROUP BY ALL) GROUP BY ALL)""",
    f"""terms AS (
  SELECT crm_account_id, mrr_date, max(term) AS term FROM (
    SELECT crm_account_id, mrr_date, coalesce(currentterm, currentterm_prior_qtr_end) AS term, sum(net_mrr_usd) AS weight
    FROM revenue_lines JOIN calendar ON mrr_date = the_date
    WHERE (last_day_of_qtr_ind = 'Y' OR the_date = DATE '{SNAPSHOT}') AND fiscal_year >= {FISCAL_FROM} GROUP BY 1, 2, 3
    QUALIFY rank() OVER (PARTITION BY crm_account_id, mrr_date ORDER BY weight DESC) = 1) GROUP BY ALL)""",
    """profiles AS (
  SELECT a.id, coalesce(m.market_segment, 'SMB') AS segment,
    CASE WHEN isdeleted = 'False' THEN coalesce(employee_range__c, num_employees__c) END AS size,
    CASE WHEN isdeleted = 'False' THEN coalesce(industry, 'Unknown') END AS industry
  FROM crm_accounts a LEFT JOIN employee_mapping m ON employee_range__c = employee_range WHERE dw_curr_ind = 'Y')""",
)
AT_WIN = f"greatest(win_date, DATE '{HISTORY_FROM}')"
SMB_ACCOUNTS = f"""smb_accounts AS (
  SELECT r.crm_account_id, CASE WHEN st.crm_account_id IS NOT NULL THEN r.crm_account_id END AS startup_account, r.mrr_date,
    r.crm_owner_region_clean AS region, coalesce(bu, 'Unknown') AS business_unit, coalesce(model, 'Unknown') AS sales_model,
    CASE WHEN t.term >= 12 THEN 'Annual' ELSE 'Monthly' END AS term, crm_arr_band_primary, crm_arr_band_secondary,
    {sub_band("r.net_arr_usd")} AS sub_arr_band, coalesce(segment, 'Unknown') AS employee_segment_rollup,
    size AS employee_size_granular, industry, now.mix AS customer_type, seats_now.seats AS paid_agents_today,
    r.net_arr_usd AS net_arr, r.net_arr_usd_prior_qtr_end AS prior_arr, win_date AS account_win_date,
    CAST(floor((DATE '{AS_OF}' - win_date) / 31) + 1 AS BIGINT) AS age_months, CAST(DATE '{AS_OF}' - win_date AS INTEGER) AS age_days,
    won.mix AS customer_type_at_win, won.mix || ' to ' || now.mix AS cust_type_win_to_now,
    coalesce(plans_now.plans, '') AS support_plan_now, coalesce(plans_won.plans, '') AS support_plan_at_win,
    plans_won.plans || ' to ' || plans_now.plans AS support_plan_win_to_now, seats_won.seats AS paid_core_agents_at_win,
    seats_now.seats - seats_won.seats AS agent_diff,
    (seats_now.seats - seats_won.seats) / CASE WHEN seats_won.seats = 0 THEN 1 ELSE seats_won.seats END * 100.0 AS agent_change_pct
  FROM revenue_by_account r JOIN win_dates w USING (crm_account_id)
  LEFT JOIN startups st USING (crm_account_id) LEFT JOIN newest_customer c USING (crm_account_id)
  LEFT JOIN profiles p ON p.id = r.crm_account_id LEFT JOIN terms t USING (crm_account_id, mrr_date)
  LEFT JOIN mixes now USING (crm_account_id, mrr_date) LEFT JOIN line_plans plans_now USING (crm_account_id, mrr_date)
  LEFT JOIN seats seats_now USING (crm_account_id, mrr_date)
  LEFT JOIN mixes won ON won.crm_account_id = r.crm_account_id AND won.mrr_date = {AT_WIN}
  LEFT JOIN line_plans plans_won ON plans_won.crm_account_id = r.crm_account_id AND plans_won.mrr_date = {AT_WIN}
  LEFT JOIN seats seats_won ON seats_won.crm_account_id = r.crm_account_id AND seats_won.mrr_date = {AT_WIN}
  WHERE r.mrr_date = DATE '{SNAPSHOT}' AND r.crm_owner_region_clean IS NOT NULL AND r.net_arr_usd > 0)"""
SMB_AT_WIN = f"""smb_accounts_at_win AS (
  SELECT r.crm_account_id, r.mrr_date, win_date AS account_win_date,
    CASE WHEN r.crm_account_id IN (SELECT crm_account_id FROM smb_accounts) THEN r.crm_account_id END AS active_account,
    CASE WHEN r.crm_account_id NOT IN (SELECT crm_account_id FROM smb_accounts) THEN r.crm_account_id END AS churn_account,
    CASE WHEN CAST(r.crm_account_id AS BIGINT) % 14 = 0 THEN r.crm_account_id END AS startup_account,
    r.crm_owner_region_clean AS region, coalesce(bu, 'Unknown') AS business_unit, coalesce(model, 'Unknown') AS sales_model,
    CASE WHEN t.term >= 12 THEN 'Annual' ELSE 'Monthly' END AS term, coalesce(segment, 'Unknown') AS employee_segment_rollup,
    size AS employee_size_granular, p.industry, coalesce(s.customer_type, 'Churned') AS customer_type_now, m.mix AS customer_type_at_win,
    m.mix || ' to ' || coalesce(s.customer_type, 'Churned') AS cust_type_win_to_now, s.support_plan_now,
    coalesce(s.support_plan_at_win, l.plans, '') AS support_plan_at_win,
    coalesce(s.support_plan_at_win, l.plans, '') || ' to ' || coalesce(s.support_plan_now, 'Churned') AS support_plan_win_to_now,
    fiscal_year AS win_year, month_year AS win_yyyymm, year_quarter AS win_yyyyqq, r.net_arr_usd AS arr_at_win,
    {case_bands("r.net_arr_usd", rules.PRIMARY_ARR_BANDS, rules.PRIMARY_ARR_TOP, "Unknown", rules.NO_REVENUE)} AS primary_arr_band_at_win,
    {sub_band("r.net_arr_usd")} AS sub_arr_band_at_win
  FROM revenue_by_account r JOIN win_dates w ON w.crm_account_id = r.crm_account_id AND r.mrr_date = {AT_WIN}
  JOIN calendar ON the_date = r.mrr_date LEFT JOIN smb_accounts s ON s.crm_account_id = r.crm_account_id
  LEFT JOIN newest_customer c ON c.crm_account_id = r.crm_account_id LEFT JOIN profiles p ON p.id = r.crm_account_id
  LEFT JOIN mixes m ON m.crm_account_id = r.crm_account_id AND m.mrr_date = r.mrr_date
  LEFT JOIN line_plans l ON l.crm_account_id = r.crm_account_id AND l.mrr_date = r.mrr_date
  LEFT JOIN terms t ON t.crm_account_id = r.crm_account_id AND t.mrr_date = r.mrr_date)"""


def smb_domain(t: Tables) -> Domain:
    d = domain(t, REVENUE_STORED)
    d.add(
        "smb_accounts",
        lambda: plans.accounts_today(d, DAY, as_of(), yesterday(), FISCAL_FROM, HISTORY_FROM),
    )
    d.add(
        "smb_accounts_at_win",
        lambda: plans.accounts_at_win(d, yesterday(), FISCAL_FROM, HISTORY_FROM),
    )
    return d


@query(
    prelude(*SMB_FEATURES, SMB_ACCOUNTS)
    + "SELECT * REPLACE (mrr_date::VARCHAR AS mrr_date, account_win_date::VARCHAR AS account_win_date) FROM smb_accounts",
    maybe_null=["paid_agents_today", "paid_core_agents_at_win", "agent_diff"],
)
def smb_accounts_today(t: Tables) -> DataFrame:
    return plans.accounts_today(domain(t, REVENUE_STORED), DAY, as_of(), yesterday(), FISCAL_FROM, HISTORY_FROM)


@query(
    prelude(*SMB_FEATURES, SMB_ACCOUNTS, SMB_AT_WIN)
    + "SELECT * REPLACE (mrr_date::VARCHAR AS mrr_date, account_win_date::VARCHAR AS account_win_date) FROM smb_accounts_at_win"
)
def smb_accounts_at_win(t: Tables) -> DataFrame:
    return plans.accounts_at_win(smb_domain(t), yesterday(), FISCAL_FROM, HISTORY_FROM)


GROUP_SQL = """CASE WHEN type_of_expansion IN ('Agent Adds', 'Temporary Agents') THEN 'agent' WHEN type_of_expansion = 'Plan Shift' THEN 'plan_shift'
    WHEN type_of_expansion IN ('Add Product', 'New Product') THEN 'product' WHEN type_of_expansion = 'New Instance' THEN 'new_instance'
    WHEN type_of_expansion = 'New Contract Term' THEN 'new_contract' END"""
CLOSED_SQL = f"""closed AS (
  SELECT *, {GROUP_SQL} AS kind FROM opportunities
  WHERE stage_name = '07 - Closed' AND contains(type, 'Expansion') AND type_of_expansion <> 'Churn')"""
COUNTS_SQL = ", ".join(
    f"count(*) FILTER (WHERE kind = '{g}') AS {c}" for g, c in rules.EXPANSION_COUNTS.items()
)
SUMS_SQL = ", ".join(
    f"coalesce(sum(total_booking_arr_usd) FILTER (WHERE kind = '{g}'), 0)::DOUBLE AS {g}_exp_arr"
    for g in rules.EXPANSION_GROUPS
)
HISTORY_SQL = f"""histories AS (
  SELECT accountid, arg_min(yyyymm_closed, e) AS first_expansion_yyyymm, arg_min(yyyyqq_closed, e) AS first_expansion_yyyyqq,
    min(close_date) AS first_expansion_date, arg_min(type_of_expansion, e) AS first_expansion_type,
    arg_min(total_booking_arr_usd, e) AS first_expansion_arr, max(close_date) AS last_expansion_date,
    arg_max(type_of_expansion, e) AS last_expansion_type, arg_max(total_booking_arr_usd, e) AS last_expansion_arr,
    count(*) AS num_expansions, string_agg(DISTINCT type_of_expansion, ',' ORDER BY type_of_expansion) AS types_of_exp,
    CASE WHEN bool_and(kind = 'agent') THEN 'Agent Expansion Only' WHEN bool_and(kind = 'plan_shift') THEN 'Plan Shift Only'
      WHEN bool_and(kind = 'product') THEN 'Product Expansion Only' WHEN bool_and(kind = 'new_instance') THEN 'New Instance Only'
      WHEN bool_and(kind = 'new_contract') THEN 'New Contract Only' ELSE 'Multiple Expansions' END AS account_exp_type,
    {COUNTS_SQL}, {SUMS_SQL}, sum(total_booking_arr_usd) AS total_exp_arr
  FROM (SELECT *, (close_date, opportunity_id) AS e FROM closed) GROUP BY 1)"""
HISTORY_DATES = "first_expansion_date::VARCHAR AS first_expansion_date, last_expansion_date::VARCHAR AS last_expansion_date"


@query(
    prelude(*SMB_FEATURES, SMB_ACCOUNTS, SMB_AT_WIN, CLOSED_SQL, HISTORY_SQL)
    + f"""SELECT w.* REPLACE (mrr_date::VARCHAR AS mrr_date, account_win_date::VARCHAR AS account_win_date),
  CASE WHEN listed THEN crm_account_id END AS exp_account,
  CASE WHEN listed THEN CAST(h.first_expansion_date - account_win_date AS INTEGER) END AS days_to_first_expansion,
  CASE WHEN listed THEN CAST(floor((h.first_expansion_date - account_win_date) / 31) + 1 AS BIGINT) END AS months_to_first_expansion,
  h.* EXCLUDE (accountid) REPLACE ({HISTORY_DATES})
FROM (SELECT *, CAST(crm_account_id AS BIGINT) % 2 = 0 AS listed FROM smb_accounts_at_win) l
JOIN smb_accounts_at_win w USING (crm_account_id)
LEFT JOIN histories h ON h.accountid = crm_account_id AND h.first_expansion_date > l.account_win_date""".replace(
        "h.first_expansion_date - account_win_date", "h.first_expansion_date - l.account_win_date"
    ).replace("account_win_date::VARCHAR", "w.account_win_date::VARCHAR").replace(
        "(mrr_date::VARCHAR", "(w.mrr_date::VARCHAR"
    ),
    maybe_null=[
        "days_to_first_expansion", "months_to_first_expansion", "num_expansions",
        "total_agent_expansions", "total_plan_shifts", "total_product_expansions",
        "total_new_instance_expansions", "total_new_contract_expansions",
    ],
)
def smb_account_expansions(t: Tables) -> DataFrame:
    return plans.account_expansions(smb_domain(t))


# ---- mid-market --------------------------------------------------------------------------------

CHURN_CUTOFF = date(2001, 7, 1)
PAID_LINE = "product_line = 'Support'"
MM_FEATURES = (
    """fraud AS (
  SELECT DISTINCT crm_account_id FROM instances_raw i
  JOIN customer_dim c ON split_part(c.instance_ref, '.', 1) = CAST(i.account_id AS VARCHAR)
  JOIN billing_accounts b ON try_cast(b.instance_ref AS DOUBLE) = i.account_id
  WHERE billing_batch = 'Batch13' OR accounttype__c = 'Fraudulent')""",
    """usage AS (
  SELECT crm_account_id, run_at, product_combo,
    CAST(is_activated_support * is_paying_support + coalesce(is_activated_chat * is_paying_chat, 0)
      + coalesce(is_activated_talk * is_paying_talk, 0) + is_activated_guide * is_paying_guide AS INTEGER) AS activated,
    is_engaged_support + is_engaged_chat + is_engaged_talk + is_engaged_guide AS engaged
  FROM engagement JOIN calendar ON run_at = the_date WHERE product_combo <> 'No Paid Products')""",
    f"""line_levels AS (
  SELECT mrr_date, crm_account_id, product_line, bool_or(enterpriselicense_ind = 'Y') AS ela, bool_or(contains(product_offering, 'Premier')) AS premier,
    coalesce(sum(baseplan_quantity) FILTER (WHERE product_line IN ('Support', 'Chat', 'Talk')), 0) AS seats,
    coalesce(sum(baseplan_quantity) FILTER (WHERE {PAID_LINE}), 0) AS support_seats,
    coalesce(max(plan_type) FILTER (WHERE {PAID_LINE}), 0) AS top_level,
    round(sum(plan_type * baseplan_quantity) FILTER (WHERE {PAID_LINE}) / sum(baseplan_quantity) FILTER (WHERE {PAID_LINE})) AS avg_level,
    coalesce(sum(baseplan_quantity) FILTER (WHERE {PAID_LINE} AND contains(product_offering, 'Enterprise')), 0) AS enterprise_seats,
    count(DISTINCT CASE WHEN contains(product_offering, 'Answer') THEN 'Answer Bot' WHEN product_type_derived = 'Addon' THEN 'Add-on'
      ELSE product_line END) AS kinds
  FROM revenue_lines JOIN product_dim USING (productrateplancharge_id)
  LEFT JOIN product_plan_matrix m ON coalesce(base_product_plan, revenue_lines.product_plan) = m.product_plan
  WHERE dw_curr_ind = 'Y' AND net_arr > 0 AND product_offering <> 'Talk Partner' GROUP BY ALL)""",
    """levels AS (
  SELECT mrr_date, crm_account_id, string_agg(product_line, ',' ORDER BY product_line) AS combo,
    CAST(CASE WHEN bool_or(ela) THEN greatest(max(seats), 1000) ELSE max(seats) END AS BIGINT) AS seats,
    CAST(CASE WHEN bool_or(ela) THEN greatest(max(support_seats), 1000) ELSE max(support_seats) END AS BIGINT) AS support_seats,
    CAST(CASE WHEN bool_or(ela OR premier) THEN 5 ELSE max(top_level) END AS INTEGER) AS top_level,
    CAST(CASE WHEN bool_or(ela) THEN greatest(max(enterprise_seats), 1000) ELSE max(enterprise_seats) END AS BIGINT) AS enterprise_seats,
    count(DISTINCT product_line) AS lines, CAST(sum(kinds) AS BIGINT) AS kinds,
    CAST(CASE WHEN bool_or(ela OR premier) THEN 5 ELSE max(avg_level) END AS DOUBLE) AS avg_level
  FROM line_levels GROUP BY ALL)""",
    f"""states AS (
  SELECT a.crm_account_id, a.the_date, w.combo AS combo_w, w.seats AS seats_w, w.support_seats AS support_w, w.top_level AS top_w,
    n.combo, n.seats, n.support_seats, n.top_level
  FROM customer_age a
  LEFT JOIN levels w ON w.crm_account_id = a.crm_account_id AND w.mrr_date = greatest(a.win_date, DATE '{HISTORY_FROM}')
  LEFT JOIN levels n ON n.crm_account_id = a.crm_account_id
    AND n.mrr_date = CASE WHEN churn_date - 1 < the_date THEN churn_date - 1 ELSE the_date END
  WHERE a.the_date = DATE '{SNAPSHOT}')""",
    f"""owners AS (
  SELECT c.crm_account_id, c.mrr_date, employee_range__c, num_employees__c, vp_team__c, dir_team__c
  FROM (SELECT DISTINCT crm_account_id, mrr_date, CAST(greatest(mrr_date, DATE '{DIMENSION_FROM}') + 1 AS TIMESTAMP) AS at_ts FROM cohort) c
  LEFT JOIN crm_accounts a ON a.id = c.crm_account_id AND at_ts BETWEEN a.dw_eff_start AND a.dw_eff_end
  LEFT JOIN crm_users u ON u.id = a.ownerid LEFT JOIN crm_roles r ON r.id = u.userroleid
  LEFT JOIN role_attributes ra ON ra.role_label__c = r.name)""",
)


def agents_sql(col: str) -> str:
    return case_bands(col, rules.AGENT_BANDS, rules.AGENT_TOP, "n/a", rules.AGENT_EXACT)


MM_ACCOUNTS = f"""mm_accounts AS (
  SELECT DISTINCT c.mrr_date, c.crm_account_id, a.win_year_mo, c.age_months, c.industry, c.crm_owner_region_clean, vp_team__c AS region_vp,
    dir_team__c AS subregion_dir, a.win_year_quarter, a.win_year,
    CASE WHEN f.crm_account_id IS NULL THEN 'Not Fraudulent' ELSE 'Fraudulent' END AS fraud_flag, seats_w AS paid_agents_at_win,
    support_w AS paid_support_agents_at_win, {agents_sql("seats_w")} AS agent_band_at_win, top_w AS max_support_plan_at_win,
    combo_w AS product_combo_at_win, sales_model_at_win, term_at_win, product_mix_at_win,
    coalesce(market_segment_at_win, 'SMB') AS market_segment_at_win, crm_arr_band_ops_at_win, crm_arr_sub_band_ops_at_win, net_arr_usd_at_win,
    seats AS paid_agents_today, support_seats AS paid_support_agents_today, {agents_sql("seats")} AS agent_band, top_level AS max_support_plan,
    combo AS product_combo, sales_model, term, product_mix, coalesce(c.market_segment, 'SMB') AS market_segment,
    coalesce(employee_range__c, num_employees__c) AS employee_size, coalesce(employee_range_band, '1 - 99') AS employee_range_band,
    crm_arr_band_ops, crm_arr_sub_band_ops, CASE WHEN engaged >= 1 THEN 'Engaged' WHEN u.run_at IS NOT NULL THEN 'Not Engaged' END AS engaged_flag,
    CASE WHEN u.run_at IS NOT NULL THEN coalesce(engaged, 0) END AS num_engaged_products, activated AS core_products_activated,
    u.product_combo AS core_product_combo, max_plan_change_type, agent_change_type, paid_agents_change_from_win, term_change_from_win,
    product_mix_change_from_win, market_segment_change_from_win, crm_arr_band_ops_change_from_win, crm_arr_sub_band_ops_change_from_win,
    sales_model_change_from_win, CASE WHEN r.arr > 0 THEN 'Customer' ELSE 'Churned' END AS active_status, r.arr AS net_arr_usd,
    a.win_date, net_arr_change_from_win
  FROM cohort c LEFT JOIN fraud f USING (crm_account_id)
  LEFT JOIN (SELECT crm_account_id, sum(net_arr_usd) AS arr FROM revenue_lines WHERE mrr_date = DATE '{SNAPSHOT}' GROUP BY 1) r USING (crm_account_id)
  LEFT JOIN customer_age a ON a.crm_account_id = c.crm_account_id AND a.the_date = c.mrr_date
  LEFT JOIN owners o ON o.crm_account_id = c.crm_account_id AND o.mrr_date = c.mrr_date
  LEFT JOIN employee_mapping m ON o.employee_range__c = m.employee_range
  LEFT JOIN usage u ON u.crm_account_id = c.crm_account_id AND u.run_at = c.mrr_date
  LEFT JOIN states s ON s.crm_account_id = c.crm_account_id AND s.the_date = c.mrr_date
  WHERE day_type = 'max' AND c.crm_owner_region_clean IS NOT NULL)"""
MM_EXPANSIONS = f"""mm_expansions AS (
  SELECT DISTINCT m.crm_account_id, CASE WHEN h.accountid IS NOT NULL THEN m.crm_account_id END AS exp_account,
    CASE WHEN h.accountid IS NOT NULL THEN m.win_date END AS account_win_date,
    win_year_quarter, win_year_mo, win_year, active_status, crm_owner_region_clean AS crm_owner_region, agent_band_at_win,
    max_support_plan_at_win, product_combo_at_win, sales_model_at_win, term_at_win, product_mix_at_win, market_segment_at_win,
    market_segment, product_mix_change_from_win, market_segment_change_from_win,
    CAST(first_expansion_date - m.win_date AS INTEGER) AS days_to_first_expansion,
    CAST(floor((first_expansion_date - m.win_date) / 31) + 1 AS BIGINT) AS months_to_first_expansion,
    h.* EXCLUDE (accountid, types_of_exp, account_exp_type)
  FROM mm_accounts m LEFT JOIN histories h ON h.accountid = m.crm_account_id AND first_expansion_date > m.win_date)"""
MM_CHAIN = (*MM_FEATURES, MM_ACCOUNTS, CLOSED_SQL, HISTORY_SQL, MM_EXPANSIONS)



@query(
    prelude(*MM_FEATURES)
    + """SELECT mrr_date::VARCHAR AS mrr_date, crm_account_id, combo AS product_combo, seats AS paid_agents,
  support_seats AS paid_support_agents, top_level AS max_support_plan, lines AS base_product_count, kinds AS all_product_count,
  enterprise_seats AS paid_support_enterprise_agents, avg_level AS avg_support_plan FROM levels"""
)
def revenue_rollup(t: Tables) -> DataFrame:
    """Revenue lines -> product lines -> accounts, over every account and day."""
    d = domain(t)
    lines = charge_totals(d["revenue_lines"])
    out = product_rollup(lines, current_rows(d["product_dim"]), d["product_plan_matrix"])
    return out.withColumn("avg_support_plan", F.col("avg_support_plan").cast("double"))

def mm_domain(t: Tables) -> Domain:
    d = domain(t, MM_STORED)

    def granular(with_win: bool) -> DataFrame:
        return plans.accounts_granular(d, DIMENSION_FROM, HISTORY_FROM, with_win=with_win)

    d.add("mm_accounts", lambda: granular(False))
    d.add("mm_accounts_at_quarter", lambda: granular(True))
    d.add("mm_expansions", lambda: plans.expansions_granular(d))
    d.add("mm_expansions_by_type", lambda: plans.expansions_by_type(d, CHURN_CUTOFF))
    return d


GRANULAR_SQL = (
    prelude(*MM_FEATURES, MM_ACCOUNTS)
    + "SELECT * EXCLUDE (win_date, net_arr_change_from_win) REPLACE (mrr_date::VARCHAR AS mrr_date) FROM mm_accounts"
)


@query(GRANULAR_SQL, maybe_null=[
        "paid_agents_at_win", "paid_support_agents_at_win", "max_support_plan_at_win",
        "paid_agents_today", "paid_support_agents_today", "max_support_plan",
        "num_engaged_products", "core_products_activated",
    ])
def mm_accounts_granular(t: Tables) -> DataFrame:
    return plans.accounts_granular(domain(t, MM_STORED), DIMENSION_FROM, HISTORY_FROM)


@query(GRANULAR_SQL, maybe_null=[
        "paid_agents_at_win", "paid_support_agents_at_win", "max_support_plan_at_win",
        "paid_agents_today", "paid_support_agents_today", "max_support_plan",
        "num_engaged_products", "core_products_activated",
    ])
def mm_accounts_granular_sliced(t: Tables) -> DataFrame:
    """Same report with the dimension look-ups spread over yearly slices."""
    return plans.accounts_granular(domain(t, MM_STORED), DIMENSION_FROM, HISTORY_FROM, slice_months=12)


@query(
    prelude(*MM_CHAIN)
    + f"SELECT * REPLACE (account_win_date::VARCHAR AS account_win_date, {HISTORY_DATES}) FROM mm_expansions",
    maybe_null=[
        "max_support_plan_at_win", "days_to_first_expansion", "months_to_first_expansion",
        "num_expansions", "total_agent_expansions", "total_plan_shifts",
        "total_product_expansions", "total_new_instance_expansions",
        "total_new_contract_expansions",
    ],
)
def mm_expansions_granular(t: Tables) -> DataFrame:
    return plans.expansions_granular(mm_domain(t))


BY_TYPE_GROUP = """CASE WHEN type_of_expansion = 'Agent Adds' THEN 'Agent Add' WHEN type_of_expansion IN ('Add Product', 'New Product') THEN 'Add Product'
    ELSE type_of_expansion END"""
MM_BY_TYPE = f"""mm_by_type AS (
  SELECT DISTINCT m.crm_account_id, CASE WHEN e.accountid IS NOT NULL THEN m.crm_account_id END AS exp_account,
    CASE WHEN churned.crm_account_id IS NOT NULL THEN m.crm_account_id END AS churned_account,
    CASE WHEN m.win_year_quarter = '2018Q3' THEN 'Post-Suite' ELSE 'Pre-Suite' END AS segment, active_status, m.win_date, m.win_year_quarter,
    m.win_year_mo, m.win_year, churned.churn_date, year_quarter AS churn_year_quarter, fiscal_year AS churn_year,
    crm_owner_region_clean AS crm_owner_region, agent_band_at_win, max_support_plan_at_win, product_combo_at_win, sales_model_at_win,
    term_at_win, product_mix_at_win, product_mix, market_segment_at_win, market_segment, employee_size, crm_arr_band_ops_at_win,
    crm_arr_sub_band_ops_at_win, product_mix_change_from_win, market_segment_change_from_win, yyyymm_closed AS first_expansion_yyyymm,
    yyyyqq_closed AS first_expansion_yyyyqq, close_date AS first_expansion_date,
    CAST(floor((close_date - m.win_date) / 31) + 1 AS BIGINT) AS months_to_first_expansion,
    CAST(close_date - m.win_date AS INTEGER) AS days_to_first_expansion, e.grp AS first_expansion_type_grouped,
    e.total_booking_arr_usd AS first_expansion_arr, g.arr AS total_exp_arr_by_type, g.n AS total_exp_by_type,
    net_arr_change_from_win AS arr_change_from_win,
    CAST(floor((CASE WHEN active_status = 'Churned' THEN churned.churn_date ELSE m.mrr_date END - m.win_date) / 31) + 1 AS BIGINT) AS age_months
  FROM mm_accounts m
  LEFT JOIN (SELECT *, {BY_TYPE_GROUP} AS grp FROM closed WHERE type_of_expansion <> 'Temporary Agents'
    QUALIFY row_number() OVER (PARTITION BY accountid, type_of_expansion ORDER BY close_date, opportunity_id) = 1) e
    ON e.accountid = m.crm_account_id AND close_date > m.win_date
  LEFT JOIN (SELECT accountid, {BY_TYPE_GROUP} AS grp, sum(total_booking_arr_usd) AS arr, count(*) AS n FROM closed GROUP BY 1, 2) g
    ON g.accountid = e.accountid AND g.grp = e.grp
  LEFT JOIN (SELECT DISTINCT crm_account_id, churn_date FROM customer_age WHERE churn_date <= DATE '{CHURN_CUTOFF}'
      AND churn_date IN (SELECT the_date FROM calendar)) churned ON churned.crm_account_id = m.crm_account_id
  LEFT JOIN calendar ON the_date = churned.churn_date
  WHERE fraud_flag = 'Not Fraudulent')"""


@query(
    prelude(*MM_CHAIN, MM_BY_TYPE)
    + """SELECT * REPLACE (win_date::VARCHAR AS win_date, churn_date::VARCHAR AS churn_date,
  first_expansion_date::VARCHAR AS first_expansion_date) FROM mm_by_type""",
    maybe_null=[
        "churn_year", "max_support_plan_at_win", "months_to_first_expansion",
        "days_to_first_expansion", "total_exp_by_type", "age_months",
    ],
)
def mm_expansions_by_type(t: Tables) -> DataFrame:
    return plans.expansions_by_type(mm_domain(t), CHURN_CUTOFF)


def _cohort_window(n: int) -> str:
    lower = "" if n == 30 else f"AND o.close_date > account_win_date + {n - 30}"
    test = f"DATE '{AS_OF}' >= account_win_date + {n} AND o.close_date <= account_win_date + {n} {lower}"
    return (
        f"sum(total_booking_arr_usd) FILTER (WHERE {test}) AS exp_arr_{n}d, "
        f"CASE WHEN count(*) FILTER (WHERE {test}) > 0 THEN count(*) FILTER (WHERE {test}) END AS exp_{n}d"
    )


@query(
    prelude(*MM_CHAIN)
    + f"""SELECT win_year, active_status, crm_owner_region, max_support_plan_at_win, sales_model_at_win, term_at_win,
  product_mix_at_win, market_segment_at_win, market_segment, {", ".join(_cohort_window(n) for n in range(30, 361, 30))}
FROM mm_expansions LEFT JOIN closed o ON o.accountid = crm_account_id WHERE days_to_first_expansion > 0 GROUP BY ALL""",
    maybe_null=[
        "max_support_plan_at_win", "exp_30d", "exp_60d", "exp_90d", "exp_120d",
        "exp_150d", "exp_180d", "exp_210d", "exp_240d", "exp_270d", "exp_300d",
        "exp_330d", "exp_360d",
    ],
)
def mm_expansion_windows(t: Tables) -> DataFrame:
    return plans.expansion_windows(mm_domain(t), as_of())


@query(
    prelude(*MM_CHAIN, MM_BY_TYPE)
    + f"""SELECT DISTINCT q.crm_account_id, q.win_date::VARCHAR AS win_date, account_id, CASE plan_name WHEN 'Support Essential' THEN 'Essential'
  WHEN 'Team' THEN 'Team' WHEN 'Plus' THEN 'Professional' WHEN 'Enterprise Elite' THEN 'Enterprise' ELSE 'Other' END AS support_plan_grouped,
  derived_account_type, {", ".join(f"(q.win_date + INTERVAL {n} MONTH)::DATE::VARCHAR AS post_{n}mo" for n in range(1, 13))}
FROM mm_by_type q JOIN instances i ON i.sfdc_crm_id = q.crm_account_id
WHERE derived_account_type = 'Customer' AND q.win_date >= DATE '1996-01-01' AND age_months >= 12
  AND (q.win_date + INTERVAL 12 MONTH)::DATE <= DATE '{AS_OF}' - 1"""
)
def mm_instance_months(t: Tables) -> DataFrame:
    return plans.instance_months(mm_domain(t), as_of(), date(1996, 1, 1))


WON_SQL = """won AS (
  SELECT *, CASE WHEN employee_range_at_signup_rollup = '100+' THEN '100+' ELSE '1 - 99' END AS size FROM leads
  WHERE type = 'New Business' AND opportunity_stage_name = '07 - Closed' AND yyyyqq_created <> '2019Q3' AND derived_source_granular <> 'Partner')"""


@query(
    prelude(WON_SQL)
    + """SELECT id AS lead_id, mql, converted_accountid AS crm_account_id, converted_opportunityid AS opp_id,
  created_date::DATE::VARCHAR AS lead_created_date, yyyymm_created AS lead_created_month, yyyyqq_created AS lead_created_quarter,
  mql_date::DATE::VARCHAR AS mql_date, opportunity_created_date::DATE::VARCHAR AS opp_created_date,
  opportunity_close_date::DATE::VARCHAR AS opp_close_date, size AS employee_range_at_signup,
  CASE WHEN derived_source_granular IN ('Support Trial', 'Suite Trial') THEN 'Support/Suite Trial'
    WHEN derived_source_granular = 'Contact Us' THEN 'Contact Us/Demo Request' ELSE derived_source_granular END AS derived_source_grouped,
  derived_source_granular, CASE WHEN mql = 1 THEN 'MQL' END AS mql_flag, lead_region, total_booking_arr_usd AS bookings,
  CAST(opportunity_close_date::DATE - created_date::DATE AS INTEGER) AS lead_to_win_days,
  CAST(opportunity_close_date::DATE - mql_date::DATE AS INTEGER) AS mql_to_win_days,
  CAST(opportunity_close_date::DATE - opportunity_created_date::DATE AS INTEGER) AS opp_to_win_days,
  CAST(opportunity_created_date::DATE - mql_date::DATE AS INTEGER) AS mql_to_opp_days FROM won""",
    maybe_null=["mql", "mql_to_win_days", "mql_to_opp_days"],
)
def mm_won_leads(t: Tables) -> DataFrame:
    return plans.won_leads(domain(t))


@query(
    prelude(*MM_FEATURES, MM_ACCOUNTS, WON_SQL)
    + """SELECT derived_source_granular, size AS employee_range_at_signup, lead_region, yyyyqq_created AS lead_created_quarter,
  active_status, crm_owner_region_clean AS crm_owner_region, agent_band_at_win, max_support_plan_at_win, product_combo_at_win,
  sales_model_at_win, term_at_win, product_mix_at_win, market_segment_at_win, market_segment, crm_arr_band_ops_at_win,
  product_mix_change_from_win, market_segment_change_from_win, count(DISTINCT m.crm_account_id) AS accounts,
  CAST(sum(mql) AS BIGINT) AS mqls, sum(total_booking_arr_usd) AS new_biz_bookings, sum(net_arr_usd_at_win) AS arr_at_win, sum(net_arr_usd) AS arr_today
FROM won JOIN (SELECT DISTINCT crm_account_id, active_status, crm_owner_region_clean, agent_band_at_win, max_support_plan_at_win,
    product_combo_at_win, sales_model_at_win, term_at_win, product_mix_at_win, market_segment_at_win, market_segment, crm_arr_band_ops_at_win,
    product_mix_change_from_win, market_segment_change_from_win, net_arr_usd_at_win, net_arr_usd FROM mm_accounts
  WHERE fraud_flag = 'Not Fraudulent') m ON m.crm_account_id = converted_accountid GROUP BY ALL""",
    maybe_null=["max_support_plan_at_win", "mqls"],
)
def mm_leads_to_accounts(t: Tables) -> DataFrame:
    return plans.leads_to_accounts(mm_domain(t))


# ---- account 360 -------------------------------------------------------------------------------

ELIGIBLE_SQL = f"""eligible AS (
  SELECT DISTINCT account_id, sfdc_crm_id, derived_account_type, latest_run_at, cust_owner_email, owner_id AS agent_owner_id, subdomain, region,
    country, industry_full_name, subdomain AS support_subdomain, region AS support_account_region, country AS support_account_country,
    industry_full_name AS support_account_industry, is_sandbox AS support_account_sandbox, derived_account_type AS support_derived_account_type,
    is_active AS support_active_flag, is_trial AS support_active_trial_flag, trial_expired AS support_trial_expired_flag,
    trial_expires_on AS support_trial_expires_on, created_at AS support_instance_created_date, plan_name AS support_plan_name,
    max_agents AS support_max_agents, employee_count AS support_account_employee_count, help_desk_size AS support_help_desk_size,
    churn_dt AS support_churn_date, is_churned AS support_churned_flag, win_dt AS support_win_date, risk_score AS support_risk_score,
    CASE WHEN is_trial = 1 THEN CAST(trial_expires_on - DATE '{AS_OF}' AS INTEGER) END AS support_days_left_in_trial
  FROM instances WHERE derived_account_type IN ('Trial', 'Customer')
    OR (derived_account_type = 'Trial - expired' AND trial_expires_on >= DATE '{TRIAL_FROM}'))"""
ADMINS_SQL = """admins AS (
  SELECT a.account_id AS admin_account, run_at, CAST(a.account_id AS VARCHAR) || coalesce(agent_email, '') AS unique_identifier, agent_email, agent_id,
    agent_name, CASE WHEN agent_email = cust_owner_email THEN 'Owner' ELSE 'Admin' END AS derived_agent_type, locale AS agent_language,
    a.is_active AS agent_is_active, is_verified AS agent_is_verified, agent_created_at AS agent_created_date
  FROM agents a JOIN eligible e ON e.account_id = a.account_id AND run_at = latest_run_at LEFT JOIN locales USING (locale_id)
  WHERE agent_type = 'Admin' AND a.is_active = 1)"""
FEATURES_SQL = (
    ELIGIBLE_SQL,
    ADMINS_SQL,
    f"staff AS (SELECT * EXCLUDE (run_at) FROM roles WHERE run_at = DATE '{SNAPSHOT}')",
    """bots AS (SELECT account_id, run_at, created_at AS answer_bot_instance_created_date, trial_expires_at AS answer_bot_trial_expires_date,
    days_elapsed AS answer_bot_days_elapsed, estimated_resolutions AS answer_bot_estimated_resolutions, max_resolutions AS answer_bot_max_resolutions,
    product_state AS answer_bot_product_state, resolutions_used AS answer_bot_resolutions_used, boosted_resolutions AS answer_bot_boosted_resolutions,
    boost_expires_at AS answer_bot_boost_expires_at FROM answer_bot)""",
    """explored AS (SELECT account_id, run_at, state AS explore_account_type, plan_name AS explore_plan_name,
    is_initialized AS explore_activation_flag, activated_at AS explore_activation_date FROM explore)""",
    "combo AS (SELECT CAST(try_cast(instance_ref AS DOUBLE) AS BIGINT) AS account_id, * EXCLUDE (instance_ref) FROM combo_metrics)",
    f"""shifts AS (SELECT CAST(instance_ref AS BIGINT) AS account_id, model_plan AS plan_shift_model_plan, probability AS plan_shift_probability,
    1 - probability AS no_plan_shift_probability FROM plan_shift_scores WHERE date_scored = DATE '{SNAPSHOT}')""",
    "stats AS (SELECT account_id, conversations FROM chat_stats QUALIFY rank() OVER (PARTITION BY account_id ORDER BY timestamp DESC) = 1)",
    "old_stats AS (SELECT account_id, conversations FROM chat_stats_legacy QUALIFY rank() OVER (PARTITION BY account_id ORDER BY timestamp DESC) = 1)",
)
OVERVIEW_FIELDS = """e.*, d.* EXCLUDE (admin_account), num_users, num_admins, num_agents, num_light_agents, b.* EXCLUDE (account_id, run_at),
  CASE WHEN x.account_id IS NOT NULL THEN '1' ELSE '0' END AS explore_product_flag, x.* EXCLUDE (account_id, run_at)"""
OVERVIEW_JOINS = """LEFT JOIN staff s ON s.account_id = e.account_id
LEFT JOIN explored x ON x.account_id = e.account_id AND x.run_at = latest_run_at
LEFT JOIN combo c ON c.account_id = e.account_id LEFT JOIN shifts f ON f.account_id = e.account_id"""
ISO_DATES = """support_trial_expires_on::VARCHAR AS support_trial_expires_on, support_churn_date::VARCHAR AS support_churn_date,
  support_win_date::VARCHAR AS support_win_date, run_at::VARCHAR AS run_at, latest_run_at::VARCHAR AS latest_run_at,
  chat_enabled_date::VARCHAR AS chat_enabled_date"""


def plain_instants(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain ones, as DuckDB has them."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


@query(
    prelude(
        *FEATURES_SQL,
        """talks AS (
  SELECT instance_id, any_value(coalesce(s.conversations, o.conversations)) AS chat_conversations_in_last_day FROM instance_lifecycle
  LEFT JOIN stats s ON s.account_id = chat_account_id LEFT JOIN old_stats o ON o.account_id = chat_number
  WHERE coalesce(chat_account_id, chat_number) IS NOT NULL GROUP BY 1)""",
    )
    + f"""SELECT * REPLACE ({ISO_DATES}) FROM (
SELECT {OVERVIEW_FIELDS}, c.* EXCLUDE (account_id), chat_conversations_in_last_day, f.* EXCLUDE (account_id)
FROM eligible e LEFT JOIN admins d ON d.admin_account = e.account_id {OVERVIEW_JOINS}
LEFT JOIN bots b ON b.account_id = e.account_id AND b.run_at = latest_run_at LEFT JOIN talks t ON t.instance_id = e.account_id)""",
    maybe_null=[
        "support_days_left_in_trial", "agent_id", "agent_is_active", "agent_is_verified",
        "num_users", "num_admins", "num_agents", "num_light_agents",
        "answer_bot_days_elapsed", "answer_bot_estimated_resolutions",
        "answer_bot_max_resolutions", "answer_bot_resolutions_used",
        "answer_bot_boosted_resolutions", "explore_activation_flag", "calls_last_30_days",
        "support_agents", "support_tickets", "support_one_touch_tickets",
        "support_custom_ticket_fields", "support_tickets_created_last_14_days",
        "support_tickets_created_last_30_days", "talk_total_agents",
        "chat_conversations_in_last_day",
    ],
)
def account_overview(t: Tables) -> DataFrame:
    return plain_instants(plans.account_overview_report(domain(t), as_of(), TRIAL_FROM, stage))


CHAT_SQL = """chats AS (
  SELECT c.* EXCLUDE (instance_id, chat_account_id, chat_number, phase), c.instance_id, pre, coalesce(n.fb, o.fb) AS fb,
    coalesce(n.tw, o.tw) AS tw, coalesce(n.req, o.req) AS req, coalesce(n.skill, o.skill) AS skill,
    coalesce(n.hours, o.hours) AS hours, coalesce(n.hide, o.hide) AS hide
  FROM (SELECT *, NULL AS phase FROM chat_accounts QUALIFY rank() OVER (PARTITION BY instance_id ORDER BY create_date DESC) = 1) c
  LEFT JOIN (SELECT id, forms_pre_chat_form_required AS pre, offline_form_facebook AS fb, offline_form_twitter AS tw, chat_request_form AS req,
      routing_skill AS skill, operating_hours AS hours, chat_button_hide_when_offline AS hide FROM chat_settings
    WHERE run_at = (SELECT max(run_at) FROM chat_settings)) n ON n.id = c.instance_id
  LEFT JOIN (SELECT id, offline_form_facebook AS fb, offline_form_twitter AS tw, chat_request_form AS req, routing_skill AS skill,
      operating_hours AS hours, chat_button_hide_when_offline AS hide FROM chat_settings JOIN old_stats ON account_id = id
    QUALIFY rank() OVER (PARTITION BY id ORDER BY create_date DESC) = 1) o ON o.id = chat_number
  WHERE chat_account_id IS NOT NULL AND chat_number IS NOT NULL)"""


@query(
    prelude(*FEATURES_SQL, CHAT_SQL)
    + f"""SELECT DISTINCT * REPLACE ({ISO_DATES}, chat_instance_created_date::VARCHAR AS chat_instance_created_date,
  chat_win_date::VARCHAR AS chat_win_date, chat_churn_date::VARCHAR AS chat_churn_date, chat_cancellation_date::VARCHAR AS chat_cancellation_date,
  guide_trial_start_date::VARCHAR AS guide_trial_start_date, guide_trial_end_date::VARCHAR AS guide_trial_end_date,
  guide_win_date::VARCHAR AS guide_win_date, guide_churn_date::VARCHAR AS guide_churn_date, talk_trial_start_date::VARCHAR AS talk_trial_start_date,
  talk_trial_end_date::VARCHAR AS talk_trial_end_date, talk_win_date::VARCHAR AS talk_win_date, talk_churn_date::VARCHAR AS talk_churn_date) FROM (
SELECT {OVERVIEW_FIELDS}, c.* EXCLUDE (account_id, calls_last_30_days, ivr_enabled), f.* EXCLUDE (account_id), a.name AS company,
  a.territory_country__c AS sfdc_account_country, a.region__c AS sfdc_account_region, a.employee_range__c AS sfdc_account_employee_range, cd.sales_model,
  p.score AS support_pql_score, h.instance_id AS chat_id, CASE WHEN h.instance_id = e.account_id THEN '1' ELSE '0' END AS chat_product_flag,
  h.subdomain AS chat_subdomain, h.create_date AS chat_instance_created_date, derived_chat_account_type AS chat_derived_account_type,
  chat_win_dt AS chat_win_date, chat_churn_dt AS chat_churn_date, cancellation_date AS chat_cancellation_date, use_case AS chat_use_case,
  chat_plan_name, chat_status, h.max_agents AS chat_max_agents, enabled_agent_count AS chat_enabled_agent_count,
  enabled_trigger_count AS chat_enabled_triggers, embedded_timestamp AS chat_web_widget_embedded_date,
  CASE WHEN h.instance_id IS NULL THEN NULL WHEN embedded_timestamp IS NULL THEN 'not embedded' ELSE 'embedded' END AS chat_web_widget_embedded_flag,
  pre AS chat_prechat_form_flag, fb AS chat_offline_form_facebook_flag, tw AS chat_offline_form_twitter_flag, req AS chat_request_form_flag,
  skill AS chat_skill_routing_flag, hours AS chat_operating_hours_flag, hide AS chat_offline_form_flag,
  g.account_id AS guide_account_id, CASE WHEN g.account_id = e.account_id THEN '1' ELSE '0' END AS guide_product_flag,
  g.is_trial AS guide_active_trial_flag, g.trial_start_date AS guide_trial_start_date, g.trial_end_date AS guide_trial_end_date,
  g.win_dt AS guide_win_date, g.churn_dt AS guide_churn_date, derived_guide_account_type AS guide_derived_account_type,
  g.plan_name AS guide_plan_name, g.max_agents AS guide_max_agents, num_article_edits_28d AS guide_num_article_edits_28d,
  num_articles AS guide_num_articles, num_articles_added_28d AS guide_num_articles_added_28d, num_hc AS guide_num_hc,
  num_hc_archived AS guide_num_hc_archived, num_hc_embeddables_automatic_answers AS guide_num_hc_embeddables_automatic_answers,
  num_hc_embeddables_web_widget AS guide_num_hc_embeddables_web_widget, num_hc_enabled AS guide_num_hc_enabled,
  num_hc_restricted AS guide_num_hc_restricted, content_cues_activated AS guide_content_cues_activated_flag,
  CASE WHEN k.captures > 0 THEN 1 ELSE 0 END AS guide_knowledge_capture_flag, v.account_id AS talk_account_id,
  CASE WHEN v.account_id = e.account_id THEN '1' ELSE '0' END AS talk_product_flag, v.is_trial AS talk_active_trial_flag,
  derived_trial_start_date AS talk_trial_start_date, v.trial_end_date AS talk_trial_end_date, num_days_in_trial AS talk_num_days_in_trial,
  v.plan_name AS talk_plan_name, derived_voice_account_type AS talk_derived_account_type, v.win_date AS talk_win_date,
  has_voice_subscription AS has_talk_subscription, v.is_active AS talk_is_active, v.churn_date AS talk_churn_date,
  v.is_active AS talk_active_flag, plan_name_at_win AS talk_plan_name_at_win, churn_probability, health_score AS churn_health_score,
  r.model_plan AS churn_model_plan
FROM eligible e JOIN admins d ON d.admin_account = e.account_id {OVERVIEW_JOINS} LEFT JOIN bots b ON b.account_id = e.account_id
LEFT JOIN crm_accounts a ON a.id = sfdc_crm_id AND a.dw_curr_ind = 'Y' LEFT JOIN customer_dim cd ON cd.crm_account_id = a.id
LEFT JOIN product_scores p ON p.account_id = e.account_id LEFT JOIN chats h ON h.instance_id = e.account_id
LEFT JOIN guide g ON g.account_id = e.account_id LEFT JOIN voice v ON v.account_id = e.account_id AND v.run_at = latest_run_at
LEFT JOIN (SELECT account_id, run_at, max(total_events_28) AS captures FROM knowledge_capture GROUP BY ALL) k
  ON k.account_id = e.account_id AND k.run_at = latest_run_at
LEFT JOIN churn_scores r ON r.crm_account_id = sfdc_crm_id)""",
    maybe_null=[
        "support_days_left_in_trial", "num_users", "num_admins", "num_agents",
        "num_light_agents", "answer_bot_days_elapsed", "answer_bot_estimated_resolutions",
        "answer_bot_max_resolutions", "answer_bot_resolutions_used",
        "answer_bot_boosted_resolutions", "explore_activation_flag", "support_agents",
        "support_tickets", "support_one_touch_tickets", "support_custom_ticket_fields",
        "support_tickets_created_last_14_days", "support_tickets_created_last_30_days",
        "talk_total_agents", "chat_id", "chat_max_agents", "chat_enabled_agent_count",
        "chat_enabled_triggers", "guide_account_id", "guide_active_trial_flag",
        "guide_max_agents", "guide_num_article_edits_28d", "guide_num_articles",
        "guide_num_articles_added_28d", "guide_num_hc", "guide_num_hc_archived",
        "guide_num_hc_embeddables_automatic_answers",
        "guide_num_hc_embeddables_web_widget", "guide_num_hc_enabled",
        "guide_num_hc_restricted", "guide_content_cues_activated_flag", "talk_account_id",
        "talk_active_trial_flag", "talk_num_days_in_trial", "has_talk_subscription",
        "talk_is_active", "talk_active_flag",
    ],
)
def account_360_full(t: Tables) -> DataFrame:
    return plain_instants(plans.account_360_report(domain(t), as_of(), TRIAL_FROM))


# ---- target lists ------------------------------------------------------------------------------

# Smaller than the published quotas, so that driver regions are really cut; one is larger than any region.
REGION_QUOTAS = {"AMER": 40, "EMEA": 25, "APAC": 10, "LATAM": 4_000_000_000_000_000_000}
OWNED_SQL = """owned AS (
  SELECT a.id, a.name AS company, employee_range__c, success_owner__c, u.id AS owner_id, u.name AS owner, u.email AS owner_email, r.name AS owner_role
  FROM crm_accounts a JOIN crm_users u ON u.id = ownerid JOIN crm_roles r ON r.id = userroleid
  WHERE a.dw_curr_ind = 'Y' AND isdeleted = 'False')"""


@query(
    prelude(
        OWNED_SQL,
        "open_scores AS (SELECT * FROM cross_sell_scores WHERE contains(subregion_dir, 'Velocity') AND product_mix_at_cross_sell <> 'Suite')",
        "cuts AS ("
        + " UNION ALL ".join(
            f"SELECT '{r}' AS region_vp, (SELECT gb_rank FROM open_scores WHERE region_vp = '{r}' ORDER BY gb_rank LIMIT 1 OFFSET {n - 1}) AS cut"
            for r, n in REGION_QUOTAS.items()
        )
        + ")",
    )
    + """SELECT DISTINCT s.crm_account_id, region_vp, subregion_dir, owner AS sfdc_account_owner, owner_role AS sfdc_account_owner_role,
  owner_email AS sfdc_account_owner_email, agent_name, agent_type, agent_email, c.id AS sfdc_contact_id
FROM open_scores s JOIN cuts USING (region_vp) LEFT JOIN owned o ON o.id = s.crm_account_id
JOIN crm_contacts c ON c.accountid = s.crm_account_id AND c.isdeleted = 'False'
JOIN agents a ON a.agent_email = c.email AND a.is_active = 1 AND a.agent_type = 'Admin' WHERE gb_rank <= cut"""
)
def cross_sell_target_list(t: Tables) -> DataFrame:
    return plans.cross_sell_targets(domain(t), REGION_QUOTAS)


@query(
    prelude(
        OWNED_SQL,
        f"""plan_lines AS (
  SELECT crm_account_id, account_id, product_line, string_agg(DISTINCT product_offering, ',' ORDER BY product_offering) AS offerings,
    sum(baseplan_quantity) AS seats, max(CASE WHEN product_line = 'Suite' THEN plan_type ELSE 0 END) AS suite,
    max(CASE WHEN product_line = 'Guide' THEN plan_type ELSE 0 END) AS guide
  FROM revenue_lines l JOIN product_dim USING (productrateplancharge_id)
  LEFT JOIN product_plan_matrix m ON coalesce(base_product_plan, l.product_plan) = m.product_plan
  WHERE mrr_date = DATE '{SNAPSHOT}' AND dw_curr_ind = 'Y' AND net_arr_usd > 0 GROUP BY ALL)""",
        """bought AS (
  SELECT crm_account_id, string_agg(DISTINCT offerings, ',' ORDER BY offerings) AS product_plan, CAST(max(seats) AS BIGINT) AS paid_agents,
    max(suite) AS suite, max(guide) AS guide FROM plan_lines GROUP BY 1)""",
        f"""revenue AS (
  SELECT crm_account_id, account_id AS billing_id, crm_owner_region_clean, CASE WHEN max(currentterm) > 1 THEN 'Annual+' ELSE 'Monthly' END AS term,
    CASE WHEN bool_and(product_offering = 'Support Starter') THEN 'Starter-Only' WHEN bool_and(product_line = 'Support') THEN 'Support-Only'
      WHEN bool_and(product_line = 'Chat') THEN 'Chat-Only' WHEN bool_or(product_line = 'Suite') THEN 'Suite'
      WHEN min(product_line) <> max(product_line) THEN 'Other Multi-Product' ELSE 'Other' END AS product_mix, sum(net_arr_usd) AS arr
  FROM revenue_lines WHERE mrr_date = DATE '{SNAPSHOT}' AND net_arr > 0 GROUP BY ALL)""",
        """social AS (
  SELECT DISTINCT crm_account_id FROM (SELECT * FROM revenue_lines WHERE contains(product_offering, 'Social')
    QUALIFY rank() OVER (PARTITION BY crm_account_id ORDER BY mrr_date DESC) = 1) WHERE net_arr_usd > 0)""",
        f"""channels AS (
  SELECT account_id, sum(new_channel_facebook_msg) AS fb, sum(new_channel_twitter) AS tw FROM tickets
  WHERE run_at >= DATE '{AS_OF}' - INTERVAL 12 MONTH GROUP BY 1)""",
        """pages_used AS (
  SELECT DISTINCT account_id, num_facebook_pages, num_twitter_handles FROM instance_settings
  QUALIFY rank() OVER (PARTITION BY account_id ORDER BY run_at DESC) = 1)""",
    )
    + f"""SELECT DISTINCT v.crm_account_id, r.billing_id, CAST(i.account_id AS VARCHAR) AS instance_id, i.account_id, i.subdomain, company,
  v.win_year_mo, v.win_date::VARCHAR AS win_date, suite_date::VARCHAR AS suite_win_date, strftime(suite_date, '%Y-%m') AS suite_win_year_mo,
  age_months AS account_tenure_months, {case_bands("age_years", rules.AGE_BANDS, rules.AGE_TOP, "Unknown", {})} AS age_range_band,
  cd.sales_model, r.term, r.product_mix,
  CASE WHEN owner_role = 'AMERICA' THEN 'Field' WHEN employee_range__c = '100 - 499' THEN 'By size' ELSE 'SMB' END AS market_segment,
  r.crm_owner_region_clean AS crm_owner_region, cd.billing_country, cd.billing_currency,
  {case_bands("r.arr", rules.OPS_ARR_BANDS, rules.OPS_ARR_TOP, "n/a", rules.NO_REVENUE)} AS crm_arr_band_ops,
  {case_bands("r.arr", rules.OPS_PRIMARY_BANDS, rules.OPS_PRIMARY_TOP, "n/a", rules.NO_REVENUE)} AS crm_arr_band_primary,
  o.owner_id AS sfdc_account_owner_id, owner AS sfdc_account_owner, owner_role AS sfdc_account_owner_role, owner_email AS sfdc_account_owner_email,
  su.firstname || su.lastname AS success_owner, su.email AS success_owner_email, product_plan,
  CASE suite WHEN 4 THEN 'Suite Enterprise' WHEN 3 THEN 'Suite Professional' ELSE 'N/A' END AS max_suite_plan,
  CASE guide WHEN 4 THEN 'Guide Enterprise' WHEN 3 THEN 'Guide Professional' ELSE 'N/A' END AS max_guide_plan, b.paid_agents, derived_account_type,
  CASE WHEN agent_email = cust_owner_email THEN 'Owner' ELSE 'Admin' END AS agent_type, split_part(agent_name, ' ', 1) AS first_name,
  CASE WHEN contains(agent_name, ' ') THEN substr(agent_name, position(' ' IN agent_name) + 1) ELSE agent_name END AS last_name,
  agent_name AS agent_full_name, agent_id, agent_email, lo.name AS language, CASE WHEN fb > 0 THEN 1 ELSE 0 END AS facebook_usage_account_flag,
  CASE WHEN tw > 0 THEN 1 ELSE 0 END AS twitter_usage_account_flag, num_twitter_handles, num_facebook_pages,
  bt.billtocontact_id AS rev_ops_billto_contactid, workemail AS revops_bill_to_email, CASE WHEN so.crm_account_id IS NULL THEN 0 ELSE 1 END AS social_sku
FROM customer_age_view v JOIN revenue r USING (crm_account_id) JOIN customer_dim cd ON cd.billing_account_id = r.billing_id
LEFT JOIN owned o ON o.id = v.crm_account_id LEFT JOIN crm_users su ON su.id = success_owner__c
LEFT JOIN bought b ON b.crm_account_id = v.crm_account_id
JOIN instances i ON i.sfdc_crm_id = v.crm_account_id AND i.billing_id IS NOT NULL AND derived_account_type = 'Customer'
JOIN agents a ON a.account_id = i.account_id AND a.run_at = latest_run_at AND a.is_active = 1 AND a.agent_type = 'Admin'
LEFT JOIN locales lo USING (locale_id) LEFT JOIN channels ch ON ch.account_id = i.account_id
LEFT JOIN pages_used pu ON pu.account_id = i.account_id
LEFT JOIN billing_accounts bt ON bt.instance_ref = cd.instance_ref LEFT JOIN billing_contacts bc ON bc.id = bt.billtocontact_id
LEFT JOIN social so ON so.crm_account_id = v.crm_account_id
WHERE contains(product_plan, 'Suite') OR contains(product_plan, 'Guide Professional') OR contains(product_plan, 'Guide Enterprise')
  OR (NOT contains(product_plan, 'Suite') AND so.crm_account_id IS NULL AND (fb > 0 OR tw > 0))"""
)
def product_target_list(t: Tables) -> DataFrame:
    """History starts early here, so that the driver dates lie past it."""
    return plans.product_targets(domain(t, REVENUE_STORED), as_of(), DIMENSION_FROM, HISTORY_FROM)


def prepare(spark: SparkSession, folder: str) -> None:
    """Store every derived input, and the reports that others read, for all later report queries."""
    t = Tables(spark, folder)
    inputs = domain(t)
    for name in INPUTS:
        Domain.prepared[folder, name] = stage(inputs[name], name)
    for chain, names in (
        (smb_domain, ["smb_accounts", "smb_accounts_at_win"]),
        (mm_domain, ["mm_accounts", "mm_accounts_at_quarter", "mm_expansions", "mm_expansions_by_type"]),
    ):
        for name in names:
            # a new domain each time, so that it reads what is stored by now
            Domain.prepared[folder, name] = chain(t)[name]
