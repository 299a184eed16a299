"""Report inputs derived from the driver tables.

Each input is one SELECT in SQL that Spark and DuckDB both read, so both sides start from equal
rows whose number grows with the driver tables. Names in braces are driver tables or earlier
inputs. Moduli give every input its NULLs, misses, ties and dirty ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from wintide.sources import stage
from wintide.sources.tables import staging_folder

DRIVER = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
AS_OF = "2001-10-01"
SNAPSHOT = "2001-09-30"
EARLIER = "2001-06-30"


def quarter_end(day: str) -> str:
    return f"last_day(make_date(year({day}), quarter({day}) * 3, 1))"


def year_quarter(day: str) -> str:
    return f"(CAST(year({day}) AS STRING) || 'Q' || CAST(quarter({day}) AS STRING))"


def year_month(day: str) -> str:
    return f"substr(CAST(CAST({day} AS DATE) AS STRING), 1, 7)"


def whole(column: str) -> str:
    return f"CAST({column} AS STRING)"


REGION = (
    "CASE {0} % 5 WHEN 0 THEN 'AMER' WHEN 1 THEN 'EMEA' WHEN 2 THEN 'APAC' WHEN 3 THEN 'LATAM' END"
)
SIZE = "CASE c_custkey % 4 WHEN 0 THEN '1 - 99' WHEN 1 THEN '100 - 499' WHEN 2 THEN '500+' END"
PLAN = (
    "CASE p_size % 5 WHEN 0 THEN 'Essential' WHEN 1 THEN 'Team' WHEN 2 THEN 'Professional'"
    " WHEN 3 THEN 'Enterprise' ELSE 'Starter' END"
)
ALWAYS = (
    "'Y' AS dw_curr_ind, CAST('1990-01-01' AS TIMESTAMP) AS dw_eff_start,"
    " CAST('9999-12-31' AS TIMESTAMP) AS dw_eff_end"
)
# Day of an account's latest run, by key.
RUN = (
    f"CASE {{0}} % 3 WHEN 0 THEN DATE '{SNAPSHOT}' WHEN 1 THEN DATE '2001-09-29'"
    " ELSE DATE '2001-09-28' END"
)

INPUTS: dict[str, str] = {
    "win_dates": f"""
        SELECT {whole("o_custkey")} AS crm_account_id, {quarter_end("min(o_orderdate)")} AS win_date
        FROM {{orders}} GROUP BY o_custkey""",
    "sold": f"""
        SELECT o_custkey, o_orderdate, l_linenumber, l_quantity, l_returnflag, l_tax, p_partkey, p_brand,
          CASE WHEN o_custkey % 3 = 0 THEN 'Support' WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'Support'
            WHEN p_type = 'SMALL' THEN 'Chat' WHEN p_type = 'MEDIUM' THEN 'Talk' WHEN p_type = 'LARGE' THEN 'Guide'
            ELSE 'Suite' END AS line,
          CASE WHEN o_custkey % 9 = 0 THEN 'Starter' ELSE {PLAN} END AS plan
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey""",
    "revenue_lines": f"""
        SELECT {quarter_end("o_orderdate")} AS mrr_date, {whole("o_custkey")} AS crm_account_id,
          'B' || {whole("o_custkey")} AS account_id, line AS product_line,
          CASE p_brand WHEN 'Brand#7' THEN line || ' Answer Bot' WHEN 'Brand#8' THEN line || ' Social'
            WHEN 'Brand#9' THEN 'Talk Partner' WHEN 'Brand#10' THEN line || ' Premier'
            ELSE line || ' ' || plan END AS product_offering,
          plan AS product_plan, CASE WHEN p_partkey % 2 = 0 THEN plan END AS base_product_plan,
          {whole("p_partkey")} AS productrateplancharge_id, CAST(l_quantity AS BIGINT) AS baseplan_quantity,
          CASE WHEN l_returnflag = 'R' THEN 0.0E0 ELSE l_quantity * 100 END AS net_arr,
          CASE WHEN l_returnflag = 'R' THEN 0.0E0 ELSE l_quantity * 100 END AS net_arr_usd,
          l_quantity AS net_mrr_usd, CASE WHEN l_tax > 0.04 THEN 'USD' ELSE 'EUR' END AS currency,
          CASE l_linenumber % 3 WHEN 0 THEN 12 WHEN 1 THEN 1 END AS currentterm,
          24 AS currentterm_prior_qtr_end, {REGION.format("o_custkey")} AS crm_owner_region_clean
        FROM {{sold}}""",
    "revenue_lines_snapshot": """
        SELECT mrr_date, crm_account_id, product_line, product_offering, productrateplancharge_id,
          baseplan_quantity, net_arr FROM {revenue_lines}""",
    "revenue_by_account": """
        SELECT crm_account_id, mrr_date, max(crm_owner_region_clean) AS crm_owner_region_clean,
          CASE WHEN sum(net_arr_usd) < 10000 THEN 'small' ELSE 'large' END AS crm_arr_band_primary,
          CASE WHEN sum(net_arr_usd) < 5000 THEN 'tiny' ELSE 'other' END AS crm_arr_band_secondary,
          sum(net_arr_usd) AS net_arr_usd, sum(net_arr_usd) - 100 AS net_arr_usd_prior_qtr_end
        FROM {revenue_lines} GROUP BY crm_account_id, mrr_date""",
    "calendar": f"""
        SELECT the_date, CAST(year(the_date) AS INT) AS fiscal_year, {year_month("the_date")} AS month_year,
          {year_quarter("the_date")} AS year_quarter,
          CASE WHEN the_date = {quarter_end("the_date")} THEN 'Y' ELSE 'N' END AS last_day_of_qtr_ind
        FROM (SELECT CAST(o_orderdate AS DATE) AS the_date FROM {{orders}}
              UNION SELECT {quarter_end("o_orderdate")} FROM {{orders}}
              UNION SELECT CAST({quarter_end("o_orderdate")} + INTERVAL '1' DAY AS DATE) FROM {{orders}}) days""",
    "product_dim": f"""
        SELECT {whole("p_partkey")} AS productrateplancharge_id,
          CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'Addon' ELSE 'Base' END AS product_type_derived,
          CASE WHEN p_size = 50 THEN 'Y' ELSE 'N' END AS enterpriselicense_ind,
          CASE WHEN p_partkey % 50 = 7 THEN 'N' ELSE 'Y' END AS dw_curr_ind FROM {{part}}""",
    "product_plan_matrix": f"""
        SELECT DISTINCT {PLAN} AS product_plan,
          CASE p_size % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE 1 END AS plan_type
        FROM {{part}}""",
    "customer_dim": f"""
        SELECT {whole("c_custkey")} AS crm_account_id, 'B' || {whole("c_custkey")} AS billing_account_id,
          {whole("c_custkey")} || '.0' AS instance_ref,
          CASE WHEN c_custkey % 17 = 0 THEN 'Test' ELSE 'Customer' END AS billing_account_type_clean,
          CASE WHEN c_custkey % 11 > 0 THEN c_mktsegment END AS crm_business_unit,
          {REGION.format("c_custkey")} AS crm_owner_region_clean,
          CASE WHEN c_acctbal > 5000 THEN 'Assisted' WHEN c_acctbal >= 0 THEN 'Self-service' END AS sales_model,
          DATE '{SNAPSHOT}' AS date_extraction,
          CASE WHEN c_custkey % 19 = 0 THEN 'Batch13' ELSE 'Batch1' END AS billing_batch,
          'C' || {whole("c_nationkey")} AS billing_country,
          CASE WHEN c_custkey % 2 = 0 THEN 'USD' ELSE 'EUR' END AS billing_currency, {ALWAYS}
        FROM {{customer}}""",
    "crm_accounts": f"""
        SELECT {whole("c_custkey")} AS id, c_name AS name, 'U' || {whole("(c_nationkey + v) % 25")} AS ownerid,
          'U' || {whole("(c_nationkey + 3) % 25")} AS success_owner__c, {SIZE} AS employee_range__c,
          {whole("c_custkey % 1000")} AS num_employees__c,
          CASE WHEN c_custkey % 6 > 0 THEN c_mktsegment END AS industry,
          'T' || {whole("c_nationkey")} AS territory_country__c, 'R' || {whole("c_nationkey % 5")} AS region__c,
          CASE WHEN c_custkey % 23 = 0 THEN 'True' ELSE 'False' END AS isdeleted,
          CASE WHEN v = 0 THEN 'Y' ELSE 'N' END AS dw_curr_ind,
          CASE WHEN v = 0 THEN CAST('2001-07-01' AS TIMESTAMP) ELSE CAST('1990-01-01' AS TIMESTAMP) END AS dw_eff_start,
          CASE WHEN v = 0 THEN CAST('9999-12-31' AS TIMESTAMP) ELSE CAST('2001-07-01' AS TIMESTAMP) END AS dw_eff_end
        FROM (SELECT *, 0 AS v FROM {{customer}} UNION ALL SELECT *, 1 AS v FROM {{customer}}) versions""",
    "crm_users": f"""
        SELECT 'U' || {whole("n_nationkey")} AS id, n_name AS name, lower(n_name) || '@crm' AS email,
          'First' AS firstname, n_name AS lastname, 'R' || {whole("n_regionkey")} AS userroleid, {ALWAYS}
        FROM {{nation}}""",
    "crm_roles": f"SELECT 'R' || {whole('r_regionkey')} AS id, r_name AS name, {ALWAYS} FROM {{region}}",
    "role_attributes": f"""
        SELECT r_name AS role_label__c, 'VP ' || r_name AS vp_team__c, 'Dir ' || r_name AS dir_team__c, {ALWAYS}
        FROM {{region}} WHERE r_name <> 'ASIA'""",
    "employee_mapping": f"""
        SELECT DISTINCT {SIZE} AS employee_range,
          CASE c_custkey % 4 WHEN 0 THEN '1 - 99' ELSE '100+' END AS employee_range_band,
          CASE c_custkey % 4 WHEN 0 THEN 'SMB' ELSE 'Mid-Market' END AS market_segment
        FROM {{customer}} WHERE c_custkey % 4 < 2""",
    "role_regions": "SELECT r_name AS userrole, r_name AS region, 'Field' AS market_segment FROM {region} WHERE r_regionkey = 1",
    "range_segments": f"SELECT DISTINCT {SIZE} AS range, 'By size' AS market_segment FROM {{customer}} WHERE c_custkey % 4 = 1",
    "opportunities": f"""
        SELECT {whole("o_custkey")} AS accountid, {whole("o_orderkey")} AS opportunity_id,
          CAST(o_orderdate AS DATE) AS close_date, {year_quarter("o_orderdate")} AS yyyyqq_closed,
          {year_month("o_orderdate")} AS yyyymm_closed,
          CASE WHEN o_orderstatus = 'P' THEN 'New Business' ELSE 'Customer Expansion' END AS type,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Agent Adds' WHEN '2-HIGH' THEN 'Plan Shift'
            WHEN '3-MEDIUM' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Add Product' ELSE 'New Product' END
            WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'New Instance' ELSE 'Temporary Agents' END
            ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'Churn' ELSE 'New Contract Term' END END AS type_of_expansion,
          CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN '01 - Open' ELSE '07 - Closed' END AS stage_name,
          CAST(floor(o_totalprice) AS DOUBLE) AS total_booking_arr_usd
        FROM {{orders}}""",
    "leads": f"""
        SELECT 'L' || {whole("event_id")} AS id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 END AS mql,
          {whole("user_id")} AS converted_accountid, 'O' || {whole("event_id")} AS converted_opportunityid,
          ts AS created_date, {year_month("ts")} AS yyyymm_created,
          CASE event_id % 5 WHEN 0 THEN '2018Q3' WHEN 1 THEN '2018Q4' WHEN 2 THEN '2019Q1' WHEN 3 THEN '2019Q2'
            ELSE '2019Q3' END AS yyyyqq_created,
          CASE WHEN event_type = 'click' THEN ts + INTERVAL '1' DAY END AS mql_date,
          ts + INTERVAL '3' DAY AS opportunity_created_date, ts + INTERVAL '10' DAY AS opportunity_close_date,
          CASE event_id % 3 WHEN 0 THEN '1 - 99' WHEN 1 THEN 'Unknown' ELSE '100+' END AS employee_range_at_signup_rollup,
          CASE event_type WHEN 'signup' THEN 'Support Trial' WHEN 'view' THEN 'Suite Trial' WHEN 'click' THEN 'Contact Us'
            WHEN 'purchase' THEN 'Chat Trial' ELSE 'Partner' END AS derived_source_granular,
          {REGION.format("user_id")} AS lead_region,
          CASE WHEN event_id % 6 = 0 THEN 'Expansion' ELSE 'New Business' END AS type,
          CASE WHEN event_id % 7 = 0 THEN '01 - Open' ELSE '07 - Closed' END AS opportunity_stage_name,
          CAST(floor(value * 100) AS DOUBLE) AS total_booking_arr_usd
        FROM {{events}}""",
    "lifetimes": f"""
        SELECT o_custkey, {quarter_end("min(o_orderdate)")} AS win_date, {quarter_end("max(o_orderdate)")} AS last_quarter
        FROM {{orders}} GROUP BY o_custkey""",
    "customer_age": f"""
        SELECT {whole("o_custkey")} AS crm_account_id, the_date, win_date,
          CASE WHEN o_custkey % 4 = 0 THEN CAST(last_quarter + INTERVAL '1' DAY AS DATE) END AS churn_date,
          {year_month("win_date")} AS win_year_mo,
          CASE WHEN o_custkey % 8 = 0 THEN '2018Q3' ELSE {year_quarter("win_date")} END AS win_year_quarter,
          CAST(year(win_date) AS STRING) AS win_year
        FROM (SELECT *, DATE '{SNAPSHOT}' AS the_date FROM {{lifetimes}}
              UNION ALL SELECT *, DATE '{EARLIER}' AS the_date FROM {{lifetimes}}) days""",
    "customer_age_view": f"""
        SELECT DATE '{SNAPSHOT}' AS the_date, {whole("o_custkey")} AS crm_account_id,
          {year_month("win_date")} AS win_year_mo, win_date,
          CASE WHEN o_custkey % 2 = 0 THEN last_quarter END AS suite_date, CAST(o_custkey % 80 AS INT) AS age_months,
          CASE WHEN o_custkey % 10 > 0 THEN (o_custkey % 80) / 12.0E0 END AS age_years
        FROM {{lifetimes}}""",
    "cohort": f"""
        SELECT {whole("c_custkey")} AS crm_account_id, mrr_date,
          CASE WHEN mrr_date = DATE '{SNAPSHOT}' OR c_custkey % 2 = 0 THEN 'max' ELSE 'qtr' END AS day_type,
          CAST(c_custkey % 80 AS INT) AS age_months, c_mktsegment AS industry,
          {REGION.format("c_custkey")} AS crm_owner_region_clean,
          CASE WHEN c_acctbal > 5000 THEN 'Assisted' ELSE 'Self-service' END AS sales_model_at_win,
          CASE WHEN c_custkey % 2 = 0 THEN 'Annual' ELSE 'Monthly' END AS term_at_win, 'Support-only' AS product_mix_at_win,
          CASE WHEN c_custkey % 3 > 0 THEN 'Mid-Market' END AS market_segment_at_win, 'ops band' AS crm_arr_band_ops_at_win,
          'sub band' AS crm_arr_sub_band_ops_at_win, CAST(floor(c_acctbal) AS DOUBLE) AS net_arr_usd_at_win,
          'Assisted' AS sales_model, 'Annual' AS term, c_mktsegment AS product_mix,
          CASE WHEN c_custkey % 5 > 0 THEN 'Enterprise' END AS market_segment, 'ops now' AS crm_arr_band_ops,
          'sub now' AS crm_arr_sub_band_ops, 'Upgrade' AS max_plan_change_type, 'Up' AS agent_change_type,
          c_custkey % 7 AS paid_agents_change_from_win, 'Same' AS term_change_from_win,
          CASE WHEN c_custkey % 2 = 0 THEN 'Changed' ELSE 'Same' END AS product_mix_change_from_win,
          'Same' AS market_segment_change_from_win, 'Same' AS crm_arr_band_ops_change_from_win,
          'Same' AS crm_arr_sub_band_ops_change_from_win, 'Same' AS sales_model_change_from_win,
          CAST(floor(c_acctbal) - 10 AS DOUBLE) AS net_arr_change_from_win
        FROM (SELECT *, DATE '{SNAPSHOT}' AS mrr_date FROM {{customer}}
              UNION ALL SELECT *, DATE '{EARLIER}' AS mrr_date FROM {{customer}}) days""",
    "engagement": f"""
        SELECT CASE WHEN c_custkey % 37 = 5 THEN DATE '{EARLIER}' ELSE DATE '{SNAPSHOT}' END AS run_at,
          {whole("c_custkey")} AS crm_account_id,
          CASE WHEN c_custkey % 13 = 0 THEN 'No Paid Products' ELSE 'Support,Chat' END AS product_combo,
          CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS is_paying_support, CASE WHEN c_custkey % 3 = 0 THEN 1 END AS is_paying_chat,
          CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS is_paying_talk, CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS is_paying_guide,
          CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS is_activated_support, 1 AS is_activated_chat,
          CASE WHEN c_custkey % 10 = 0 THEN 1 END AS is_activated_talk, 0 AS is_activated_guide,
          CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS is_engaged_support, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_engaged_chat,
          CASE WHEN c_custkey % 9 > 0 THEN CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END END AS is_engaged_talk, 0 AS is_engaged_guide
        FROM {{customer}}""",
    "billing_accounts": f"""
        SELECT CASE WHEN c_custkey % 10 = 3 THEN 'unknown' ELSE {whole("c_custkey")} || '.0' END AS instance_ref,
          CASE WHEN c_custkey % 29 = 0 THEN 'Fraudulent' ELSE 'Standard' END AS accounttype__c,
          'BC' || {whole("c_custkey")} AS billtocontact_id, 'Y' AS dw_curr_ind FROM {{customer}}""",
    "billing_contacts": f"""
        SELECT 'BC' || {whole("c_custkey")} AS id, 'home' AS personalemail, 'bill' || {whole("c_custkey")} AS workemail
        FROM {{customer}} WHERE c_custkey % 3 > 0""",
    "startups": f"SELECT {whole('c_custkey')} AS crm_account_id FROM {{customer}} WHERE c_custkey % 7 = 0",
    "smb_startups": f"SELECT {whole('c_custkey')} AS crm_account_id FROM {{customer}} WHERE c_custkey % 14 = 0",
    "expansion_accounts": f"SELECT {whole('c_custkey')} AS crm_account_id FROM {{customer}} WHERE c_custkey % 2 = 0",
    "cross_sell_scores": f"""
        SELECT {whole("c_custkey")} AS crm_account_id, CASE n_regionkey WHEN 0 THEN 'AMER' WHEN 1 THEN 'EMEA'
          WHEN 2 THEN 'APAC' WHEN 3 THEN 'LATAM' ELSE 'OTHER' END AS region_vp,
          CASE WHEN c_custkey % 4 = 0 THEN 'Field' ELSE 'Velocity ' || n_name END AS subregion_dir,
          CASE WHEN c_custkey % 6 = 0 THEN 'Suite' ELSE 'Support-only' END AS product_mix_at_cross_sell,
          CAST(floor(c_acctbal / 10) AS BIGINT) AS gb_rank
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "instances_raw": "SELECT c_custkey AS account_id FROM {customer}",
    "instances": f"""
        SELECT c_custkey AS account_id, {whole("c_custkey")} AS sfdc_crm_id,
          CASE c_custkey % 5 WHEN 0 THEN 'Trial' WHEN 1 THEN 'Trial - expired' WHEN 2 THEN 'Churned' ELSE 'Customer' END AS derived_account_type,
          {RUN.format("c_custkey")} AS latest_run_at, 'agent' || {whole("c_custkey")} || '@x' AS cust_owner_email,
          c_custkey + 7 AS owner_id, c_name AS subdomain, 'R' AS region, 'C' || {whole("c_nationkey")} AS country,
          c_mktsegment AS industry_full_name, 0 AS is_sandbox, 1 AS is_active,
          CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS is_trial, CASE WHEN c_custkey % 5 = 1 THEN 1 ELSE 0 END AS trial_expired,
          CASE WHEN c_custkey % 2 = 0 THEN DATE '2001-11-15' ELSE DATE '2000-01-01' END AS trial_expires_on,
          CAST('1999-01-01' AS TIMESTAMP) AS created_at,
          CASE c_custkey % 6 WHEN 0 THEN 'Support Essential' WHEN 1 THEN 'Team' WHEN 2 THEN 'Plus' WHEN 3 THEN 'Enterprise Elite'
            ELSE 'Legacy' END AS plan_name, 'paid' AS plan_type, CAST(c_custkey % 50 AS INT) AS max_agents, '1-9' AS employee_count,
          'small' AS help_desk_size, CAST(NULL AS DATE) AS churn_dt, 0 AS is_churned, DATE '1999-02-01' AS win_dt,
          c_acctbal AS risk_score, CASE WHEN c_custkey % 12 > 0 THEN 'B' || {whole("c_custkey")} END AS billing_id
        FROM {{customer}}""",
    "agents": f"""
        SELECT o_custkey AS account_id,
          CASE WHEN o_orderkey % 10 = 0 THEN DATE '2001-01-01' ELSE {RUN.format("o_custkey")} END AS run_at, o_orderkey AS agent_id,
          CASE WHEN o_orderkey % 4 = 0 THEN 'agent' || {whole("o_custkey")} || '@x' WHEN o_orderkey % 21 > 0 THEN 'agent' || {whole("o_orderkey % 500")} || '@y'
            END AS agent_email,
          CASE o_orderkey % 4 WHEN 0 THEN 'Ann' WHEN 1 THEN 'Ann Lee' WHEN 2 THEN 'Ann van Lee' END AS agent_name,
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Admin' ELSE 'Agent' END AS agent_type,
          CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS is_active, 1 AS is_verified,
          CAST('2000-01-01' AS TIMESTAMP) AS agent_created_at, CAST(o_orderkey % 3 AS INT) AS locale_id
        FROM {{orders}}""",
    "locales": f"""
        SELECT DISTINCT CAST(o_orderkey % 3 AS INT) AS locale_id, 'loc' || {whole("o_orderkey % 3")} AS locale,
          'Language ' || {whole("o_orderkey % 3")} AS name FROM {{orders}} WHERE o_orderkey % 3 < 2""",
    "crm_contacts": f"""
        SELECT DISTINCT 'K' || {whole("o_orderkey % 500")} AS id, {whole("o_custkey")} AS accountid,
          'agent' || {whole("o_orderkey % 500")} || '@y' AS email,
          CASE WHEN o_orderkey % 13 = 0 THEN 'True' ELSE 'False' END AS isdeleted, 'Y' AS dw_curr_ind
        FROM {{orders}}""",
    "roles": f"""
        SELECT c_custkey AS account_id, run_at, CAST(c_custkey % 90 AS INT) AS num_users, CAST(c_custkey % 4 AS INT) AS num_admins,
          CAST(c_custkey % 30 AS INT) AS num_agents, 1 AS num_light_agents
        FROM (SELECT *, DATE '{SNAPSHOT}' AS run_at FROM {{customer}} WHERE c_custkey % 8 > 0
              UNION ALL SELECT *, DATE '{EARLIER}' AS run_at FROM {{customer}}) runs""",
    "answer_bot": f"""
        SELECT c_custkey AS account_id, {RUN.format("c_custkey")} AS run_at, CAST('2001-01-01' AS TIMESTAMP) AS created_at,
          CAST(NULL AS TIMESTAMP) AS trial_expires_at, CAST(c_custkey % 40 AS INT) AS days_elapsed, 5 AS estimated_resolutions,
          9 AS max_resolutions, 'trial' AS product_state, 2 AS resolutions_used, 0 AS boosted_resolutions,
          CAST(NULL AS TIMESTAMP) AS boost_expires_at
        FROM {{customer}} WHERE c_custkey % 6 = 0""",
    "explore": f"""
        SELECT c_custkey AS account_id, CASE WHEN c_custkey % 4 = 0 THEN DATE '2001-01-01' ELSE {RUN.format("c_custkey")} END AS run_at,
          'active' AS state, 'pro' AS plan_name, 1 AS is_initialized, CAST('2001-02-02' AS TIMESTAMP) AS activated_at
        FROM {{customer}} WHERE c_custkey % 3 > 0""",
    "combo_metrics": f"""
        SELECT CASE c_custkey % 9 WHEN 1 THEN 'n/a' WHEN 2 THEN {whole("c_custkey")} ELSE {whole("c_custkey")} || '.0' END AS instance_ref,
          CAST(c_custkey % 60 AS INT) AS calls_last_30_days, 'yes' AS ivr_enabled, CAST(c_custkey % 20 AS INT) AS support_agents,
          'no' AS support_email_connector_enabled, CAST(c_custkey % 400 AS INT) AS support_tickets, 3 AS support_one_touch_tickets,
          4 AS support_custom_ticket_fields, 5 AS support_tickets_created_last_14_days, 6 AS support_tickets_created_last_30_days,
          DATE '2000-03-03' AS chat_enabled_date, 'none' AS talk_cti_partner_plan, c_acctbal AS talk_telephony_credits_remaining,
          'basic' AS talk_last_known_plan, 'web' AS talk_initial_channel, 'no' AS talk_sms_enabled, 2 AS talk_total_agents,
          CAST('2001-08-08' AS TIMESTAMP) AS support_last_login
        FROM {{customer}}""",
    "chat_accounts": f"""
        SELECT o_custkey AS instance_id, CASE WHEN o_custkey % 6 > 0 THEN o_custkey + 1000000 END AS chat_account_id,
          CASE WHEN o_custkey % 8 > 0 THEN o_custkey + 2000000 END AS chat_number, 'chat' || {whole("o_orderkey")} AS subdomain,
          CAST(o_orderdate AS DATE) AS create_date, o_orderpriority AS derived_chat_account_type, DATE '2000-05-05' AS chat_win_dt,
          CAST(NULL AS DATE) AS chat_churn_dt, CAST(NULL AS DATE) AS cancellation_date, 'sales' AS use_case, 'team' AS chat_plan_name,
          o_orderstatus AS chat_status, CAST(o_orderkey % 40 AS INT) AS max_agents, 3 AS enabled_agent_count,
          1 AS enabled_trigger_count, CASE WHEN o_orderkey % 2 = 0 THEN CAST('2001-03-03' AS TIMESTAMP) END AS embedded_timestamp
        FROM {{orders}} WHERE o_custkey % 2 = 0""",
    "chat_settings": f"""
        SELECT id, run_at, create_date, pre AS forms_pre_chat_form_required,
          CASE WHEN id % 3 > 0 THEN 'fb' || {whole("id")} END AS offline_form_facebook, CASE WHEN id % 4 > 0 THEN 'tw' END AS offline_form_twitter,
          CASE WHEN id % 5 > 0 THEN 'req' || {whole("id")} END AS chat_request_form, 'skill' AS routing_skill, 'hours' AS operating_hours,
          CASE WHEN id > 2000000 THEN 'legacy' WHEN id % 2 > 0 THEN 'hide' END AS chat_button_hide_when_offline
        FROM (SELECT c_custkey AS id, DATE '{SNAPSHOT}' AS run_at, DATE '1999-01-01' AS create_date, 'pre now' AS pre FROM {{customer}} WHERE c_custkey % 5 > 0
              UNION ALL SELECT c_custkey, DATE '{EARLIER}', DATE '1998-01-01', 'pre old' FROM {{customer}}
              UNION ALL SELECT c_custkey + 2000000, DATE '{EARLIER}', DATE '1998-01-01', 'pre legacy' FROM {{customer}} WHERE c_custkey % 7 > 0) feeds""",
    "chat_stats": """
        SELECT user_id + 1000000 AS account_id, ts AS timestamp, event_id AS conversations FROM {events} WHERE user_id % 3 > 0""",
    "chat_stats_legacy": """
        SELECT user_id + 2000000 AS account_id, ts AS timestamp, event_id + 5 AS conversations FROM {events}""",
    "guide": f"""
        SELECT CASE WHEN c_custkey % 33 > 0 THEN c_custkey END AS account_id, 0 AS is_trial, DATE '1999-09-09' AS trial_start_date,
          DATE '1999-10-09' AS trial_end_date, DATE '1999-11-11' AS win_dt, CAST(NULL AS DATE) AS churn_dt,
          'Customer' AS derived_guide_account_type, 'guide pro' AS plan_name, 4 AS max_agents, 1 AS num_article_edits_28d,
          CAST(c_custkey % 200 AS INT) AS num_articles, 2 AS num_articles_added_28d, 1 AS num_hc, 0 AS num_hc_archived,
          0 AS num_hc_embeddables_automatic_answers, 1 AS num_hc_embeddables_web_widget, 1 AS num_hc_enabled,
          0 AS num_hc_restricted, 1 AS content_cues_activated
        FROM {{customer}} WHERE c_custkey % 4 > 0""",
    "voice": f"""
        SELECT c_custkey AS account_id, CASE WHEN c_custkey % 7 = 0 THEN DATE '2001-01-01' ELSE {RUN.format("c_custkey")} END AS run_at,
          1 AS is_trial, DATE '2001-05-05' AS derived_trial_start_date, DATE '2001-06-05' AS trial_end_date, 30 AS num_days_in_trial,
          'talk team' AS plan_name, 'Trial' AS derived_voice_account_type, CAST(NULL AS DATE) AS win_date, 0 AS has_voice_subscription,
          1 AS is_active, CAST(NULL AS DATE) AS churn_date, CAST(NULL AS STRING) AS plan_name_at_win
        FROM {{customer}} WHERE c_custkey % 2 = 1""",
    "knowledge_capture": f"""
        SELECT o_custkey AS account_id, {RUN.format("o_custkey")} AS run_at, o_orderkey % 2 AS total_events_28
        FROM {{orders}} WHERE o_custkey % 3 > 0""",
    "product_scores": "SELECT c_custkey AS account_id, c_acctbal AS score FROM {customer} WHERE c_custkey % 2 = 0",
    "instance_lifecycle": """
        SELECT c_custkey AS instance_id, CASE WHEN c_custkey % 6 > 0 THEN c_custkey + 1000000 END AS chat_account_id,
          CASE WHEN c_custkey % 8 > 0 THEN c_custkey + 2000000 END AS chat_number
        FROM {customer} WHERE c_custkey % 5 > 0""",
    "plan_shift_scores": f"""
        SELECT {whole("c_custkey")} AS instance_ref, scored AS date_scored, 'model ' || c_mktsegment AS model_plan,
          (c_custkey % 100) / 128.0E0 AS probability
        FROM (SELECT *, DATE '{SNAPSHOT}' AS scored FROM {{customer}} WHERE c_custkey % 3 > 0
              UNION ALL SELECT *, DATE '{EARLIER}' AS scored FROM {{customer}}) runs""",
    "churn_scores": f"""
        SELECT {whole("c_custkey")} AS crm_account_id, DATE '{SNAPSHOT}' AS date_scored, 'churn' AS model_plan,
          (c_custkey % 50) / 64.0E0 AS churn_probability, c_acctbal AS health_score
        FROM {{customer}} WHERE c_custkey % 4 > 0""",
    "tickets": """
        SELECT o_custkey AS account_id, o_orderdate AS run_at, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS new_channel_facebook_msg,
          0 AS new_channel_facebook_post, CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 0 END AS new_channel_twitter,
          0 AS new_channel_twitter_dm, 0 AS new_channel_twitter_fave
        FROM {orders}""",
    "instance_settings": """
        SELECT o_custkey AS account_id, CAST(o_orderdate AS DATE) AS run_at, CAST(o_orderkey % 3 AS INT) AS num_facebook_pages,
          CAST(o_orderkey % 5 AS INT) AS num_twitter_handles FROM {orders}""",
}


def prelude(*extra: str) -> str:
    """``WITH`` clause that defines every input (DuckDB drops the unused ones)."""
    names = {n: n for n in [*DRIVER, *INPUTS]}
    parts = [f"{name} AS ({sql.format(**names)})" for name, sql in INPUTS.items()]
    return "WITH " + ",\n".join([*parts, *extra])


class Domain(Mapping[str, DataFrame]):
    """The inputs as lazy Spark frames over one driver folder.

    ``prepared`` holds stored inputs by (folder, name), for a bench that does not time their derivation.
    ``stored`` names inputs that a report reads several times and that cost a shuffle of a whole table:
    where there is a shared folder, they are derived once and read back.
    """

    prepared: dict[tuple[str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, folder: str, stored: Sequence[str] = ()) -> None:
        self._spark = spark
        self._stored = set(stored) if staging_folder(spark) else set()
        self._makers: dict[str, Callable[[], DataFrame]] = {}
        self._frames = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in DRIVER}
        self._frames |= {name: df for (of, name), df in self.prepared.items() if of == folder}

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._makers:
            self._frames[name] = stage(self._makers.pop(name)(), name)
        if name not in self._frames:
            sql = INPUTS[name]
            used = {n: self[n] for n in [*DRIVER, *INPUTS] if "{" + n + "}" in sql}
            derived = self._spark.sql(sql, **used)
            self._frames[name] = stage(derived, name) if name in self._stored else derived
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*DRIVER, *INPUTS])

    def __len__(self) -> int:
        return len(DRIVER) + len(INPUTS)

    def add(self, name: str, maker: Callable[[], DataFrame]) -> None:
        """Serve a report under its logical name; it is built on first use and staged."""
        if name not in self._frames:
            self._makers[name] = maker
