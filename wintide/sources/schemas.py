"""Input schemas of the reports, as DDL text by logical table name.

Account keys come in three spellings and are declared as they arrive: BIGINT instance ids, decimal
text such as ``"123.0"`` (``instance_ref``), and opaque CRM ids.
"""

from __future__ import annotations

_SCD2 = "dw_curr_ind string, dw_eff_start timestamp, dw_eff_end timestamp"

SCHEMAS: dict[str, str] = {
    # revenue
    "revenue_lines": (
        "mrr_date date, crm_account_id string, account_id string, product_line string,"
        " product_offering string, product_plan string, base_product_plan string,"
        " productrateplancharge_id string, baseplan_quantity bigint, net_arr double,"
        " net_arr_usd double, net_mrr_usd double, currency string, currentterm int,"
        " currentterm_prior_qtr_end int, crm_owner_region_clean string"
    ),
    "revenue_lines_snapshot": (
        "mrr_date date, crm_account_id string, product_line string, product_offering string,"
        " productrateplancharge_id string, baseplan_quantity bigint, net_arr double"
    ),
    "revenue_by_account": (
        "crm_account_id string, mrr_date date, crm_owner_region_clean string,"
        " crm_arr_band_primary string, crm_arr_band_secondary string, net_arr_usd double,"
        " net_arr_usd_prior_qtr_end double"
    ),
    # dimensions
    "product_dim": (
        "productrateplancharge_id string, product_type_derived string,"
        f" enterpriselicense_ind string, {_SCD2}"
    ),
    "product_plan_matrix": "product_plan string, plan_type int",
    "customer_dim": (
        "crm_account_id string, billing_account_id string, instance_ref string,"
        " billing_account_type_clean string, crm_business_unit string,"
        " crm_owner_region_clean string, sales_model string, date_extraction date,"
        f" billing_batch string, billing_country string, billing_currency string, {_SCD2}"
    ),
    "calendar": (
        "the_date date, fiscal_year int, month_year string, year_quarter string,"
        " last_day_of_qtr_ind string"
    ),
    "crm_accounts": (
        "id string, name string, ownerid string, success_owner__c string,"
        " employee_range__c string, num_employees__c string, industry string,"
        f" territory_country__c string, region__c string, isdeleted string, {_SCD2}"
    ),
    "crm_users": (
        "id string, name string, email string, firstname string, lastname string,"
        f" userroleid string, {_SCD2}"
    ),
    "crm_roles": f"id string, name string, {_SCD2}",
    "role_attributes": f"role_label__c string, vp_team__c string, dir_team__c string, {_SCD2}",
    "crm_contacts": (
        "id string, accountid string, email string, isdeleted string, dw_curr_ind string"
    ),
    "billing_accounts": (
        "instance_ref string, accounttype__c string, billtocontact_id string, dw_curr_ind string"
    ),
    "billing_contacts": "id string, personalemail string, workemail string",
    "employee_mapping": "employee_range string, employee_range_band string, market_segment string",
    "role_regions": "userrole string, region string, market_segment string",
    "range_segments": "range string, market_segment string",
    # events
    "opportunities": (
        "accountid string, opportunity_id string, close_date date, yyyyqq_closed string,"
        " yyyymm_closed string, type string, type_of_expansion string, stage_name string,"
        " total_booking_arr_usd double"
    ),
    "leads": (
        "id string, mql int, converted_accountid string, converted_opportunityid string,"
        " created_date timestamp, yyyymm_created string, yyyyqq_created string,"
        " mql_date timestamp, opportunity_created_date timestamp,"
        " opportunity_close_date timestamp, employee_range_at_signup_rollup string,"
        " derived_source_granular string, lead_region string, type string,"
        " opportunity_stage_name string, total_booking_arr_usd double"
    ),
    # lifecycle tables
    "win_dates": "crm_account_id string, win_date date",
    "customer_age": (
        "crm_account_id string, the_date date, win_date date, churn_date date,"
        " win_year_mo string, win_year_quarter string, win_year string"
    ),
    "customer_age_view": (
        "the_date date, crm_account_id string, win_year_mo string, win_date date,"
        " suite_date date, age_months int, age_years double"
    ),
    "cohort": (
        "crm_account_id string, mrr_date date, day_type string, age_months int,"
        " industry string, crm_owner_region_clean string, sales_model_at_win string,"
        " term_at_win string, product_mix_at_win string, market_segment_at_win string,"
        " crm_arr_band_ops_at_win string, crm_arr_sub_band_ops_at_win string,"
        " net_arr_usd_at_win double, sales_model string, term string, product_mix string,"
        " market_segment string, crm_arr_band_ops string, crm_arr_sub_band_ops string,"
        " max_plan_change_type string, agent_change_type string,"
        " paid_agents_change_from_win bigint, term_change_from_win string,"
        " product_mix_change_from_win string, market_segment_change_from_win string,"
        " crm_arr_band_ops_change_from_win string,"
        " crm_arr_sub_band_ops_change_from_win string, sales_model_change_from_win string,"
        " net_arr_change_from_win double"
    ),
    "engagement": (
        "run_at date, crm_account_id string, product_combo string, number_of_products int,"
        " paying_customer_ind int, is_paying_support int, is_paying_chat int,"
        " is_paying_talk int, is_paying_guide int, is_activated_support int,"
        " is_activated_chat int, is_activated_talk int, is_activated_guide int,"
        " is_engaged_support int, is_engaged_chat int, is_engaged_talk int,"
        " is_engaged_guide int"
    ),
    "startups": "crm_account_id string",
    "smb_startups": "crm_account_id string",
    "expansion_accounts": "crm_account_id string",
    "cross_sell_scores": (
        "crm_account_id string, region_vp string, subregion_dir string,"
        " product_mix_at_cross_sell string, gb_rank bigint"
    ),
    # instances and product usage
    "instances_raw": "account_id bigint",
    "instances": (
        "account_id bigint, sfdc_crm_id string, derived_account_type string,"
        " latest_run_at date, cust_owner_email string, owner_id bigint, subdomain string,"
        " region string, country string, industry_full_name string, is_sandbox int,"
        " is_active int, is_trial int, trial_expired int, trial_expires_on date,"
        " created_at timestamp, plan_name string, plan_type string, max_agents int,"
        " employee_count string, help_desk_size string, churn_dt date, is_churned int,"
        " win_dt date, risk_score double, billing_id string"
    ),
    "agents": (
        "account_id bigint, run_at date, agent_id bigint, agent_email string,"
        " agent_name string, agent_type string, is_active int, is_verified int,"
        " agent_created_at timestamp, locale_id int"
    ),
    "locales": "locale_id int, locale string, name string",
    "roles": (
        "account_id bigint, run_at date, num_users int, num_admins int, num_agents int,"
        " num_light_agents int"
    ),
    "answer_bot": (
        "account_id bigint, run_at date, created_at timestamp, trial_expires_at timestamp,"
        " days_elapsed int, estimated_resolutions int, max_resolutions int,"
        " product_state string, resolutions_used int, boosted_resolutions int,"
        " boost_expires_at timestamp"
    ),
    "explore": (
        "account_id bigint, run_at date, state string, plan_name string, is_initialized int,"
        " activated_at timestamp"
    ),
    "combo_metrics": (
        "instance_ref string, calls_last_30_days int, ivr_enabled string, support_agents int,"
        " support_email_connector_enabled string, support_tickets int,"
        " support_one_touch_tickets int, support_custom_ticket_fields int,"
        " support_tickets_created_last_14_days int, support_tickets_created_last_30_days int,"
        " chat_enabled_date date, talk_cti_partner_plan string,"
        " talk_telephony_credits_remaining double, talk_last_known_plan string,"
        " talk_initial_channel string, talk_sms_enabled string, talk_total_agents int,"
        " support_last_login timestamp"
    ),
    "chat_accounts": (
        "instance_id bigint, chat_account_id bigint, chat_number bigint, subdomain string,"
        " create_date date, derived_chat_account_type string, chat_win_dt date,"
        " chat_churn_dt date, cancellation_date date, use_case string, chat_plan_name string,"
        " chat_status string, phase string, max_agents int, enabled_agent_count int,"
        " enabled_trigger_count int, embedded_timestamp timestamp"
    ),
    "chat_settings": (
        "id bigint, run_at date, create_date date, forms_pre_chat_form_required string,"
        " offline_form_facebook string, offline_form_twitter string, chat_request_form string,"
        " routing_skill string, operating_hours string, chat_button_hide_when_offline string"
    ),
    "chat_stats": "account_id bigint, timestamp timestamp, conversations bigint",
    "chat_stats_legacy": "account_id bigint, timestamp timestamp, conversations bigint",
    "guide": (
        "account_id bigint, is_trial int, trial_start_date date, trial_end_date date,"
        " win_dt date, churn_dt date, derived_guide_account_type string, plan_name string,"
        " max_agents int, num_article_edits_28d int, num_articles int,"
        " num_articles_added_28d int, num_hc int, num_hc_archived int,"
        " num_hc_embeddables_automatic_answers int, num_hc_embeddables_web_widget int,"
        " num_hc_enabled int, num_hc_restricted int, content_cues_activated int"
    ),
    "voice": (
        "account_id bigint, run_at date, is_trial int, derived_trial_start_date date,"
        " trial_end_date date, num_days_in_trial int, plan_name string,"
        " derived_voice_account_type string, win_date date, has_voice_subscription int,"
        " is_active int, churn_date date, plan_name_at_win string"
    ),
    "knowledge_capture": "account_id bigint, run_at date, total_events_28 bigint",
    "product_scores": "account_id bigint, score double",
    "instance_lifecycle": (
        "instance_id bigint, chat_account_id bigint, chat_number bigint, support_win_dt date,"
        " support_churn_dt date, chat_win_dt date, chat_churn_dt date, guide_win_dt date,"
        " guide_churn_dt date, talk_win_dt date, talk_churn_dt date, explore_win_dt date,"
        " explore_churn_dt date"
    ),
    "plan_shift_scores": (
        "instance_ref string, date_scored date, model_plan string, probability double"
    ),
    "churn_scores": (
        "crm_account_id string, date_scored date, model_plan string, churn_probability double,"
        " health_score double"
    ),
    "tickets": (
        "account_id bigint, run_at timestamp, new_channel_facebook_msg bigint,"
        " new_channel_facebook_post bigint, new_channel_twitter bigint,"
        " new_channel_twitter_dm bigint, new_channel_twitter_fave bigint"
    ),
    "instance_settings": (
        "account_id bigint, run_at date, num_facebook_pages int, num_twitter_handles int"
    ),
}
