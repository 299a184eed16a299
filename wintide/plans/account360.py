"""Account-360 views: one wide row per account and admin agent."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.functions import (
    complement,
    composite_key,
    days_left,
    normalize_id,
    ratio,
    role_label,
)
from wintide.operators import (
    Feature,
    account_360,
    coalesce_sources,
    current_rows,
    latest_per_key,
    latest_snapshot,
    lookup,
    lookup_many,
    preaggregate_join,
    semi_filter,
)

Tables = Mapping[str, DataFrame]
Stage = Callable[[DataFrame, str], DataFrame]

CHAT_FLAGS = {
    "offline_form_facebook": "chat_offline_form_facebook_flag",
    "offline_form_twitter": "chat_offline_form_twitter_flag",
    "chat_request_form": "chat_request_form_flag",
    "routing_skill": "chat_skill_routing_flag",
    "operating_hours": "chat_operating_hours_flag",
    "chat_button_hide_when_offline": "chat_offline_form_flag",
}


def _renamed(df: DataFrame, names: Mapping[str, str], *keys: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(n) for c, n in names.items()])


def eligible_instances(t: Tables, as_of: Column, trial_from: date) -> DataFrame:
    """Customer and trial instances, plus trials that expired on or after ``trial_from``."""
    kind = F.col("derived_account_type")
    recent_trial = (kind == "Trial - expired") & (F.col("trial_expires_on") >= F.lit(trial_from))
    kept = t["instances"].filter(
        (kind.isin("Trial", "Customer") | recent_trial) & F.col("account_id").isNotNull()
    )
    plain = [
        "account_id",
        "sfdc_crm_id",
        "derived_account_type",
        "latest_run_at",
        "cust_owner_email",
        F.col("owner_id").alias("agent_owner_id"),
        "subdomain",
        "region",
        "country",
        "industry_full_name",
    ]
    support = {
        "subdomain": "support_subdomain",
        "region": "support_account_region",
        "country": "support_account_country",
        "industry_full_name": "support_account_industry",
        "is_sandbox": "support_account_sandbox",
        "derived_account_type": "support_derived_account_type",
        "is_active": "support_active_flag",
        "is_trial": "support_active_trial_flag",
        "trial_expired": "support_trial_expired_flag",
        "trial_expires_on": "support_trial_expires_on",
        "created_at": "support_instance_created_date",
        "plan_name": "support_plan_name",
        "max_agents": "support_max_agents",
        "employee_count": "support_account_employee_count",
        "help_desk_size": "support_help_desk_size",
        "churn_dt": "support_churn_date",
        "is_churned": "support_churned_flag",
        "win_dt": "support_win_date",
        "risk_score": "support_risk_score",
    }
    left = days_left("trial_expires_on", as_of, F.col("is_trial") == 1)
    return kept.select(
        *plain,
        *[F.col(c).alias(n) for c, n in support.items()],
        left.alias("support_days_left_in_trial"),
    ).distinct()


AGENT_COLUMNS = [
    "run_at",
    "unique_identifier",
    "agent_email",
    "agent_id",
    "agent_name",
    "derived_agent_type",
    "agent_language",
    "agent_is_active",
    "agent_is_verified",
    "agent_created_date",
]


def admins(t: Tables) -> DataFrame:
    """Active admin agents per instance and run, with their language."""
    kept = t["agents"].filter((F.col("agent_type") == "Admin") & (F.col("is_active") == 1))
    named = lookup(kept, t["locales"], "locale_id", [F.col("locale").alias("agent_language")])
    return named.select(
        "account_id",
        F.col("run_at").alias("__run"),
        "run_at",
        composite_key("account_id", "agent_email").alias("unique_identifier"),
        "agent_email",
        "agent_id",
        "agent_name",
        "agent_language",
        F.col("is_active").alias("agent_is_active"),
        F.col("is_verified").alias("agent_is_verified"),
        F.col("agent_created_at").alias("agent_created_date"),
    ).distinct()


def per_admin(df: DataFrame) -> DataFrame:
    """Order the agent columns after the instance columns and label the owner."""
    found = F.col("unique_identifier").isNotNull()
    role = F.when(found, role_label("agent_email", "cust_owner_email"))
    first = [c for c in df.columns if c not in AGENT_COLUMNS]
    return df.withColumn("derived_agent_type", role).select(*first, *AGENT_COLUMNS)


AT_LATEST_RUN = ["account_id", ("latest_run_at", "__run")]
# By account; the agent lets the range partitioning split an account with very many agents.
SORT_KEYS = ["account_id", "agent_id"]


def staff_counts(t: Tables) -> DataFrame:
    counts = latest_snapshot(t["roles"], "run_at").select(
        "account_id", "num_users", "num_admins", "num_agents", "num_light_agents"
    )
    return counts.withColumn("agent_to_admin_ratio", ratio("num_agents", "num_admins"))


ANSWER_BOT = {
    "created_at": "answer_bot_instance_created_date",
    "trial_expires_at": "answer_bot_trial_expires_date",
    "days_elapsed": "answer_bot_days_elapsed",
    "estimated_resolutions": "answer_bot_estimated_resolutions",
    "max_resolutions": "answer_bot_max_resolutions",
    "product_state": "answer_bot_product_state",
    "resolutions_used": "answer_bot_resolutions_used",
    "boosted_resolutions": "answer_bot_boosted_resolutions",
    "boost_expires_at": "answer_bot_boost_expires_at",
}
EXPLORE = {
    "state": "explore_account_type",
    "plan_name": "explore_plan_name",
    "is_initialized": "explore_activation_flag",
    "activated_at": "explore_activation_date",
}
USAGE = [
    "support_agents",
    "support_email_connector_enabled",
    "support_tickets",
    "support_one_touch_tickets",
    "support_custom_ticket_fields",
    "support_tickets_created_last_14_days",
    "support_tickets_created_last_30_days",
    "chat_enabled_date",
    "talk_cti_partner_plan",
    "talk_telephony_credits_remaining",
    "talk_last_known_plan",
    "talk_initial_channel",
    "talk_sms_enabled",
    "talk_total_agents",
    "support_last_login",
]
CALLS = ["calls_last_30_days", "ivr_enabled"]
GUIDE = {
    "is_trial": "guide_active_trial_flag",
    "trial_start_date": "guide_trial_start_date",
    "trial_end_date": "guide_trial_end_date",
    "win_dt": "guide_win_date",
    "churn_dt": "guide_churn_date",
    "derived_guide_account_type": "guide_derived_account_type",
    "plan_name": "guide_plan_name",
    "max_agents": "guide_max_agents",
    "num_article_edits_28d": "guide_num_article_edits_28d",
    "num_articles": "guide_num_articles",
    "num_articles_added_28d": "guide_num_articles_added_28d",
    "num_hc": "guide_num_hc",
    "num_hc_archived": "guide_num_hc_archived",
    "num_hc_embeddables_automatic_answers": "guide_num_hc_embeddables_automatic_answers",
    "num_hc_embeddables_web_widget": "guide_num_hc_embeddables_web_widget",
    "num_hc_enabled": "guide_num_hc_enabled",
    "num_hc_restricted": "guide_num_hc_restricted",
    "content_cues_activated": "guide_content_cues_activated_flag",
}
VOICE = {
    "is_trial": "talk_active_trial_flag",
    "derived_trial_start_date": "talk_trial_start_date",
    "trial_end_date": "talk_trial_end_date",
    "num_days_in_trial": "talk_num_days_in_trial",
    "plan_name": "talk_plan_name",
    "derived_voice_account_type": "talk_derived_account_type",
    "win_date": "talk_win_date",
    "has_voice_subscription": "has_talk_subscription",
    "is_active": "talk_is_active",
    "churn_date": "talk_churn_date",
    "plan_name_at_win": "talk_plan_name_at_win",
}
CHAT = {
    "subdomain": "chat_subdomain",
    "create_date": "chat_instance_created_date",
    "derived_chat_account_type": "chat_derived_account_type",
    "chat_win_dt": "chat_win_date",
    "chat_churn_dt": "chat_churn_date",
    "cancellation_date": "chat_cancellation_date",
    "use_case": "chat_use_case",
    "chat_plan_name": "chat_plan_name",
    "chat_status": "chat_status",
    "max_agents": "chat_max_agents",
    "enabled_agent_count": "chat_enabled_agent_count",
    "enabled_trigger_count": "chat_enabled_triggers",
    "embedded_timestamp": "chat_web_widget_embedded_date",
}


def usage_metrics(t: Tables) -> DataFrame:
    """Usage counters under the parsed instance id; unreadable ids drop out."""
    parsed = t["combo_metrics"].withColumn("account_id", normalize_id("instance_ref"))
    return parsed.select("account_id", *CALLS, *USAGE).filter(F.col("account_id").isNotNull())


def newest_stats(stats: DataFrame) -> DataFrame:
    return latest_per_key(stats, ["account_id"], "timestamp", ties="all").select(
        "account_id", "conversations"
    )


def chat_features(t: Tables, conversations: bool = True) -> DataFrame:
    """Newest chat account per instance with settings from the current or the legacy feed.

    Settings come under the instance id (latest run only) and, as a fallback, under the legacy
    chat number next to legacy statistics.
    """
    settings = t["chat_settings"]
    flags = list(CHAT_FLAGS)
    newest = latest_per_key(t["chat_accounts"], ["instance_id"], "create_date", ties="all")
    newest = newest.filter(
        F.col("chat_account_id").isNotNull() & F.col("chat_number").isNotNull()
    )
    current = latest_per_key(latest_snapshot(settings, "run_at"), ["id"], "create_date", ties="all")
    current = current.select("id", "forms_pre_chat_form_required", *flags)
    any_run = latest_per_key(settings, ["id"], "create_date", ties="all").select("id", *flags)
    legacy = lookup(newest_stats(t["chat_stats_legacy"]), any_run, [("account_id", "id")])
    sources = [(current, ("instance_id", "id")), (legacy, ("chat_number", "account_id"))]
    fields = ["forms_pre_chat_form_required", *flags]
    if conversations:
        sources.insert(1, (newest_stats(t["chat_stats"]), ("chat_account_id", "account_id")))
        fields.append("conversations")
    out = coalesce_sources(newest, sources, fields)
    embedded = F.when(F.col("embedded_timestamp").isNull(), "not embedded").otherwise("embedded")
    talk = [F.col("conversations").alias("chat_conversations_in_last_day")] if conversations else []
    return out.select(
        "instance_id",
        *[F.col(c).alias(n) for c, n in CHAT.items()],
        embedded.alias("chat_web_widget_embedded_flag"),
        F.col("forms_pre_chat_form_required").alias("chat_prechat_form_flag"),
        *[F.col(c).alias(n) for c, n in CHAT_FLAGS.items()],
        *talk,
    ).distinct()


def plan_shift(t: Tables) -> DataFrame:
    scored = latest_snapshot(t["plan_shift_scores"], "date_scored")
    return scored.select(
        normalize_id("instance_ref").alias("account_id"),
        F.col("model_plan").alias("plan_shift_model_plan"),
        F.col("probability").alias("plan_shift_probability"),
        complement("probability").alias("no_plan_shift_probability"),
    )


def churn_risk(t: Tables) -> DataFrame:
    scored = latest_snapshot(t["churn_scores"], "date_scored")
    return scored.select(
        "crm_account_id",
        "churn_probability",
        F.col("health_score").alias("churn_health_score"),
        F.col("model_plan").alias("churn_model_plan"),
    )


def crm_profiles(t: Tables) -> DataFrame:
    names = {
        "name": "company",
        "territory_country__c": "sfdc_account_country",
        "region__c": "sfdc_account_region",
        "employee_range__c": "sfdc_account_employee_range",
    }
    profiles = _renamed(current_rows(t["crm_accounts"]), names, "id").distinct()
    models = current_rows(t["customer_dim"])
    lowest = F.min("sales_model").alias("sales_model")
    return preaggregate_join(profiles, models, [("id", "crm_account_id")], [lowest])


def account_360_report(t: Tables, as_of: Column, trial_from: date) -> DataFrame:
    """All product, usage, score and CRM features per instance and active admin.

    Features meet the instances first, one row per instance; the admins, of which one instance may
    have very many, come last in an inner join whose sides can both be split.
    """
    key = "account_id"
    at_run = [key, ("latest_run_at", "run_at")]
    chat = chat_features(t, conversations=False).withColumn("chat_id", F.col("instance_id"))
    guide = _renamed(t["guide"].filter("account_id IS NOT NULL"), GUIDE, key).withColumn(
        "guide_account_id", F.col(key)
    )
    voice = _renamed(t["voice"], VOICE, key, "run_at").withColumns(
        {"talk_active_flag": F.col("talk_is_active"), "talk_account_id": F.col(key)}
    )
    captured = t["knowledge_capture"].groupBy(key, "run_at").agg(
        F.max("total_events_28").alias("__captures")
    )
    features = [
        Feature(crm_profiles(t), [("sfdc_crm_id", "id")]),
        Feature(t["product_scores"].select(key, F.col("score").alias("support_pql_score")), key, unique=True),
        Feature(staff_counts(t).drop("agent_to_admin_ratio"), key, unique=True),
        Feature(_renamed(t["answer_bot"], ANSWER_BOT, key), key, unique=True),
        Feature(_renamed(t["explore"], EXPLORE, key, "run_at"), at_run, flag="explore_product_flag", unique=True),
        Feature(usage_metrics(t), key, USAGE, unique=True),
        Feature(chat, [(key, "instance_id")], flag="chat_product_flag"),
        Feature(guide, key, flag="guide_product_flag", unique=True),
        Feature(voice, at_run, flag="talk_product_flag", unique=True),
        Feature(captured, at_run),
        Feature(plan_shift(t), key, unique=True),
        Feature(churn_risk(t), [("sfdc_crm_id", "crm_account_id")], unique=True),
    ]
    # instances, profiles and chat accounts are distinct, the rest is unique: so is the wide row
    wide = account_360(eligible_instances(t, as_of, trial_from), features)
    capture_flag = F.when(F.col("__captures") > 0, 1).otherwise(0)
    wide = wide.withColumn("guide_knowledge_capture_flag", capture_flag).drop("__captures")
    return per_admin(lookup(wide, admins(t), AT_LATEST_RUN, how="inner")).orderBy(*SORT_KEYS)


def chat_conversations(t: Tables, instances: DataFrame) -> DataFrame:
    """Conversations of the last day from the current feed, else the legacy one."""
    ids = t["instance_lifecycle"].select("instance_id", "chat_account_id", "chat_number").filter(
        F.col("chat_account_id").isNotNull() | F.col("chat_number").isNotNull()
    )
    ids = semi_filter(ids, instances, [("instance_id", "account_id")])
    sources = [
        (newest_stats(t["chat_stats"]), ("chat_account_id", "account_id")),
        (newest_stats(t["chat_stats_legacy"]), ("chat_number", "account_id")),
    ]
    out = coalesce_sources(ids, sources, ["conversations"])
    return out.withColumnRenamed("conversations", "chat_conversations_in_last_day").distinct()


def account_overview_report(
    t: Tables, as_of: Column, trial_from: date, stage: Stage | None = None
) -> DataFrame:
    """Narrower view that keeps instances without an active admin.

    ``stage`` may write the per-instance table to the shared checkpoint folder; it is read twice.
    """
    instances = eligible_instances(t, as_of, trial_from)
    key = "account_id"
    at_run = [key, ("latest_run_at", "run_at")]
    features = [
        Feature(staff_counts(t).drop("agent_to_admin_ratio"), key),
        Feature(_renamed(t["answer_bot"], ANSWER_BOT, key, "run_at"), at_run),
        Feature(_renamed(t["explore"], EXPLORE, key, "run_at"), at_run, flag="explore_product_flag"),
        Feature(usage_metrics(t), key, [*CALLS, *USAGE]),
        Feature(
            chat_conversations(t, instances),
            [(key, "instance_id")],
            ["chat_conversations_in_last_day"],
        ),
        Feature(plan_shift(t), key),
    ]
    wide = account_360(instances, features)
    if stage is not None:
        wide = stage(wide, "account_overview")
    return per_admin(lookup_many(wide, admins(t), AT_LATEST_RUN)).orderBy(*SORT_KEYS)
