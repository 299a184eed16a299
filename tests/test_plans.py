"""Reports on small hand-made tables with NULLs, gaps and repeated keys."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from wintide import plans
from wintide.functions import yesterday_in
from wintide.sources import SCHEMAS, TableSet, parse_schema

SNAP = date(2019, 3, 31)
WIN = date(2016, 3, 31)
LIVE = {"dw_curr_ind": "Y", "dw_eff_start": datetime(2000, 1, 1), "dw_eff_end": datetime(9999, 12, 31)}


@pytest.fixture
def tables(spark):
    """Every input table, empty unless rows (dicts, missing columns NULL) are given."""

    def make(extra: dict | None = None, **rows: list[dict]) -> TableSet:
        frames = {}
        for name, ddl in SCHEMAS.items():
            schema = parse_schema(ddl)
            given = [tuple(r.get(f.name) for f in schema.fields) for r in rows.get(name, [])]
            unknown = {k for r in rows.get(name, []) for k in r} - set(schema.fieldNames())
            assert not unknown, (name, unknown)
            frames[name] = spark.createDataFrame(given, schema)
        return TableSet(spark, overrides={**frames, **(extra or {})})

    return make


def line(account, day, product, plan, qty, arr=100.0, charge="p1", **more):
    return {
        "crm_account_id": account,
        "account_id": f"B{account}",
        "mrr_date": day,
        "product_line": product,
        "product_plan": plan,
        "product_offering": f"{product} {plan}",
        "baseplan_quantity": qty,
        "net_arr": arr,
        "net_arr_usd": arr,
        "net_mrr_usd": arr,
        "productrateplancharge_id": charge,
        **more,
    }


def opportunity(account, number, day, kind, amount, **more):
    return {
        "accountid": account,
        "opportunity_id": number,
        "close_date": day,
        "yyyymm_closed": f"{day:%Y-%m}",
        "yyyyqq_closed": f"{day.year}Q{(day.month + 2) // 3}",
        "type": "Expansion",
        "type_of_expansion": kind,
        "stage_name": "07 - Closed",
        "total_booking_arr_usd": amount,
        **more,
    }


def day_row(day, **more):
    return {"the_date": day, "fiscal_year": day.year, "month_year": f"{day:%Y-%m}", "year_quarter": f"{day.year}Q{(day.month + 2) // 3}", "last_day_of_qtr_ind": "Y", **more}


@pytest.fixture
def smb(tables):
    lines = [
        line("a", WIN, "Support", "Team", 5),
        line("a", SNAP, "Support", "Enterprise", 10, currentterm=12),
        line("a", SNAP, "Support", "Team", 2, charge="ela", currentterm_prior_qtr_end=1),
        line("a", SNAP, "Chat", "Team", 3, arr=0.0),
        line("b", SNAP, "Support", "Starter", 4),
        line("c", SNAP, "Chat", "Team", 1),
    ]
    snapshot = parse_schema(SCHEMAS["revenue_lines_snapshot"]).fieldNames()

    def revenue(account, day, amount, region="AMER"):
        return {"crm_account_id": account, "mrr_date": day, "net_arr_usd": amount, "crm_owner_region_clean": region}

    return tables(
        revenue_lines=lines,
        revenue_lines_snapshot=[{k: v for k, v in r.items() if k in snapshot} for r in lines],
        revenue_by_account=[
            revenue("a", SNAP, 1500.0),
            revenue("b", SNAP, 400000.0),
            revenue("c", SNAP, 0.0),
            revenue("d", SNAP, 10.0, None),
            revenue("a", WIN, 100.0),
            revenue("c", WIN, 0.0),
        ],
        win_dates=[{"crm_account_id": "a", "win_date": WIN}, {"crm_account_id": "b", "win_date": date(2010, 1, 1)}, {"crm_account_id": "c", "win_date": WIN}],
        calendar=[day_row(SNAP), day_row(WIN)],
        product_dim=[
            {"productrateplancharge_id": "p1", "enterpriselicense_ind": "N", "product_type_derived": "Base", **LIVE},
            {"productrateplancharge_id": "ela", "enterpriselicense_ind": "Y", "product_type_derived": "Base", **LIVE},
        ],
        customer_dim=[
            {"crm_account_id": "a", "billing_account_type_clean": "Customer", "crm_business_unit": "BU", "date_extraction": SNAP, **LIVE},
            {"crm_account_id": "a", "billing_account_type_clean": "Customer", "crm_business_unit": "Old", "date_extraction": WIN, "sales_model": "x", **LIVE},
            {"crm_account_id": "b", "billing_account_type_clean": "Test", "crm_business_unit": "BU", "date_extraction": SNAP, **LIVE},
        ],
        crm_accounts=[{"id": "a", "employee_range__c": "1 - 99", "isdeleted": "False", **LIVE}, {"id": "b", "num_employees__c": "7", "industry": "Food", "isdeleted": "False", **LIVE}],
        startups=[{"crm_account_id": "b"}, {"crm_account_id": None}],
        smb_startups=[{"crm_account_id": "c"}],
    )


def today_of(t):
    yesterday = yesterday_in("UTC", F.lit(datetime(2019, 4, 1)).cast("timestamp_ntz"))
    return plans.accounts_today(t, SNAP, F.lit(date(2019, 4, 1)), yesterday), yesterday


def test_smb_accounts_today(smb):
    got = {r["crm_account_id"]: r for r in today_of(smb)[0].collect()}
    assert set(got) == {"a", "b"}  # no revenue, no region
    a, b = got["a"], got["b"]
    assert (a["business_unit"], a["sales_model"], a["industry"]) == ("BU", "Unknown", "Unknown")
    assert (a["term"], a["sub_arr_band"], a["customer_type"]) == ("Annual", "B. $1-2K", "Support-only")
    assert (a["paid_agents_today"], a["paid_core_agents_at_win"], a["agent_diff"]) == (1000, 5, 995)
    assert a["support_plan_now"] == "Support Enterprise,Support Team"
    assert a["support_plan_win_to_now"] == "Support Team to Support Enterprise,Support Team"
    assert a["cust_type_win_to_now"] == "Support-only to Support-only"
    assert (a["startup_account"], b["startup_account"]) == (None, "b")
    assert (b["business_unit"], b["employee_size_granular"], b["sub_arr_band"]) == ("Unknown", "7", "S. $300K+")
    # won before revenue history: nothing is known at win, starter seats never count
    assert (b["customer_type"], b["customer_type_at_win"], b["cust_type_win_to_now"]) == ("Starter-only", None, None)
    assert (b["support_plan_at_win"], b["paid_agents_today"], b["agent_change_pct"]) == ("", None, None)
    assert (a["employee_segment_rollup"], a["age_days"], a["age_months"]) == ("SMB", 1096, 36)


def scans_of_revenue(report, t, spark, path) -> int:
    """How often the report's plan reads the revenue lines, the only input that is stored in files."""
    t["revenue_lines"].write.parquet(path)
    stored = t.replaced(revenue_lines=spark.read.parquet(path))
    text = report(stored)._jdf.queryExecution().optimizedPlan().toString()
    return len([line for line in text.splitlines() if "Relation [" in line and "parquet" in line])


def test_reports_share_their_reads_of_revenue(smb, midmarket, spark, tmp_path):
    assert scans_of_revenue(lambda t: today_of(t)[0], smb, spark, f"{tmp_path}/smb") <= 4
    assert scans_of_revenue(plans.accounts_granular, midmarket, spark, f"{tmp_path}/mm") <= 3


def test_revenue_at_win_is_cut_before_it_is_summed(smb, spark, tmp_path):
    """Of the days of an account one is wanted: the others are dropped where they are read, below the sum."""
    smb["revenue_lines"].write.parquet(f"{tmp_path}/lines")
    lines = spark.read.parquet(f"{tmp_path}/lines")
    summed = lines.groupBy("crm_account_id", "mrr_date").agg(
        F.lit("AMER").alias("crm_owner_region_clean"), F.sum("net_arr_usd").alias("net_arr_usd")
    )
    today, yesterday = today_of(smb)
    report = plans.accounts_at_win(smb.replaced(smb_accounts=today, revenue_by_account=summed), yesterday)
    text = report._jdf.queryExecution().optimizedPlan().toString().splitlines()
    (read,) = [n for n, row in enumerate(text) if "Relation [" in row and "parquet" in row]
    (total,) = [n for n, row in enumerate(text) if "sum(net_arr_usd" in row and n < read][-1:]
    assert "getbit" in "".join(text[total + 1 : read])


def test_two_support_lines_give_two_rows(tables):
    """Each support line has its own plan list, at win and now; without any, the plan is empty."""
    lines = [
        line("a", SNAP, "Support", "Elite", 1),
        line("a", SNAP, "Support", "Team", 1, charge="p2"),
        line("a", SNAP, "Support Classic", "Team", 1, charge="p3"),
        line("a", SNAP, "Chat", "Lite", 1, charge="p4"),
        line("b", SNAP, "Chat", "Lite", 1),
    ]
    from wintide.plans.smb import paid_products, product_labels

    t = tables(revenue_lines=lines)
    got = {r["crm_account_id"]: r for r in product_labels(paid_products(t["revenue_lines"])).collect()}
    assert got["b"]["support_plans"] == []
    found = sorted(got["a"]["support_plans"])
    assert len(found) == 2 and all(found) and "," in "".join(found)


def test_smb_chain_keeps_accounts_without_expansion(smb):
    today, yesterday = today_of(smb)
    at_win = plans.accounts_at_win(smb.replaced(smb_accounts=today), yesterday)
    got = {r["crm_account_id"]: r for r in at_win.collect()}
    assert set(got) == {"a", "c"}
    assert (got["a"]["active_account"], got["a"]["churn_account"]) == ("a", None)
    assert (got["c"]["active_account"], got["c"]["churn_account"], got["c"]["startup_account"]) == (None, "c", "c")
    assert (got["c"]["customer_type_now"], got["c"]["primary_arr_band_at_win"]) == ("Churned", "n/a")
    assert got["c"]["support_plan_win_to_now"] == " to Churned"
    assert (got["a"]["win_year"], got["a"]["win_yyyyqq"]) == (2016, "2016Q1")


def test_expansions_need_a_first_event_after_the_win(tables, frame):
    accounts = frame("crm_account_id string, account_win_date date", [("a", WIN), ("same", WIN), ("none", WIN), ("unlisted", WIN)])
    deals = [
        opportunity("a", "o1", date(2016, 5, 1), "Agent Adds", 10.0),
        opportunity("a", "o1", date(2016, 5, 1), "Agent Adds", 5.0),
        opportunity("a", "o2", date(2016, 6, 1), "Temporary Agents", 7.0),
        opportunity("a", "o3", date(2016, 7, 1), "Churn", -99.0),
        opportunity("a", "o4", date(2016, 7, 1), "Plan Shift", 99.0, stage_name="01 - Open"),
        opportunity("a", "o5", date(2016, 7, 1), "Plan Shift", 99.0, type="New Business"),
        opportunity("same", "o6", WIN, "Plan Shift", 1.0),
        opportunity("unlisted", "o7", date(2017, 3, 31), "Plan Shift", None),
    ]
    t = tables(
        {"smb_accounts_at_win": accounts},
        opportunities=deals,
        expansion_accounts=[{"crm_account_id": "a"}, {"crm_account_id": "none"}],
    )
    got = {r["crm_account_id"]: r for r in plans.account_expansions(t).collect()}
    assert set(got) == {"a", "same", "none", "unlisted"}
    a = got["a"]
    assert (a["exp_account"], a["days_to_first_expansion"], a["months_to_first_expansion"]) == ("a", 31, 2)
    assert (a["first_expansion_arr"], a["last_expansion_arr"], a["num_expansions"]) == (15.0, 7.0, 2)
    assert (a["types_of_exp"], a["account_exp_type"]) == ("Agent Adds,Temporary Agents", "Agent Expansion Only")
    assert (a["total_agent_expansions"], a["total_plan_shifts"], a["total_exp_arr"]) == (2, 0, 22.0)
    assert (got["same"]["num_expansions"], got["none"]["exp_account"]) == (None, "none")
    assert got["none"]["days_to_first_expansion"] is None
    # expanded, but not on the list: history without elapsed time; an empty amount counts as zero
    assert (got["unlisted"]["exp_account"], got["unlisted"]["days_to_first_expansion"]) == (None, None)
    assert (got["unlisted"]["first_expansion_arr"], got["unlisted"]["account_exp_type"]) == (0.0, "Plan Shift Only")


def cohort_row(account, **more):
    return {"crm_account_id": account, "mrr_date": SNAP, "day_type": "max", "crm_owner_region_clean": "AMER", **more}


def age_row(account, **more):
    return {"crm_account_id": account, "the_date": SNAP, "win_date": WIN, "win_year_quarter": "2016Q1", "win_year": "2016", **more}


@pytest.fixture
def midmarket(tables):
    return tables(
        cohort=[
            cohort_row("a", market_segment="Ent", net_arr_usd_at_win=5.0),
            cohort_row("b"),
            cohort_row("c", crm_owner_region_clean=None),
            cohort_row("d", day_type="qtr"),
        ],
        customer_age=[age_row("a"), age_row("b", churn_date=date(2019, 1, 1))],
        revenue_lines=[
            line("a", WIN, "Support", "Team", 1),
            line("a", SNAP, "Support", "Team", 600),
            line("b", date(2018, 12, 31), "Chat", "Team", 20),
            line("b", WIN, "Support", "Premier", 2),
        ],
        product_dim=[{"productrateplancharge_id": "p1", "enterpriselicense_ind": "N", "product_type_derived": "Base", **LIVE}],
        product_plan_matrix=[{"product_plan": "Team", "plan_type": 2}],
        calendar=[day_row(SNAP), day_row(date(2019, 1, 1))],
        engagement=[
            {"run_at": SNAP, "crm_account_id": "a", "product_combo": "Support", "is_engaged_support": 1, "is_engaged_chat": 1, "is_engaged_talk": 0, "is_engaged_guide": 0},
            {"run_at": SNAP, "crm_account_id": "b", "product_combo": "No Paid Products"},
        ],
        crm_accounts=[
            {"id": "a", "ownerid": "u1", "employee_range__c": "big", **LIVE},
            {"id": "b", "ownerid": None, "num_employees__c": "12", **LIVE},
        ],
        crm_users=[{"id": "u1", "userroleid": "r1", **LIVE}],
        crm_roles=[{"id": "r1", "name": "Role", **LIVE}],
        role_attributes=[{"role_label__c": "Role", "vp_team__c": "VP", "dir_team__c": "Dir", **LIVE}],
        employee_mapping=[{"employee_range": "big", "employee_range_band": "100+", "market_segment": "MM"}],
        instances_raw=[{"account_id": 1}, {"account_id": 2}],
        customer_dim=[{"crm_account_id": "b", "instance_ref": "2.0", "billing_batch": "Batch13", **LIVE}, {"crm_account_id": "a", "instance_ref": "1.0", "billing_batch": "Batch1", **LIVE}],
        billing_accounts=[{"instance_ref": "2.0", "dw_curr_ind": "Y"}, {"instance_ref": "junk", "accounttype__c": "Fraudulent", "dw_curr_ind": "Y"}, {"instance_ref": "1", "dw_curr_ind": "Y"}],
    )


@pytest.mark.parametrize("slice_months", [None, 12])
def test_accounts_granular(midmarket, slice_months):
    got = {r["crm_account_id"]: r for r in plans.accounts_granular(midmarket, slice_months=slice_months).collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert len(a.asDict()) == 51
    assert (a["paid_agents_at_win"], a["agent_band_at_win"], a["paid_agents_today"], a["agent_band"]) == (1, "1", 600, "500+")
    assert (a["region_vp"], a["subregion_dir"], a["employee_range_band"]) == ("VP", "Dir", "100+")
    assert (a["engaged_flag"], a["num_engaged_products"], a["active_status"]) == ("Engaged", 2, "Customer")
    assert (a["fraud_flag"], a["market_segment"], a["market_segment_at_win"]) == ("Not Fraudulent", "Ent", "SMB")
    # churned: state of the last active day, premier plan at win, no owner, no usage row
    assert (b["product_combo"], b["max_support_plan_at_win"], b["active_status"]) == ("Chat", 5, "Churned")
    assert (b["region_vp"], b["employee_size"], b["employee_range_band"]) == (None, "12", "1 - 99")
    assert (b["engaged_flag"], b["fraud_flag"], b["net_arr_usd"]) == (None, "Fraudulent", None)


@pytest.fixture
def midmarket_chain(midmarket):
    deals = [
        opportunity("a", "o1", date(2016, 4, 30), "Agent Adds", 10.0),  # day 30
        opportunity("a", "o2", date(2016, 5, 1), "Add Product", 20.0),  # day 31
        opportunity("a", "o3", date(2016, 6, 1), "New Product", 40.0),
    ]
    frame = midmarket["cohort"].sparkSession.createDataFrame
    t = midmarket.replaced(opportunities=frame([tuple(d[f] for f in parse_schema(SCHEMAS["opportunities"]).fieldNames()) for d in deals], parse_schema(SCHEMAS["opportunities"])))
    t = t.replaced(mm_accounts=plans.accounts_granular(t), mm_accounts_at_quarter=plans.accounts_granular(t, with_win=True))
    return t.replaced(mm_expansions=plans.expansions_granular(t), mm_expansions_by_type=plans.expansions_by_type(t, date(2019, 9, 30)))


def test_expansions_granular(midmarket_chain):
    got = {r["crm_account_id"]: r for r in midmarket_chain["mm_expansions"].collect()}
    assert (got["a"]["exp_account"], got["a"]["days_to_first_expansion"], got["a"]["num_expansions"]) == ("a", 30, 3)
    assert (got["a"]["total_product_expansions"], got["a"]["product_exp_arr"], got["a"]["total_exp_arr"]) == (2, 60.0, 70.0)
    assert (got["b"]["exp_account"], got["b"]["account_win_date"], got["b"]["total_exp_arr"]) == (None, None, None)


def test_expansions_by_type_gives_two_firsts_for_two_raw_types(midmarket_chain):
    out = midmarket_chain["mm_expansions_by_type"]
    assert rows_of(out, "crm_account_id", "first_expansion_type_grouped", "first_expansion_arr", "total_exp_arr_by_type", "total_exp_by_type") == [
        ("a", "Add Product", 20.0, 60.0, 2),
        ("a", "Add Product", 40.0, 60.0, 2),
        ("a", "Agent Add", 10.0, 10.0, 1),
    ]  # the fraudulent account is left out
    assert {r["age_months"] for r in out.collect()} == {36}


def test_expansion_windows_by_cohort(midmarket_chain):
    out = plans.expansion_windows(midmarket_chain, F.lit(date(2016, 5, 30))).collect()
    assert len(out) == 1
    assert (out[0]["exp_arr_30d"], out[0]["exp_30d"]) == (10.0, 1)
    assert (out[0]["exp_arr_60d"], out[0]["exp_60d"]) == (20.0, 1)
    assert (out[0]["exp_arr_90d"], out[0]["exp_arr_360d"]) == (None, None)
    assert "exp_arr_390d" not in out[0].asDict()


def test_instance_months_lists_each_instance_once(midmarket_chain, frame):
    rows = [(7, "a", "Customer", "Plus"), (7, "a", "Customer", "Plus"), (8, "a", "Trial", "Plus"), (9, "b", "Customer", "Plus")]
    instances = frame("account_id bigint, sfdc_crm_id string, derived_account_type string, plan_name string", rows)
    t = midmarket_chain.replaced(instances=instances)
    out = plans.instance_months(t, F.lit(date(2019, 4, 1)))
    assert rows_of(out, "account_id", "support_plan_grouped", "post_1mo", "post_12mo") == [(7, "Professional", date(2016, 4, 30), date(2017, 3, 31))]
    assert plans.instance_months(t, F.lit(date(2017, 3, 31))).count() == 0


def test_leads_to_accounts(midmarket_chain, tables):
    def lead(number, account, mql, amount, **more):
        return {
            "id": number, "converted_accountid": account, "mql": mql, "total_booking_arr_usd": amount, "type": "New Business",
            "opportunity_stage_name": "07 - Closed", "yyyyqq_created": "2018Q3", "derived_source_granular": "Suite Trial",
            "created_date": datetime(2018, 7, 1), "opportunity_close_date": datetime(2018, 7, 11), **more,
        }

    leads = tables(leads=[
        lead("l1", "a", 1, 5.0), lead("l2", "a", None, 7.0), lead("l3", "b", 1, 9.0), lead("l4", None, 1, 9.0),
        lead("l5", "a", 1, 9.0, yyyyqq_created="2019Q3"), lead("l6", "a", 1, 9.0, type="Expansion"),
    ])["leads"]
    t = midmarket_chain.replaced(leads=leads)
    won = {r["lead_id"]: r for r in plans.won_leads(t).collect()}
    assert set(won) == {"l1", "l2", "l3", "l4"}
    assert (won["l1"]["lead_to_win_days"], won["l1"]["mql_to_win_days"], won["l2"]["mql_flag"]) == (10, None, None)
    out = plans.leads_to_accounts(t)
    assert rows_of(out, "accounts", "mqls", "new_biz_bookings", "arr_at_win", "arr_today") == [(1, 1, 12.0, 10.0, 200.0)]


def instance(number, kind="Customer", **more):
    return {"account_id": number, "sfdc_crm_id": f"c{number}", "derived_account_type": kind, "latest_run_at": SNAP, "cust_owner_email": "own@x", "is_trial": 0, "billing_id": "B", **more}


def agent(account, number, email, **more):
    return {"account_id": account, "run_at": SNAP, "agent_id": number, "agent_email": email, "agent_name": "Ann Lee", "agent_type": "Admin", "is_active": 1, "locale_id": 1, **more}


@pytest.fixture
def product(tables):
    def chat(number, day, **more):
        return {"instance_id": number, "chat_account_id": 100 + number, "chat_number": 200 + number, "create_date": day, **more}

    return tables(
        instances=[
            instance(1),
            instance(2, "Trial", is_trial=1, trial_expires_on=date(2019, 4, 11)),
            instance(3, "Trial - expired", trial_expires_on=date(2018, 1, 1)),
            instance(4, "Trial - expired", trial_expires_on=date(2019, 1, 1)),
            instance(5, "Churned"),
            instance(None),
        ],
        agents=[
            agent(1, 11, "own@x"),
            agent(1, 12, None),
            agent(1, 13, "z", run_at=WIN),
            agent(2, 21, "z", is_active=0),
            agent(4, 41, "z", agent_type="Agent"),
        ],
        locales=[{"locale_id": 1, "locale": "en", "name": "English"}],
        roles=[{"account_id": 1, "run_at": SNAP, "num_users": 9, "num_admins": 0, "num_agents": 4}, {"account_id": 2, "run_at": WIN, "num_users": 1}],
        explore=[{"account_id": 1, "run_at": SNAP, "state": "on"}, {"account_id": 2, "run_at": WIN, "state": "old"}],
        combo_metrics=[{"instance_ref": "1.0", "support_agents": 6}, {"instance_ref": "n/a", "support_agents": 7}],
        chat_accounts=[chat(1, date(2019, 1, 1)), chat(1, date(2018, 1, 1), chat_plan_name="old"), chat(2, SNAP, chat_number=None)],
        chat_settings=[
            {"id": 1, "run_at": SNAP, "create_date": SNAP, "routing_skill": "now", "forms_pre_chat_form_required": "yes"},
            {"id": 201, "run_at": WIN, "create_date": WIN, "routing_skill": "legacy", "operating_hours": "9-5"},
        ],
        chat_stats_legacy=[{"account_id": 201, "timestamp": datetime(2019, 1, 1), "conversations": 8}, {"account_id": 202, "timestamp": datetime(2019, 1, 1), "conversations": 3}],
        instance_lifecycle=[{"instance_id": 1, "chat_account_id": 101, "chat_number": 201}, {"instance_id": 2, "chat_number": 202}, {"instance_id": 4}],
        guide=[{"account_id": 1, "plan_name": "pro"}, {"account_id": None}],
        voice=[{"account_id": 1, "run_at": SNAP, "is_active": 1}],
        knowledge_capture=[{"account_id": 1, "run_at": SNAP, "total_events_28": n} for n in (0, 3)],
        plan_shift_scores=[{"instance_ref": "1", "date_scored": SNAP, "probability": 0.25}, {"instance_ref": "1", "date_scored": WIN, "probability": 0.5}],
        churn_scores=[{"crm_account_id": "c1", "date_scored": SNAP, "churn_probability": 0.5}],
        crm_accounts=[{"id": "c1", "name": "Company", **LIVE}],
        customer_dim=[{"crm_account_id": "c1", "sales_model": m, **LIVE} for m in ("b", "a")],
    )


def test_account_360(product):
    out = plans.account_360_report(product, F.lit(date(2019, 4, 1)), date(2019, 1, 1))
    got = {r["agent_id"]: r for r in out.collect()}
    assert set(got) == {11, 12}
    a, b = got[11], got[12]
    assert (a["derived_agent_type"], b["derived_agent_type"], a["agent_language"]) == ("Owner", "Admin", "en")
    assert (a["unique_identifier"], b["unique_identifier"]) == ("1own@x", "1")
    assert (a["explore_product_flag"], a["chat_product_flag"], a["guide_product_flag"], a["talk_product_flag"]) == ("1",) * 4
    assert (a["chat_skill_routing_flag"], a["chat_operating_hours_flag"], a["chat_prechat_form_flag"]) == ("now", "9-5", "yes")
    assert (a["chat_plan_name"], a["chat_web_widget_embedded_flag"], a["guide_knowledge_capture_flag"]) == (None, "not embedded", 1)
    assert (a["plan_shift_probability"], a["no_plan_shift_probability"], a["churn_probability"]) == (0.25, 0.75, 0.5)
    assert (a["company"], a["sales_model"], a["support_agents"], a["num_users"]) == ("Company", "a", 6, 9)


def test_account_overview_keeps_instances_without_admin(product):
    out = plans.account_overview_report(product, F.lit(date(2019, 4, 1)), date(2019, 1, 1))
    got = {(r["account_id"], r["agent_id"]): r for r in out.collect()}
    assert set(got) == {(1, 11), (1, 12), (2, None), (4, None)}
    trial = got[2, None]
    assert (trial["support_days_left_in_trial"], trial["derived_agent_type"], trial["run_at"]) == (10, None, None)
    assert (trial["explore_product_flag"], trial["num_users"]) == ("0", None)
    assert (got[1, 11]["chat_conversations_in_last_day"], trial["chat_conversations_in_last_day"]) == (8, 3)


def test_cross_sell_targets(tables):
    def score(account, rank, region="AMER", **more):
        return {"crm_account_id": account, "region_vp": region, "subregion_dir": "Velocity 1", "product_mix_at_cross_sell": "Support-Only", "gb_rank": rank, **more}

    t = tables(
        cross_sell_scores=[
            score("a", 1), score("b", 2), score("c", 2), score("d", 3), score("e", 0, product_mix_at_cross_sell="Suite"),
            score("f", 0, subregion_dir="Field"), score("g", 1, "EMEA"), score("h", 0, product_mix_at_cross_sell=None),
        ],
        crm_contacts=[{"id": f"k{a}", "accountid": a, "email": "ann", "isdeleted": "False", "dw_curr_ind": "Y"} for a in "abcdg"],
        agents=[agent(1, 1, "ann"), agent(2, 2, "ann"), agent(3, 3, "ann", is_active=0, agent_name="Off")],
        crm_accounts=[{"id": "a", "ownerid": "u1", "isdeleted": "False", **LIVE}],
        crm_users=[{"id": "u1", "name": "Owner", **LIVE}],
    )
    out = plans.cross_sell_targets(t, {"AMER": 2, "EMEA": 5})
    assert rows_of(out, "crm_account_id", "sfdc_account_owner", "agent_name", "sfdc_contact_id") == [
        ("a", "Owner", "Ann Lee", "ka"),
        ("b", None, "Ann Lee", "kb"),
        ("c", None, "Ann Lee", "kc"),
    ]
    assert plans.cross_sell_targets(t, {"EMEA": 5}, short="all").count() == 1


def test_product_targets_filter(tables):
    lines, ages, customers, instances, agents, tickets = [], [], [], [], [], []
    offers = {1: "Suite Team", 2: "Guide Professional", 3: "Support Team", 4: "Support Team", 5: "Support Team", 6: "Guide Team"}
    for n, offer in offers.items():
        product = offer.split()[0]
        lines.append(line(f"c{n}", SNAP, product, offer.split()[1], 5))
        ages.append({"crm_account_id": f"c{n}", "the_date": SNAP, "win_date": WIN, "age_years": 3.5, "suite_date": SNAP})
        customers.append({"crm_account_id": f"c{n}", "billing_account_id": f"Bc{n}", "instance_ref": f"{n}.0", **LIVE})
        instances.append(instance(n))
        agents += [agent(n, n * 10, "own@x"), agent(n, n * 10 + 1, "other", is_active=0)]
    for n in (3, 4):
        tickets.append({"account_id": n, "run_at": datetime(2019, 1, 1), "new_channel_facebook_msg": 1, "new_channel_facebook_post": 0})
    tickets.append({"account_id": 5, "run_at": datetime(2017, 1, 1), "new_channel_facebook_msg": 1, "new_channel_facebook_post": 0})
    # account 4 has a social line that still pays; account 3's newest social line is empty
    lines += [line("c4", SNAP, "Support", "Social", 1), line("c3", WIN, "Support", "Social", 1), line("c3", SNAP, "Support", "Social", 1, arr=0.0)]
    t = tables(
        revenue_lines=lines, customer_age_view=ages, customer_dim=customers, instances=instances, agents=agents, tickets=tickets,
        product_dim=[{"productrateplancharge_id": "p1", **LIVE}],
        product_plan_matrix=[{"product_plan": "Team", "plan_type": 4}, {"product_plan": "Professional", "plan_type": 3}],
        locales=[{"locale_id": 1, "name": "English"}],
    )
    got = {r["crm_account_id"]: r for r in plans.product_targets(t, F.lit(date(2019, 4, 1))).collect()}
    assert set(got) == {"c1", "c2", "c3"}
    assert (got["c1"]["max_suite_plan"], got["c2"]["max_guide_plan"], got["c3"]["max_guide_plan"]) == ("Suite Enterprise", "Guide Professional", "N/A")
    assert (got["c3"]["facebook_usage_account_flag"], got["c3"]["social_sku"], got["c1"]["facebook_usage_account_flag"]) == (1, 0, 0)
    assert (got["c1"]["first_name"], got["c1"]["last_name"], got["c1"]["agent_type"]) == ("Ann", "Lee", "Owner")
    assert (got["c1"]["age_range_band"], got["c1"]["suite_win_year_mo"], got["c1"]["market_segment"]) == ("3-4 yr", "2019-03", "SMB")
