"""Inputs that a report reads several times are derived once."""

from __future__ import annotations

from datetime import datetime

import pytest

from checks import domain, reports
from wintide.plans.midmarket import product_states

ROWS = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "AMERICA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N0", 0), (1, "N1", 1)]),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(k, f"c{k}", k % 2, 6000.0, "AUTO") for k in (4, 8, 28)],
    ),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 0, 1.0)]),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(2, "p2", "Brand#3", "SMALL", 3, 1.0), (4, "p4", "Brand#4", "OTHER", 2, 1.0)],
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [
            (10 * k + n, k, "F", 100.0, day, "1-URGENT")
            for k in (4, 8, 28)
            for n, day in enumerate((datetime(2000, 2, 1), datetime(2000, 8, 1), datetime(2001, 8, 1)))
        ],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_tax double, l_returnflag string",
        [(10 * k + n, p, 1, 5.0 + n, 0.05, "N") for k in (4, 8, 28) for n in range(3) for p in (2, 4)],
    ),
    "events": (
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double",
        [(1, datetime(2001, 1, 1), 4, "click", 1.0)],
    ),
}


@pytest.fixture
def folder(frame, tmp_path):
    for name, (ddl, rows) in ROWS.items():
        frame(ddl, rows).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def shown(df) -> list[str]:
    return sorted(str(row) for row in df.collect())


@pytest.mark.parametrize(
    "name",
    [
        "smb_accounts_at_win",
        "smb_account_expansions",
        "smb_accounts_today",
        "product_target_list",
    ],
)
def test_revenue_lines_are_joined_once_in_a_report(spark, folder, monkeypatch, name):
    query = getattr(reports, name)
    kept, plain = [], domain.stage

    def recorded(df, of):
        kept.append(of)
        return plain(df, of)

    monkeypatch.setattr(domain, "stage", recorded)
    out = query(spark, folder)
    assert kept.count("sold") == 1
    # the stored lines stand for the tables they come from
    assert "lineitem.parquet" not in out._jdf.queryExecution().executedPlan().toString()


def test_account_days_are_cut_before_orders_meet_their_lines(spark, folder):
    states = product_states(domain.Domain(spark, folder), reports.HISTORY_FROM)
    text = states._jdf.queryExecution().optimizedPlan().toString().splitlines()
    filters = [n for n, line in enumerate(text) if "getbit" in line]
    # below the filter stand the orders alone: the plan's lines are indented by depth
    below = text[filters[0] + 1 :]
    depth = [len(line) - len(line.lstrip(" :+-|")) for line in text]
    inside = below[: next((n for n, d in enumerate(depth[filters[0] + 1 :]) if d <= depth[filters[0]]), len(below))]
    assert "o_custkey" in text[filters[0]] and not any("Join" in line for line in inside)


def test_stored_inputs_hold_the_same_rows(spark, folder):
    lazy = domain.Domain(spark, folder)
    stored = domain.Domain(spark, folder, reports.REVENUE_STORED)
    for name in ("win_dates", "lifetimes", "revenue_lines", "revenue_by_account"):
        assert stored[name].dtypes == lazy[name].dtypes
        assert shown(stored[name]) == shown(lazy[name]) != []
