from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from wintide.operators import (
    any_like,
    classify_set,
    engagement_score,
    more_than,
    only,
    preaggregate_join,
    product_rollup,
    trailing_sum,
    typed_metrics,
    within,
)

RULES = [
    ("Starter", only("offer", "Support Starter")),
    ("Suite", any_like("line", "%Suite%")),
    ("Support", only("line", "Support")),
    ("Pair", within("line", ["Chat", "Talk"])),
    ("Multi", more_than("line", 1)),
]


def test_classify_set_takes_the_first_matching_rule(frame):
    df = frame(
        "k int, line string, offer string",
        [
            (1, "Support", "Support Starter"),
            (2, "Suite", "Suite Pro"),
            (2, "Chat", "Chat Team"),
            (3, "Support", "Support Team"),
            (3, "Support", None),
            (4, "Chat", "x"),
            (4, "Talk", "y"),
            (5, "Guide", "x"),
            (5, "Talk", "y"),
            (6, "Guide", "z"),
            (7, None, None),
        ],
    )
    out = classify_set(df, ["k"], ["line", "offer"], RULES, "Other", "mix", [F.count(F.lit(1)).alias("n")])
    assert rows_of(out, "k", "mix") == [
        (1, "Starter"),
        (2, "Suite"),
        (3, "Support"),
        (4, "Pair"),
        (5, "Multi"),
        (6, "Other"),
        (7, "Other"),
    ]


def test_typed_metrics_against_brute_force(frame):
    rng = random.Random(11)
    rows = [
        (
            rng.choice(["hot", "hot", "a", "b"]),
            rng.choice([None, *[f"o{i}" for i in range(12)]]),
            rng.choice(["x", "y", "z", None]),
            rng.choice([None, 1.0, 2.0, 5.0]),
        )
        for _ in range(300)
    ]
    groups = {"xy": ["x", "y"], "z": ["z"]}
    out = typed_metrics(
        frame("k string, id string, type string, amt double", rows),
        ["k"],
        "id",
        "type",
        "amt",
        groups,
        count_name="n_{}",
        sum_name="s_{}",
    )
    got = {r["k"]: r for r in out.collect()}
    for key in ("hot", "a", "b"):
        mine = [r for r in rows if r[0] == key]
        assert got[key]["num_events"] == len({r[1] for r in mine if r[1]})
        assert got[key]["total_amount"] == sum(r[3] or 0 for r in mine)
        for name, values in groups.items():
            hits = [r for r in mine if r[2] in values]
            assert got[key][f"n_{name}"] == len({r[1] for r in hits if r[1]})
            assert got[key][f"s_{name}"] == sum(r[3] or 0 for r in hits)


@pytest.fixture
def rolled(frame):
    lines = frame(
        "mrr_date date, crm_account_id string, product_line string, product_offering string, product_plan string,"
        " base_product_plan string, productrateplancharge_id string, baseplan_quantity bigint, net_arr double",
        [
            (date(2020, 1, 1), "a", "Support", "Support Enterprise", "Enterprise", None, "p1", 10, 5.0),
            (date(2020, 1, 1), "a", "Support", "Support Team", "x", "Team", "p1", 30, 5.0),
            (date(2020, 1, 1), "a", "Chat", "Chat Answer Bot", "Team", None, "p2", 7, 5.0),
            (date(2020, 1, 1), "a", "Chat", "Chat Add", "Team", None, "p2", 1, 5.0),
            (date(2020, 1, 1), "a", "Chat", "Chat Free", "Team", None, "p1", 99, 0.0),
            (date(2020, 1, 1), "b", "Talk", "Talk Team", "Team", None, "ela", 3, 5.0),
            (date(2020, 1, 1), "c", "Guide", "Guide Premier", "Team", None, "p1", 3, 5.0),
            (date(2020, 1, 1), "d", "Talk", "Talk Partner Edition", "Team", None, "p1", 3, 5.0),
            (date(2020, 1, 1), "e", "Talk", "Talk Team", "Team", None, "unknown", 3, 5.0),
            (date(2020, 1, 1), None, "Talk", "Talk Team", "Team", None, "p1", 3, 5.0),
        ],
    )
    products = frame(
        "productrateplancharge_id string, product_type_derived string, enterpriselicense_ind string",
        [("p1", "Base", "N"), ("p2", "Addon", "N"), ("ela", "Base", "Y")],
    )
    plans = frame("product_plan string, plan_type int", [("Team", 2), ("Enterprise", 4)])
    return {r["crm_account_id"]: r.asDict() for r in product_rollup(lines, products, plans).collect()}


def test_product_rollup_levels(rolled):
    assert set(rolled) == {"a", "b", "c"}
    a = rolled["a"]
    assert (a["product_combo"], a["base_product_count"], a["all_product_count"]) == ("Chat,Support", 2, 3)
    assert (a["paid_agents"], a["paid_support_agents"], a["paid_support_enterprise_agents"]) == (40, 40, 10)
    assert (a["max_support_plan"], a["avg_support_plan"]) == (4, 3.0)  # (4*10 + 2*30) / 40 = 2.5


def test_product_rollup_licence_and_premier(rolled):
    assert (rolled["b"]["paid_agents"], rolled["b"]["max_support_plan"]) == (1000, 5)
    assert (rolled["c"]["paid_agents"], rolled["c"]["avg_support_plan"]) == (0, 5.0)


def test_trailing_sum_bounds(frame):
    df = frame("k int, at timestamp, n int", [(1, datetime(2019, 5, 1), 1), (1, datetime(2019, 4, 30, 23), 5), (1, datetime(2020, 4, 1), None)])
    out = trailing_sum(df, "k", "at", {"n": F.col("n")}, F.lit(date(2020, 5, 1)))
    assert rows_of(out, "k", "n") == [(1, 1)]


def test_engagement_score_with_missing_flags(frame):
    cols = ", ".join(f"is_{kind}_{p} int" for kind in ("paying", "activated", "engaged") for p in ("s", "g"))
    df = frame(f"id int, {cols}", [(1, 1, 1, 1, 0, 1, 1), (2, 1, None, None, 1, None, 1), (3, 0, 0, 1, 1, 0, 0)])
    out = engagement_score(df, ["s", "g"])
    names = ["core_products_paid", "core_products_activated", "num_engaged_products", "engaged_flag"]
    assert rows_of(out, "id", *names) == [
        (1, 2, 1, 2, "Engaged"),
        (2, 1, 0, 0, "Not Engaged"),
        (3, 0, 0, 0, "Not Engaged"),
    ]


def test_preaggregate_join_keeps_the_grain(frame):
    df = frame("id int", [(1,), (2,)])
    feature = frame("fid int, v int", [(1, 3), (1, 9), (3, 1)])
    out = preaggregate_join(df, feature, [("id", "fid")], [F.max("v").alias("top")])
    assert rows_of(out, "id", "top") == [(1, 9), (2, None)]
