from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from tests.conftest import rows_of

from wintide.operators import dominant_value, edge_events, latest_per_key, quota_cut


@pytest.fixture
def log(frame):
    return frame(
        "k string, d date, id int",
        [
            ("a", date(2020, 1, 1), 1),
            ("a", date(2020, 1, 2), 2),
            ("a", date(2020, 1, 2), 3),
            ("a", None, 4),
            ("b", None, 5),
            ("b", None, 6),
            (None, date(2020, 1, 1), 7),
            (None, date(2020, 1, 3), 8),
        ],
    )


def test_latest_with_ties_keeps_all_and_sorts_null_last(log):
    assert rows_of(latest_per_key(log, ["k"], "d", ties="all"), "id") == [(2,), (3,), (5,), (6,), (8,)]


def test_oldest_with_ties_sorts_null_first(log):
    assert rows_of(latest_per_key(log, ["k"], "d", ties="all", newest=False), "id") == [(4,), (5,), (6,), (7,)]


def test_single_row_per_key(log):
    newest = latest_per_key(log, ["k"], "d", tie_breakers=["id"])
    assert rows_of(newest, "id") == [(3,), (6,), (8,)]
    oldest = latest_per_key(log, ["k"], "d", tie_breakers=["id"], newest=False)
    assert rows_of(oldest, "id") == [(4,), (5,), (7,)]


def test_single_row_needs_tie_breakers(log):
    with pytest.raises(ValueError, match="tie_breakers"):
        latest_per_key(log, ["k"], "d")
    with pytest.raises(ValueError, match="ties"):
        latest_per_key(log, ["k"], "d", ties="some")


def test_edge_events_sum_lines_and_break_ties(frame):
    events = frame(
        "k string, d date, opp string, amt double",
        [
            ("a", date(2020, 1, 1), "o2", 5.0),
            ("a", date(2020, 1, 1), "o1", 1.0),
            ("a", date(2020, 1, 1), "o1", 2.0),
            ("a", date(2020, 2, 1), "o3", 7.0),
            ("b", date(2020, 3, 1), "o9", None),
            (None, date(2020, 1, 1), "lost", 1.0),
        ],
    )
    out = edge_events(events, ["k"], "d", ["opp"], "amt")
    got = {r["k"]: r for r in out.collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["first"]["opp"], got["a"]["first"]["amount"]) == ("o1", 3.0)
    assert (got["a"]["last"]["opp"], got["a"]["last"]["amount"]) == ("o3", 7.0)
    assert got["b"]["first"]["amount"] is None
    assert edge_events(events, ["k"], "d", ["opp"], "amt", which=["last"]).columns == ["k", "last"]
    sets = edge_events(events, ["k"], "d", ["opp"], "amt", which=[], value_sets={"opps": "opp"})
    assert rows_of(sets, "k", "opps") == [("a", ["o1", "o2", "o3"]), ("b", ["o9"])]


def test_dominant_value(frame):
    df = frame(
        "k string, term int, w double",
        [("a", 1, 5.0), ("a", 1, 5.0), ("a", 12, 9.0), ("b", 1, 3.0), ("b", 24, 3.0), ("c", None, 9.0), ("c", 1, 1.0), ("d", 6, None)],
    )
    assert rows_of(dominant_value(df, ["k"], "term", "w"), "k", "value") == [("a", 1), ("b", 24), ("c", None), ("d", 6)]


def brute_quota(rows, quotas, short):
    kept = []
    for region, quota in quotas.items():
        mine = sorted({(r[2], r[0]) for r in rows if r[1] == region})
        if len(mine) >= quota:
            cut = mine[quota - 1][0]
            kept += [r for r in rows if r[1] == region and r[2] <= cut]
        elif short == "all":
            kept += [r for r in rows if r[1] == region]
    return sorted(kept, key=str)


@pytest.mark.parametrize("short", ["none", "all"])
@pytest.mark.parametrize("splits, few", [(2, 1), (3, 4), (64, 5), (256, 4096)])
def test_quota_cut_against_brute_force(frame, short, splits, few):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        region = rng.choice(["big", "big", "exact", "small", "unlisted"])
        rows.append((i, region, rng.randrange(40)))
    exact = len([r for r in rows if r[1] == "exact"])
    quotas = {"big": 25, "exact": exact, "small": 10_000}
    df = frame("id int, region string, r int", rows + rows[:50])  # repeated rows count once
    out = quota_cut(df, "region", "r", quotas, ["id"], short, splits, few)
    assert rows_of(out.distinct(), "id", "region", "r") == sorted(
        brute_quota(rows, quotas, short), key=lambda r: [(False, str(v)) for v in r]
    )


def test_quota_cut_ties_at_the_cut_all_pass(frame):
    df = frame("id int, region string, r int", [(i, "x", 1 if i < 2 else 2) for i in range(6)])
    assert quota_cut(df, "region", "r", {"x": 3}, ["id"]).count() == 6


@pytest.mark.parametrize("quota, kept", [(1, 6), (6, 6), (7, 0), (2**62, 0)])
def test_quota_cut_with_equal_ranks(frame, quota, kept):
    df = frame("id int, region string, r int", [(i, "x", 5) for i in range(6)])
    assert quota_cut(df, "region", "r", {"x": quota}, ["id"]).count() == kept


def test_quota_cut_counts_null_ranks_first(frame):
    df = frame("id int, region string, r int", [(1, "x", None), (2, "x", 5), (3, "x", 6)])
    assert rows_of(quota_cut(df, "region", "r", {"x": 2}, ["id"]), "id") == [(2,)]
    assert quota_cut(df, "region", "r", {"x": 1}, ["id"]).count() == 0


@pytest.mark.parametrize("quota", [1, 2, 37, 500, 999, 1000])
def test_quota_cut_narrows_until_few_ranks_are_left(frame, quota):
    """A crowded middle: most ranks lie in a sliver of the whole range, and dates are ranks too."""
    days = [date(1970, 1, 1), *(date(2020, 1, 1) + timedelta(days=n // 3) for n in range(998)), date(9999, 12, 31)]
    df = frame("id int, region string, r date", [(i, "x", d) for i, d in enumerate(days)])
    cut = sorted(days)[quota - 1]
    assert quota_cut(df, "region", "r", {"x": quota}, ["id"], splits=2, few=2).count() == len([d for d in days if d <= cut])


def test_quota_cut_of_nothing(frame):
    df = frame("id int, region string, r int", [])
    assert quota_cut(df, "region", "r", {"x": 1}, ["id"], short="all").count() == 0


def test_quota_cut_neither_ranks_nor_joins(frame):
    df = frame("id int, region string, r int", [(i, "x", i) for i in range(50)])
    text = quota_cut(df, "region", "r", {"x": 9}, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Join" not in text and "Exchange" not in text


def test_quota_cut_checks_arguments(frame):
    df = frame("id int, region string, r int", [(1, "x", 1)])
    with pytest.raises(ValueError, match="splits"):
        quota_cut(df, "region", "r", {"x": 1}, ["id"], splits=1)
    with pytest.raises(ValueError, match="short"):
        quota_cut(df, "region", "r", {"x": 1}, ["id"], short="some")
    with pytest.raises(ValueError, match="quota"):
        quota_cut(df, "region", "r", {}, ["id"])
