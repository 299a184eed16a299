from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from wintide.operators import (
    cohort_rollup,
    funnel_durations,
    funnel_rollup,
    milestones,
    month_offsets,
    tenure_windows,
)

START = date(2020, 1, 1)


def test_milestones_stop_at_as_of(frame):
    df = frame("id int, win date", [(1, START), (2, None)])
    out = milestones(df, "win", [30, 60], F.lit(START + timedelta(days=59)))
    assert rows_of(out, "id", "date_30", "date_60") == [(1, START + timedelta(days=30), None), (2, None, None)]


def test_window_bounds(frame):
    accounts = frame("id string, win date", [("a", START), ("b", START), ("c", None)])
    on = lambda n: START + timedelta(days=n)
    events = frame(
        "id string, d date, amt double",
        [("a", on(-9), 1.0), ("a", on(30), 2.0), ("a", on(31), 4.0), ("a", on(60), 8.0), ("a", on(61), 16.0), ("c", on(1), 1.0), ("a", None, 32.0)],
    )
    out = tenure_windows(accounts, events, "id", "win", "d", "amt", F.lit(on(89)), 30, 3, "s{}", "n{}")
    assert rows_of(out, "id", "s30", "n30", "s60", "n60", "s90", "n90") == [
        ("a", 3.0, 2, 12.0, 2, None, None),  # the third window is not reached yet
        ("b", None, None, None, None, None, None),
        ("c", None, None, None, None, None, None),
    ]


def test_windows_cover_every_event_once(frame):
    rng = random.Random(5)
    accounts = [(f"k{i}", START + timedelta(days=rng.randrange(100))) for i in range(10)]
    events = [
        ("k0" if i % 3 == 0 else f"k{rng.randrange(10)}", START + timedelta(days=rng.randrange(-50, 600)), float(i))
        for i in range(500)
    ]
    as_of = START + timedelta(days=330)
    out = tenure_windows(
        frame("id string, win date", accounts), frame("id string, d date, amt double", events),
        "id", "win", "d", "amt", F.lit(as_of), 30, 15, "s{}", "n{}",
    )
    got = {r["id"]: r.asDict() for r in out.collect()}
    for key, win in accounts:
        for n in range(1, 16):
            end = win + timedelta(days=30 * n)
            low = date.min if n == 1 else end - timedelta(days=30)
            hits = [a for k, d, a in events if k == key and low < d <= end] if as_of >= end else []
            assert got[key][f"s{30 * n}"] == (sum(hits) if hits else None)
            assert got[key][f"n{30 * n}"] == (len(hits) if hits else None)


def test_cohort_rollup_keeps_null_for_empty(frame):
    df = frame("c string, m double", [("x", 1.0), ("x", None), ("y", None), (None, 2.0)])
    assert rows_of(cohort_rollup(df, ["c"], ["m"]), "c", "m") == [("x", 1.0), ("y", None), (None, 2.0)]


def test_month_offsets_clamp_and_mature(frame):
    df = frame("id int, win date", [(1, date(2020, 1, 31)), (2, date(2020, 2, 29)), (3, date(2021, 1, 1)), (4, None)])
    out = month_offsets(df, "win", 12, F.lit(date(2021, 3, 1)))
    assert rows_of(out, "id", "post_1mo", "post_12mo") == [
        (1, date(2020, 2, 29), date(2021, 1, 31)),
        (2, date(2020, 3, 29), date(2021, 2, 28)),
    ]


def test_funnel_durations(frame):
    df = frame("a date, b date", [(date(2020, 1, 1), date(2020, 1, 11)), (None, date(2020, 1, 1))])
    assert rows_of(funnel_durations(df, {"days": ("b", "a")}), "days") == [(10,), (None,)]


@pytest.mark.parametrize("identity", [(), ("note",)])
def test_funnel_rollup_against_join_first(frame, identity):
    rng = random.Random(2)
    leads = [(f"a{0 if i % 3 == 0 else rng.randrange(6)}", rng.choice("xy"), rng.choice([None, 1, 0]), float(i)) for i in range(90)]
    accounts = [(f"a{i}", "seg" + str(i % 2), 10.0 * i, f"note{n}") for i in range(5) for n in range(2)]
    lead_df = frame("id string, src string, mql int, book double", leads)
    account_df = frame("id string, seg string, arr double, note string", accounts)
    out = funnel_rollup(
        lead_df, account_df, "id", ["src"], ["seg"], {"mqls": "mql", "book": "book"}, {"arr": "arr"}, account_identity=identity
    )
    joined = lead_df.join(account_df.select("id", "seg", "arr", *identity).distinct(), "id")
    expected = joined.groupBy("src", "seg").agg(
        F.count_distinct("id").alias("accounts"), F.sum("mql").alias("mqls"), F.sum("book").alias("book"), F.sum("arr").alias("arr")
    )
    cols = ["src", "seg", "accounts", "mqls", "book", "arr"]
    assert rows_of(out, *cols) == rows_of(expected, *cols)
