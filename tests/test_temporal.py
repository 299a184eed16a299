from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from wintide.operators import (
    as_of_instant,
    current_rows,
    latest_snapshot,
    reporting_dates,
    scd2_as_of,
    snapshot_join,
    state_at,
    with_calendar,
)

DIM = "id string, name string, dw_eff_start timestamp, dw_eff_end timestamp"


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture
def versions(frame):
    return frame(
        DIM,
        [
            ("a", "v1", ts("2018-01-01"), ts("2018-06-01")),
            ("a", "v2", ts("2018-06-01"), ts("2018-12-31")),
            ("b", "w1", ts("2018-03-01"), ts("2018-03-31")),
        ],
    )


@pytest.fixture
def facts(frame):
    return frame(
        "k string, d date",
        [
            ("a", date(2017, 1, 1)),  # before history: moved up to the floor
            ("a", date(2018, 5, 31)),  # plus one day: the shared boundary, both versions
            ("a", date(2018, 7, 1)),
            ("b", date(2018, 5, 1)),  # gap
            ("c", date(2018, 5, 1)),  # unknown key
            ("a", None),
            (None, date(2018, 7, 1)),
        ],
    )


@pytest.mark.parametrize("split", [{}, {"slice_months": 1}, {"slice_months": 6}, {"per_range": 1}])
def test_scd2_as_of_edges(facts, versions, split):
    at = as_of_instant("d", date(2018, 2, 1))
    out = scd2_as_of(facts, versions, [("k", "id")], at, **split)
    assert out.columns == ["k", "d", "name"]
    assert rows_of(out, "k", F.col("d").cast("string"), "name") == sorted(
        [
            ("a", "2017-01-01", "v1"),
            ("a", "2018-05-31", "v1"),
            ("a", "2018-05-31", "v2"),
            ("a", "2018-07-01", "v2"),
            ("b", "2018-05-01", None),
            ("c", "2018-05-01", None),
            ("a", None, None),
            (None, "2018-07-01", None),
        ],
        key=lambda r: [(v is None, str(v)) for v in r],
    )


@pytest.mark.parametrize(
    "split", [{}, *({"slice_months": n} for n in (1, 5, 12)), *({"per_range": n} for n in (1, 3, 20))]
)
def test_scd2_as_of_against_brute_force(frame, split):
    rng = random.Random(7)
    start = datetime(2015, 1, 1)
    dims, probes = [], []
    for i in range(60):
        begin = start + timedelta(days=rng.randrange(900))
        open_ended = rng.random() < 0.3
        end = datetime(9999, 12, 31) if open_ended else begin + timedelta(days=rng.randrange(400))
        dims.append(("hot" if i % 2 else f"k{i % 7}", f"v{i}", begin, end))
    for i in range(200):
        probes.append((i, "hot" if i % 3 else f"k{i % 7}", (start + timedelta(days=rng.randrange(1200))).date()))
    out = scd2_as_of(
        frame("n int, k string, d date", probes),
        frame(DIM, dims),
        [("k", "id")],
        as_of_instant("d", None),
        **split,
    )
    expected = []
    for n, k, d in probes:
        at = datetime(d.year, d.month, d.day) + timedelta(days=1)
        names = [v for key, v, b, e in dims if key == k and b <= at <= e]
        expected += [(n, v) for v in names or [None]]
    assert rows_of(out, "n", "name") == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])


def test_scd2_as_of_by_range_with_odd_versions(frame):
    """Open starts and ends, ends before starts, repeated versions and null keys, as in the plain form."""
    day = [ts(f"2018-01-{n:02d}") for n in range(1, 29)]
    dims = [("a", f"v{n}", day[n], day[min(n + n % 4, 27)]) for n in range(27)]
    dims += [("a", "same", day[3], day[9])] * 3
    dims += [("a", "back", day[9], day[3]), ("a", "no end", day[5], None), ("a", "no start", None, day[5]), (None, "lost", day[0], day[9])]
    probes = [(n, k, d.date()) for n, d in enumerate(day) for k in ("a", "b", None)] + [(99, "a", None)]
    facts, versions, at = frame("n int, k string, d date", probes), frame(DIM, dims), F.col("d").cast("timestamp")
    for how in ("left", "inner"):
        plain, ranged = (
            rows_of(scd2_as_of(facts, versions, [("k", "id")], at, how=how, **split), "n", "k", "name")
            for split in ({}, {"per_range": 2})
        )
        assert ranged == plain and len(plain) > len(probes) / 3
    with pytest.raises(ValueError, match="either"):
        scd2_as_of(facts, versions, [("k", "id")], at, slice_months=1, per_range=1)


def test_current_rows(frame):
    dim = frame("id int, dw_curr_ind string, isdeleted string", [(1, "Y", "False"), (2, "N", "False"), (3, "Y", "True"), (4, None, "False")])
    assert rows_of(current_rows(dim), "id") == [(1,), (3,)]
    assert rows_of(current_rows(dim, not_deleted="isdeleted"), "id") == [(1,)]


def test_latest_snapshot(frame):
    df = frame("k int, run date", [(1, date(2020, 1, 1)), (2, date(2020, 1, 2)), (3, date(2020, 1, 2)), (4, None)])
    assert rows_of(latest_snapshot(df, "run"), "k") == [(2,), (3,)]
    assert latest_snapshot(df.filter("k > 9"), "run").count() == 0
    assert rows_of(latest_snapshot(df, "run", of=df.filter("k = 1")), "k") == [(1,)]


def test_snapshot_join_uses_each_rows_own_run(frame):
    df = frame("id int, run date", [(1, date(2020, 1, 1)), (2, date(2020, 1, 2)), (3, None)])
    snap = frame("id int, day date, v string", [(1, date(2020, 1, 1), "x"), (1, date(2020, 1, 2), "y"), (2, date(2020, 1, 1), "z")])
    assert rows_of(snapshot_join(df, snap, "id", "run", "day"), "id", "v") == [(1, "x"), (2, None), (3, None)]
    assert snapshot_join(df, snap, "id", "run", "day", how="inner").count() == 1


def test_state_at_computed_date(frame):
    df = frame("id int, win date", [(1, date(2010, 1, 1)), (2, date(2020, 1, 2))])
    facts = frame("id int, day date, v string", [(1, date(2014, 1, 1), "floor"), (2, date(2020, 1, 2), "own")])
    at = F.greatest("win", F.lit(date(2014, 1, 1)))
    assert rows_of(state_at(df, facts, "id", at, "day"), "id", "v") == [(1, "floor"), (2, "own")]


def test_calendar_operators(frame):
    calendar = frame(
        "the_date date, fiscal_year int, last_day_of_qtr_ind string",
        [(date(2014, 12, 31), 2014, "Y"), (date(2015, 3, 31), 2015, "Y"), (date(2015, 5, 4), 2015, "N"), (date(2015, 5, 5), 2015, "N")],
    )
    df = frame("id int, d date", [(1, date(2014, 12, 31)), (2, date(2015, 3, 31)), (3, date(2015, 5, 4)), (4, date(2015, 5, 5)), (5, date(2030, 1, 1)), (6, None)])
    assert rows_of(with_calendar(df, calendar, "d", ["fiscal_year"]), "id") == [(1,), (2,), (3,), (4,)]
    kept = reporting_dates(df, calendar, "d", F.lit(date(2015, 5, 4)), 2015)
    assert rows_of(kept, "id") == [(2,), (3,)]
