from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from wintide import functions as fn


def text(value):
    return F.lit(value).cast("string")


def day(value):
    return F.lit(value).cast("date")


@pytest.mark.parametrize(
    ("raw", "numeric", "prefix"),
    [
        ("123", 123, "123"),
        ("123.0", 123, "123"),
        ("12.5", 13, "12"),
        ("-12.5", -13, "-12"),
        ("", None, ""),
        ("abc", None, "abc"),
        ("1e30", None, "1e30"),
        (None, None, None),
    ],
)
def test_normalize_id(one, raw, numeric, prefix):
    assert one(fn.normalize_id(text(raw))) == numeric
    assert one(fn.normalize_id(text(raw), "prefix")) == prefix


def test_normalize_id_rejects_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        fn.normalize_id(text("1"), "other")


def test_composite_key_counts_null_as_empty(one):
    assert one(fn.composite_key(F.lit(7), text(None), text("a@b"))) == "7a@b"


@pytest.mark.parametrize(
    ("name", "first", "rest"),
    [
        ("Ann", "Ann", "Ann"),
        ("Ann Lee", "Ann", "Lee"),
        ("Ann van Lee", "Ann", "van Lee"),
        ("Ann ", "Ann", ""),
        (None, None, None),
    ],
)
def test_split_name(one, name, first, rest):
    a, b = fn.split_name(text(name))
    assert (one(a), one(b)) == (first, rest)


def test_role_label(one):
    assert one(fn.role_label(text("x"), text("x"))) == "Owner"
    assert one(fn.role_label(text("x"), text("y"))) == "Admin"
    assert one(fn.role_label(text("x"), text(None))) == "Admin"


def test_transition(one):
    assert one(fn.transition(text("A"), text("B"))) == "A to B"
    assert one(fn.transition(text("A"), text(None))) is None
    assert one(fn.transition(text("A"), text(None), "Churned")) == "A to Churned"
    assert one(fn.transition(text(None), text("B"), "Churned")) is None


def test_distinct_list(frame):
    df = frame("k int, v string", [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)])
    out = df.groupBy("k").agg(
        fn.distinct_list("v").alias("v"), fn.distinct_list("v", F.col("v") > "a").alias("w")
    )
    assert rows_of(out, "k", "v", "w") == [(1, "a,b", "b"), (2, None, None)]


def test_strict_greatest_and_least(one):
    assert one(fn.strict_greatest(F.lit(1), F.lit(3))) == 3
    assert one(fn.strict_least(F.lit(1), F.lit(3))) == 1
    assert one(fn.strict_greatest(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(fn.strict_least(F.lit(None).cast("int"), F.lit(3))) is None


def test_ratio_and_pct_change(one):
    assert one(fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(fn.ratio(F.lit(1), F.lit(4), safe=False)) == 0.25
    assert one(fn.pct_change(F.lit(15), F.lit(10))) == 50.0
    assert one(fn.pct_change(F.lit(3), F.lit(0))) == 300.0
    assert one(fn.pct_change(F.lit(None).cast("int"), F.lit(10))) is None
    assert one(fn.complement(F.lit(0.25))) == 0.75
    assert one(fn.complement(F.lit(None).cast("double"))) is None


def test_weighted_level_and_license_floor(frame):
    df = frame("k int, level int, qty int, ela string", [(1, 4, 3, "N"), (1, 1, 1, "N"), (2, 5, 0, "Y")])
    out = df.groupBy("k").agg(
        fn.weighted_level("level", "qty", F.lit(True)).alias("avg"),
        fn.license_floor(F.max("qty"), F.max(F.col("ela") == "Y")).alias("seats"),
    )
    assert rows_of(out, "k", "avg", "seats") == [(1, 3.0, 3), (2, None, 1000)]


@pytest.mark.parametrize(("gap", "months"), [(0, 1), (30, 1), (31, 2), (61, 2), (62, 3)])
def test_elapsed_months31(one, gap, months):
    later = F.date_add(day("2020-01-01"), gap)
    assert one(fn.elapsed_months31(later, day("2020-01-01"))) == months
    assert one(fn.elapsed_days(later, day("2020-01-01"))) == gap


def test_days_left(one):
    assert one(fn.days_left(day("2020-01-10"), day("2020-01-01"), F.lit(True))) == 9
    assert one(fn.days_left(day("2020-01-10"), day("2020-01-01"), F.lit(None).cast("boolean"))) is None


def test_yesterday_in_zone(one):
    early = F.lit(datetime(2020, 3, 10, 3, 0)).cast("timestamp_ntz")
    assert one(fn.yesterday_in("America/Los_Angeles", early)) == date(2020, 3, 8)
    assert one(fn.yesterday_in("UTC", early)) == date(2020, 3, 9)


def test_quarter_helpers(one):
    assert one(fn.quarter_end(day("2020-02-29"))) == date(2020, 3, 31)
    assert one(fn.year_quarter(day("2020-12-01"))) == "2020Q4"


@pytest.mark.parametrize(
    ("value", "label"),
    [(0, "none"), (-5, "low"), (9.99, "low"), (10, "mid"), (20, "top"), (None, "?")],
)
def test_band_is_total(one, value, label):
    col = F.lit(value).cast("double")
    assert one(fn.band(col, [(10, "low"), (20, "mid")], "top", "?", {0: "none"})) == label


def test_band_needs_ascending_steps(spark):
    with pytest.raises(ValueError, match="ascending"):
        fn.band(F.lit(1), [(20, "b"), (10, "a")], "top", "?")


def test_group_values(one):
    rules = [("ent", "%Enterprise%"), ("team", ["Team", "Regular"]), (None, ["Plan Shift"])]
    got = [one(fn.group_values(text(v), rules, "Other")) for v in ("X Enterprise", "Regular", "Plan Shift", "z", None)]
    assert got == ["ent", "team", "Plan Shift", "Other", "Other"]
    assert one(fn.group_values(text("z"), rules)) is None


def test_lifecycle_status(one):
    got = [one(fn.lifecycle_status(F.lit(v).cast("double"))) for v in (1.0, 0.0, -1.0, None)]
    assert got == ["Customer", "Churned", "Churned", "Churned"]
