from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from wintide.operators import (
    Feature,
    account_360,
    as_of_instant,
    coalesce_sources,
    one_per_key,
    owner_chain,
)

SCD = "dw_curr_ind string, dw_eff_start timestamp, dw_eff_end timestamp"
OLD = (datetime(2000, 1, 1), datetime(2019, 1, 1))
NEW = (datetime(2019, 1, 1), datetime(9999, 12, 31))


def test_account_360_keeps_driver_rows_for_unique_features(frame):
    driver = frame("id int, run int", [(1, 5), (2, 6), (None, 7)])
    a = frame("id int, x string", [(1, "x1"), (3, "x3")])
    b = frame("fid int, r int, y string, z string", [(2, 6, "y2", "z2"), (1, 4, "old", "old")])
    out = account_360(
        driver, [Feature(a, "id", flag="has_a"), Feature(b, [("id", "fid"), ("run", "r")], ["y"], flag="has_b")]
    )
    assert out.columns == ["id", "run", "x", "has_a", "y", "has_b"]
    assert rows_of(out, "id", "x", "has_a", "y", "has_b") == [
        (1, "x1", "1", None, "0"),
        (2, None, "0", "y2", "1"),
        (None, None, "0", None, "0"),
    ]


def test_one_per_key_merges_repeats_and_leaves_null_keys_out(frame):
    df = frame("id int, v string, w int", [(1, "a", 2), (1, "a", 2), (2, None, None), (2, None, None), (None, "x", 1), (None, "y", 1)])
    assert rows_of(one_per_key(df, ["id"])) == [(1, "a", 2), (2, None, None)]
    assert rows_of(one_per_key(df.select("id"), ["id"])) == [(1,), (2,)]
    assert one_per_key(df.filter("id > 9"), ["id"]).columns == ["id", "v", "w"]


@pytest.mark.parametrize("second", [("b", 2), ("a", None), (None, 2)])
def test_different_rows_of_a_unique_feature_fail_the_query(frame, second):
    driver = frame("id int", [(1,), (7,)])
    feature = frame("fid int, v string, w int", [(1, "a", 2), (7, "a", 2), (7, *second)])
    wide = account_360(driver, [Feature(feature, [("id", "fid")], unique=True)])  # no action yet
    for read in (wide, wide.select("id", "w")):
        with pytest.raises(Exception, match='several rows for one key: {"fid":7}'):
            read.collect()
    assert wide.select("id").count() == 2  # nobody reads the feature
    assert account_360(driver, [Feature(feature, [("id", "fid")])]).count() == 3
    same = account_360(driver, [Feature(feature, [("id", "fid")], ["fid"], flag="has", unique=True)])
    assert same.count() == 2  # the columns that are asked for do not differ


def test_wide_instances_need_no_distinct(spark):
    from checks import REGISTRY

    text = REGISTRY["account_360_full"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in text.splitlines() if "Aggregate [" in line and "support_pql_score" in line and "guide_num_hc" in line]
    assert wide == []


def test_coalesce_sources_per_field(frame):
    df = frame("id int, other int", [(1, 10), (2, 20), (3, None)])
    a = frame("id int, p string, q string", [(1, "p1", None), (2, None, None)])
    b = frame("bid int, p string, q string", [(10, "pb", "qb"), (20, "pb2", None)])
    out = coalesce_sources(df, [(a, "id"), (b, ("other", "bid"))], ["p", "q"])
    assert rows_of(out, "id", "p", "q") == [(1, "p1", "qb"), (2, "pb2", None), (3, None, None)]


def test_owner_chain_current_and_as_of(frame):
    facts = frame("acc string, d date", [("a", date(2018, 1, 1)), ("a", date(2020, 1, 1)), ("gone", date(2020, 1, 1))])
    accounts = frame(
        f"id string, ownerid string, isdeleted string, {SCD}",
        [("a", "u1", "False", "N", *OLD), ("a", "u2", "False", "Y", *NEW), ("gone", "u1", "True", "Y", *NEW)],
    )
    users = frame(
        f"id string, name string, userroleid string, {SCD}",
        [("u1", "One", "r1", "Y", OLD[0], NEW[1]), ("u2", "Two", None, "Y", OLD[0], NEW[1])],
    )
    roles = frame(f"id string, name string, {SCD}", [("r1", "Role", "Y", OLD[0], NEW[1])])
    names = {"user_columns": [F.col("name").alias("owner")], "role_columns": [F.col("name").alias("role")]}
    now = owner_chain(facts, "acc", accounts, users, roles, **names)
    assert rows_of(now, "acc", "owner", "role") == [("a", "Two", None), ("a", "Two", None), ("gone", None, None)]
    then = owner_chain(facts, "acc", accounts, users, roles, at=as_of_instant("d", None), **names)
    assert rows_of(then, "acc", "owner", "role") == [("a", "One", "Role"), ("a", "Two", None), ("gone", "One", "Role")]
