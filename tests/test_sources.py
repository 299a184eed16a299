from __future__ import annotations

import pytest
from tests.conftest import rows_of

from checks import REGISTRY
from wintide.sources import SCHEMAS, TableSet, attach_database, parse_schema, read_table, stage, write_table


def test_all_schemas_parse(spark):
    for name, ddl in SCHEMAS.items():
        fields = parse_schema(ddl).fieldNames()
        assert len(fields) == len(set(fields)), name


def test_files_round_trip_with_fixed_schema(spark, frame, tmp_path):
    df = frame("id int, d string, v double", [(1, "x", 1.0), (2, "y", None)])
    write_table(df, f"{tmp_path}/facts.parquet", partition_by=["d"])
    write_table(df, f"{tmp_path}/facts.parquet", partition_by=["d"])  # overwrites
    tables = TableSet(spark, str(tmp_path), schemas={"facts": "id int, v double"})
    assert rows_of(tables["facts"], "id", "v") == [(1, 1.0), (2, None)]
    assert rows_of(read_table(spark, f"{tmp_path}/facts.parquet"), "id") == [(1,), (2,)]


def test_names_may_point_to_several_places(spark, frame, tmp_path):
    write_table(frame("id int", [(1,)]), f"{tmp_path}/one/a.parquet")
    write_table(frame("id int", [(2,)]), f"{tmp_path}/two/b.parquet")
    tables = TableSet(spark, f"{tmp_path}/one", names={"other": f"{tmp_path}/two/b.parquet"})
    assert rows_of(tables["a"].union(tables["other"])) == [(1,), (2,)]
    replaced = tables.replaced(a=frame("id int", [(9,)]))
    assert rows_of(replaced["a"]) == [(9,)]
    assert set(replaced) == {"a", "other"} and len(replaced) == 2


def test_catalog_tables_and_bucketing(spark, frame):
    df = frame("id int, v string", [(i, str(i)) for i in range(50)])
    for name in ("left_accounts", "right_accounts"):
        write_table(df, name, as_table=True, bucket_by=(4, ["id"]))
    a, b = read_table(spark, "left_accounts"), read_table(spark, "right_accounts")
    joined = a.hint("merge").join(b, "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50


def test_bucketing_needs_a_catalog_table(frame, tmp_path):
    with pytest.raises(ValueError, match="catalog"):
        write_table(frame("id int", [(1,)]), str(tmp_path / "x"), bucket_by=(2, ["id"]))


def test_stage_cuts_the_lineage(spark, frame):
    df = frame("id int", [(1,), (2,)])
    staged = stage(df.groupBy("id").count(), "counts")
    assert rows_of(staged) == [(1, 1), (2, 1)]
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "Aggregate" not in plan


def test_stage_without_shared_folder_raises(frame, monkeypatch):
    monkeypatch.setattr("wintide.sources.tables.staging_folder", lambda spark: None)
    with pytest.raises(ValueError, match="shared folder"):
        stage(frame("id int", [(1,)]), "x")


def test_overwriting_partitions_leaves_the_others(frame, spark, tmp_path):
    path = f"{tmp_path}/by_day"
    write_table(frame("id int, d string", [(1, "x"), (2, "y"), (3, "y")]), path, partition_by=["d"])
    write_table(frame("id int, d string", [(9, "y"), (8, "z")]), path, partition_by=["d"], mode="overwrite_partitions")
    assert rows_of(read_table(spark, path), "id", "d") == [(1, "x"), (8, "z"), (9, "y")]
    write_table(frame("id int, d string", []), path, partition_by=["d"], mode="overwrite_partitions")
    assert read_table(spark, path).count() == 3
    with pytest.raises(ValueError, match="partitions"):
        write_table(frame("id int", [(1,)]), path, mode="overwrite_partitions")


def test_a_bucket_is_one_file(frame, spark, tmp_path):
    df = frame("id int, v string", [(i, str(i)) for i in range(200)]).repartition(7)
    write_table(df, "bucketed_files", as_table=True, bucket_by=(3, ["id"]), location=f"{tmp_path}/bucketed")
    assert len(list((tmp_path / "bucketed").glob("part-*.parquet"))) == 3
    assert read_table(spark, "bucketed_files").count() == 200


def test_stored_reports_join_without_a_shuffle(spark):
    text = REGISTRY["stored_reports_joined"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_a_report_over_two_databases(frame, spark, tmp_path):
    for place, value in (("one", 1), ("two", 2)):
        write_table(frame("id int, v int", [(7, value)]), f"{tmp_path}/{place}/facts.parquet")
    names = {}
    for place in ("one", "two"):
        found = attach_database(spark, f"db_{place}", {"facts": f"{tmp_path}/{place}/facts.parquet"}, f"{tmp_path}/{place}/db")
        assert found == {"facts": f"db_{place}.facts"}
        names[f"{place}_facts"] = found["facts"]
    again = attach_database(spark, "db_one", {"facts": f"{tmp_path}/two/facts.parquet"})
    assert again == {"facts": "db_one.facts"}
    tables = TableSet(spark, names=names)
    joined = tables["one_facts"].join(tables["two_facts"], "id")
    assert [tuple(r) for r in joined.collect()] == [(7, 1, 2)]
