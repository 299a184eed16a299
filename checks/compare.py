"""Run registered queries on Spark and their oracle on DuckDB, compare schema and sorted rows.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import REGISTRY
from wintide.session import build_session

TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def _same(a: object, b: object) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def differences(
    df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str
) -> tuple[list[str], int]:
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)
    relation = con.sql(sql)
    names = sorted(relation.columns)
    if names != cols:
        return [f"columns {sorted(set(cols) ^ set(names))}"], len(got)
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    problems = [
        f"type of {f.name}: {f.dataType.simpleString()} vs {types[f.name]}"
        for f in df.schema.fields
        if TYPE_NAMES.get(f.dataType.simpleString()) != types[f.name]
    ]
    quoted = ", ".join(f'"{c}"' for c in cols)
    expected = sorted(relation.project(quoted).fetchall(), key=_key)
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} vs {len(expected)}")
    for a, b in zip(got, expected, strict=False):
        bad = [c for c, x, y in zip(cols, a, b, strict=True) if not _same(x, y)]
        if bad:
            problems.append(f"first difference in {bad}: {a} vs {b}")
            break
    return problems, len(got)


def compare(spark: SparkSession, folder: str, names: list[str]) -> int:
    con = duck(folder)
    failures = 0
    for name in names:
        fn, sql = REGISTRY[name]
        begin = time.perf_counter()
        try:
            problems, rows = differences(fn(spark, folder), con, sql)
        except Exception as error:  # report every query, then fail once
            problems, rows = [f"{type(error).__name__}: {str(error)[:1500]}"], 0
        took = time.perf_counter() - begin
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {rows} rows {took:.2f}s", flush=True)
        for p in problems:
            print(f"     {p}")
        failures += bool(problems)
    print(f"{len(names) - failures} of {len(names)} agree")
    return failures


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("checks", "local[8]", 8, {"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    unknown = set(args.names) - set(REGISTRY)
    if unknown:
        raise SystemExit(f"unknown queries: {sorted(unknown)}")
    raise SystemExit(1 if compare(spark, args.sf, args.names or list(REGISTRY)) else 0)


if __name__ == "__main__":
    main()
