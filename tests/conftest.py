from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wintide.session import build_session  # noqa: E402
from wintide.sources import parse_schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small DataFrame from DDL text and rows."""

    def make(ddl: str, rows: list[tuple]):
        return spark.createDataFrame(rows, parse_schema(ddl))

    return make


@pytest.fixture
def one(spark):
    """Value of a Column expression."""

    def value(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return value


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
