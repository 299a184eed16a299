from __future__ import annotations

import random

import pytest

from wintide.llm.shared import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def corpus(spark):
    """(id, text) rows: documents of the smallest test set, and odd ones."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    texts = [(r[0], r[1]) for r in rows]
    rng = random.Random(5)
    words = texts[3][1].split()
    near = [" ".join(w if rng.random() > 0.01 else "zz" for w in words) for _ in range(6)]
    odd = [None, "", " \n\t", "a" * 1500, "x" + "ab" * 600, "Orre " * 300, texts[3][1], texts[4][1] * 2, *near]
    return texts + [(9_000 + n, t) for n, t in enumerate(odd)] + [(None, texts[7][1]), (None, None)]


@pytest.fixture
def documents(spark, corpus):
    """The corpus with extra columns whose names clash with those the operators use inside."""
    rows = [(i, t, "s", -1, "x", 7, "p") for i, t in corpus]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, key string, id int, row string, print int, parts string"
    ).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
