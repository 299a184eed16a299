"""Lexical search by pair bounds, held to scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wintide.llm import pair_bounds

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranks(docs, items, k):
    held = [(d, Counter(plain_terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, length = len(held), sum(size for *_, size in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        if item is None:
            continue
        scores = []
        for d, c, size in held:
            m = 100 - 50 + (50 * size * n) // length
            score = 0
            for w in set(plain_terms(text)) & c.keys():
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0 and d is not None:
                scores.append((-score, d))
        out += [(item, rank, d, -s) for rank, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("shard", "block", "k"), [(2_000_000, 1 << 22, 50), (3_000, 2_000, 7)])
def test_against_all_scores(spark, corpus, documents, monkeypatch, shard, block, k):
    monkeypatch.setattr(pair_bounds, "SHARD_TERMS", shard)
    monkeypatch.setattr(pair_bounds, "BLOCK_BYTES", block)
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    rng = random.Random(2)
    words = [w for _, t in corpus for w in (t or "").split()]
    items += [(900 + n, " ".join(rng.choices(words, k=n + 1))) for n in range(12)]
    items += [(1_000, items[0][1]), (1_001, "..."), (1_002, None), (None, "le la"), (1_003, "unheardof wordsthatnobodyuses"), (items[0][0], items[0][1])]
    df = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id bigint, text string, doc_id int")
    found = pair_bounds.rank_documents(documents, df, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == plain_ranks(corpus, items, k)


def test_ties_repeats_and_long_texts(spark):
    long = " ".join(f"w{n % 5000}" for n in range(60_000))
    docs = [(n, "same words here") for n in range(120)] + [(7, "same words here"), (500, long), (501, long), (502, "Words")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    items = [(1, "same words"), (2, "w17 w18 here"), (3, long)]
    found = pair_bounds.rank_documents(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, found.collect())) == plain_ranks(docs, items, 50)


def test_empty_tables(spark, documents, empty):
    items = spark.createDataFrame([(1, "le la")], "item_id bigint, text string")
    for docs, asked in ((empty, items), (documents, items.limit(0)), (documents.where("doc_id < 0"), items)):
        assert pair_bounds.rank_documents(docs, asked).collect() == []


def test_pair_bounds_skip_and_lose_nothing():
    """A joint maximum below the two maxima's sum ends the search for new documents earlier, with equal results."""
    rng = np.random.default_rng(3)
    count = 4_000
    plan = pair_bounds.Plan(count, count * 100, {bytes([97 + n]): 900 + n for n in range(12)})
    plan.add(0, set(plan.weights))
    shard = pair_bounds.Shard(plan, pa.array(np.arange(count)), np.full(count, 100))
    scores = np.zeros(count, np.int64)
    for n, word in enumerate(plan.weights):
        docs = np.flatnonzero((np.arange(count) + n) % 2 == 0) if n < 4 else np.sort(rng.choice(count, 40, replace=False))
        shard.add(word, np.diff(docs, prepend=0), rng.integers(1, 4, len(docs)))
        scores[docs] += shard.postings[word][1]
    units = plan.queries[0][1]
    single = sum(max(shard.bounds((w,))) for w in plan.weights)
    for unit in plan.pairs:
        shard.joint[unit] = shard.pair(unit)
    assert sum(max(shard.bounds(u)) for u in units) < single
    at, gained = shard.search(units, 20)
    least = np.sort(scores)[-20]
    assert at.tolist() == np.flatnonzero(scores >= least).tolist() and gained.tolist() == scores[at].tolist()
