"""Both repeat removers against brute force over all windows."""

from __future__ import annotations

import hashlib
import re

import pytest

from wintide.llm import repeats, suffix_levels, suffix_trees


def by_bytes(rows, width):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, b in texts:
        for p in range(len(b) - width + 1):
            seen[b[p : p + width]] = seen.get(b[p : p + width], 0) + 1
    out = []
    for i, b in texts:
        covered = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if seen[b[p : p + width]] > 1:
                covered[p : p + width] = b"\1" * width
        kept = bytes(x for x, c in zip(b, covered) if not c)
        runs = len(re.findall(rb"\x01+", bytes(covered)))
        out.append((i, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def by_words(rows, width):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = (t or "").encode().split()
        covered = [0] * len(words)
        for p in range(len(words) - width + 1):
            window = tuple(words[p : p + width])
            if window in seen:
                covered[p : p + width] = [1] * width
            seen.add(window)
        kept = b" ".join(w for w, c in zip(words, covered) if not c)
        out.append((i, len(words), sum(covered), hashlib.sha256(kept).hexdigest()))
    return out


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("most", [20_000, 2])
def test_bytes(documents, corpus, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_IN_TASK", most)
    found = suffix_levels.remove_repeats(documents, kept=False)
    assert listed(found) == sorted(by_bytes(corpus, 400), key=str)


def test_bytes_short_matches_and_one_batch(documents, corpus):
    found = suffix_levels.remove_repeats(documents, least=60, anchor=16, batches=1)
    assert listed(found.drop("kept")) == sorted(by_bytes(corpus, 60), key=str)
    for row in found.collect():
        assert hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"]


@pytest.mark.parametrize("most", [20_000, 2])
def test_words(documents, corpus, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_IN_TASK", most)
    found = suffix_trees.remove_repeated_words(documents, kept=False)
    assert listed(found) == sorted(by_words(corpus, 20), key=str)


def test_rows_listed_twice(spark, corpus):
    text = corpus[3][1]
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id bigint, text string")
    assert {r["n_removed"] for r in suffix_trees.remove_repeated_words(docs).collect()} == {0}
    assert {r["n_removed"] == r["n_bytes"] for r in suffix_levels.remove_repeats(docs).collect()} == {True}


def test_empty(empty):
    assert suffix_levels.remove_repeats(empty).count() == 0
    assert suffix_trees.remove_repeated_words(empty).count() == 0


def test_levels_merge_geometrically(spark, documents):
    family = suffix_levels.SuffixLevels(spark, suffix_levels.byte_shape())
    rows = repeats.identified(documents, "doc_id", "text")
    sizes = []
    for _ in range(5):
        family.add(rows)
        sizes.append([size for size, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    family.drop()
