"""SimHash, quality model, decontamination and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from wintide.llm import components, decontaminate, ordinal_quality, secrets_index, simhash


def plain_fingerprint(text, shingle=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + n]), 42) for k in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, radius):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    listed = sorted(root)
    for k, a in enumerate(listed):
        for b in listed[:k]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {p: find(p) for p in listed}


def test_near_duplicates(documents, corpus):
    prints = [plain_fingerprint(t) for _, t in corpus]
    root = grouped(set(prints), 4)
    least = {}
    for (i, _), p in zip(corpus, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = sorted((str(i), f"{p:016x}", least.get(root[p])) for (i, _), p in zip(corpus, prints))
    assert sorted((str(r[0]), r[1], r[2]) for r in simhash.near_duplicates(documents).collect()) == want
    assert len(set(least.values())) < len(corpus) - 5


@pytest.mark.parametrize("compared", [simhash.COMPARED, 64, 2])
def test_links(spark, compared):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    same_half = rng.getrandbits(32)
    prints |= {same_half << 32 | rng.getrandbits(32) for _ in range(150)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print bigint").repartition(4)
    found = {(a % 2**64, b % 2**64) for a, b in simhash.links(df, compared=compared).collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in found:
        root[find(a)] = find(b)
    want = grouped(prints, 4)
    assert len({(find(p), want[p]) for p in prints}) == len({find(p) for p in prints}) == len(set(want.values()))


def test_forest():
    rng = random.Random(5)
    for _ in range(50):
        n = rng.randint(2, 60)
        links = [tuple(rng.sample(range(n), 2)) for _ in range(rng.randint(1, 150))]
        a, b = (np.array(e) for e in zip(*links))

        def groups(chosen, n=n):
            root = list(range(n))

            def find(p):
                while root[p] != p:
                    p = root[p]
                return p

            for x, y in chosen:
                root[find(x)] = find(y)
            return {frozenset(p for p in range(n) if find(p) == r) for r in map(find, range(n))}

        tree = simhash._forest(a, b, n).tolist()
        assert groups([links[k] for k in tree]) == groups(links)
        assert len(tree) == n - len(groups(links))


def test_components(spark):
    path = [(n, n + 1) for n in range(60)] + [(100, n) for n in range(200, 260)] + [(7, 7)]
    found = dict(map(tuple, components.connected(spark.createDataFrame(path, "a bigint, b bigint")).collect()))
    assert found == {**{n: 0 for n in range(1, 61)}, **{n: 100 for n in range(200, 260)}}


def test_keep_one(spark, documents, corpus, empty):
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    near = {r[0] for r in simhash.near_duplicates(documents).select("component_id").distinct().collect()}
    rows = kept.collect()
    assert len(rows) == len(near) and {r["doc_id"] for r in rows} == near
    assert simhash.keep_one(empty).count() == 0


def test_keep_one_tells_texts_of_one_id_apart(spark):
    other = "totally other words stand here and no copy of them is anywhere else"
    long = " ".join(f"w{n % 977}" for n in range(200_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", 0), (1, other, 1), (1, other, 0), (2, other, 2), (None, other, 3),
        (None, "a text without id that nobody else has in this table", 4), (3, None, 5), (4, "", 6), (5, long, 7), (6, long, 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row_0 int").repartition(3)
    kept = sorted((r["row_0"], r["doc_id"]) for r in simhash.keep_one(docs).collect())
    # two rows repeat the id and the text: the first by its other columns stays
    assert kept == [(0, 1), (0, 1), (4, None), (5, 3), (7, 5)]


def held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")


def test_quality_on_held_out_labels(spark):
    docs, seen, unseen = held_out(spark)
    model = ordinal_quality.train(docs, seen)
    assert model.thresholds[0] < model.thresholds[1]
    rows = ordinal_quality.score_documents(docs, model).join(unseen, "doc_id").select("keep", "quality", "toxic").collect()
    kept = np.array([r[0] for r in rows])
    good = np.array([r[1] == 1 and r[2] == 0 for r in rows])
    assert kept[good].mean() > 0.96
    assert kept[~good].mean() < 0.25  # two thousand labels; four times as many halve it


def test_quality_odd_rows(spark, documents, corpus, empty):
    labels = spark.createDataFrame(
        [(i, n % 2, n % 3 % 2) for n, (i, _) in enumerate(corpus)] + [(1, None, 0)], "doc_id bigint, quality int, toxic int"
    )
    model = ordinal_quality.train(documents, labels)
    scored = ordinal_quality.score_documents(documents, model).collect()
    assert len(scored) == len(corpus)
    assert all(abs(r["expected_grade"] - r["p_not_toxic"] - r["p_good"]) < 1e-9 for r in scored)
    kept = ordinal_quality.keep_good(documents, model)
    assert kept.count() == sum(r["keep"] for r in scored) and kept.columns == documents.columns
    untrained = ordinal_quality.train(empty, labels)
    assert all(r["keep"] for r in ordinal_quality.score_documents(documents, untrained).collect())
    assert ordinal_quality.score_documents(empty, model).count() == 0


def plain_edits(item, window):
    row = [0] * (len(window) + 1)
    for k, c in enumerate(item, 1):
        last, row = row, [k]
        for j, d in enumerate(window, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return min(row)


def test_edit_distance():
    rng = random.Random(4)
    for _ in range(200):
        item = bytes(rng.choice(b"abc ") for _ in range(rng.randint(1, 40)))
        window = bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 60)))
        assert decontaminate.edit_distance_within(item, window) == plain_edits(item, window)


def edited(words, share, rng):
    out = []
    for w in words:
        draw = rng.random()
        if draw < share / 3:
            continue
        out.append("qx" if draw < 2 * share / 3 else w)
        if share > draw > 2 * share / 3:
            out.append("zu")
    return out


@pytest.mark.parametrize("block", [1 << 24, 4_000])
def test_planted_items(spark, corpus, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rng = random.Random(6)
    texts = {r[0]: r[1] for r in items.select("item_id", "text").collect()}
    clean = [t.split() for _, t in corpus[:40] if t and len(t.split()) > 30]
    rows, planted, close = [], set(), set()
    for n, (name, text) in enumerate(sorted(texts.items())):
        host = rng.choice(clean)
        passage = edited(text.split(), (0, 0.04, 0.1)[n % 3], rng)
        doc = " ".join([*host[:15], *passage, *host[15:30]])
        rows.append((n, doc.upper() if n % 5 == 0 else doc, 1))
        size = len(b" ".join(text.encode().translate(decontaminate.WORDS).split()))
        window = b" ".join(doc.encode().translate(decontaminate.WORDS).split())
        item = b" ".join(text.encode().translate(decontaminate.WORDS).split())
        if decontaminate.edit_distance_within(item, window) <= 0.2 * size:
            planted.add((n, name))
    for n, words in enumerate(clean):
        rows.append((10_000 + n, " ".join(words), 1))
    rows += [(20_000, None, 1), (20_001, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id int").repartition(4)
    more = spark.createDataFrame([(-1, "too short"), (-2, None), (None, None)], "item_id bigint, text string")
    queries = items.select("item_id", "text").unionByName(more)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(docs, queries).collect()}
    assert len(planted) > 0.9 * len(texts)
    assert len(found & planted) >= 0.98 * len(planted)
    assert not {d for d, _ in found} & set(range(10_000, 30_000)) - {
        10_000 + n for n, w in enumerate(clean) for t in texts.values() if t in " ".join(w)
    }
    assert close == set()
    dropped = {r[0] for r in rows} - {r["doc_id"] for r in decontaminate.drop_contaminated(docs, queries).collect()}
    assert dropped == {d for d, _ in found}


def test_no_items_or_documents(spark, documents, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_items(documents, none).count() == 0
    assert decontaminate.drop_contaminated(documents, none).count() == documents.count()
    assert decontaminate.find_items(empty, none).count() == 0


def test_pipeline(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        now = {r[0] for r in docs.select("doc_id").collect()}
        assert now <= kept and (now < kept or name == "secrets"), name
        kept = now
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = {r[0]: (r[1], r[2]) for r in labels.collect()}
    assert not [i for i in kept if judged.get(i, (1, 0))[1]]
    assert secrets_index.find_secrets(docs).where(F.size("found") > 0).count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).select("doc_id").collect()} == kept
