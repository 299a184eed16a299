"""Benchmark items with letters edited, in few words or without words, against brute-force edit distance."""

from __future__ import annotations

import random

import pytest

from wintide.llm import decontaminate

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def altered(text, share, rng, kinds):
    out = list(text)
    for at in rng.sample(range(len(out)), int(share * len(out))):
        kind = rng.choice(kinds)
        out[at] = {"swap": rng.choice(LETTERS), "drop": "", "add": out[at] + rng.choice(LETTERS)}[kind]
    return "".join(out)


@pytest.mark.parametrize("kinds", [("swap",), ("swap", "drop", "add")])
@pytest.mark.parametrize("share", [0.1, 0.15, 0.18, 0.2])
def test_letter_edits(spark, share, kinds):
    rows = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").select("item_id", "text").collect()
    rng = random.Random(7)
    index = decontaminate.build_index([(r[0], r[1]) for r in rows])
    host = " ".join("".join(rng.choices(LETTERS, k=rng.randint(2, 9))) for _ in range(60))
    docs = [f"{host} {altered(r[1], share, rng, kinds)} {host}".encode() for r in rows]
    want = {
        n for n, r in enumerate(rows)
        if decontaminate.edit_distance_within(index.texts[n], decontaminate.plain(docs[n])) <= 0.2 * len(index.texts[n])
    }
    found = {text for text, item, _, _ in decontaminate.hits(index, docs) if text == item}
    print(share, kinds, len(found & want), len(want))
    assert found <= want
    assert len(found & want) >= 0.9 * len(want)
    assert len(want) >= 0.8 * len(rows) or share > 0.18


def replaced(text, places):
    out = list(text)
    for at in places:
        out[at] = "x" if out[at] != "x" else "y"
    return "".join(out)


def placed_edits(kind, n, most):
    """Up to ``most`` places among ``n``: evenly spaced, in one or three clusters, in pairs, or at shifting gaps."""
    if kind.startswith("every"):
        return range(int(kind[5:]) // 2, n, int(kind[5:]))
    if kind == "cluster":
        return range(n // 3, n // 3 + most)
    if kind == "clusters":
        return [p for k in range(3) for p in range(k * n // 3, k * n // 3 + most // 3)]
    if kind == "pairs":
        return [p for k in range(most // 2) for p in (k * n // (most // 2), k * n // (most // 2) + 1)]
    # two edits in ten bytes, the second one byte further on each time: no run exceeds eight
    return [p for p in range(n) if p % 10 in (0, (p // 10) % 9 + 1)][:most]


@pytest.mark.parametrize("kind", ["every5", "every6", "every7", "every8", "every10", "cluster", "clusters", "pairs", "shifting"])
def test_placed_edits(spark, kind):
    rows = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").select("item_id", "text").collect()
    index = decontaminate.build_index([(r[0], r[1]) for r in rows])
    host = b"zq vkj 00 " * 30
    bodies = [t.decode() for t in index.texts]
    docs = [host + replaced(t, placed_edits(kind, len(t), len(t) // 5)).encode() + b" " + host for t in bodies]
    want = {
        n for n, t in enumerate(index.texts)
        if decontaminate.edit_distance_within(t, decontaminate.plain(docs[n])) <= 0.2 * len(t)
    }
    found = {text for text, item, _, _ in decontaminate.hits(index, docs) if text == item}
    print(kind, len(found & want), len(want))
    assert found == want
    assert len(want) > 100


@pytest.mark.parametrize("most_edits", [0.0, 0.02, 0.1, 0.2, 0.27, 0.35])
def test_no_item_within_the_bound_is_lost(most_edits):
    rng = random.Random(int(100 * most_edits))
    texts, docs = [], []
    for size in [*range(48, 132, 3), 62, 71, 80, 200, 500]:
        text = "".join(rng.choices("abcdef ", k=size)).strip() + "q"
        texts.append(text)
        edited = text
        for at in sorted(rng.sample(range(len(text)), int(most_edits * len(text))), reverse=True):
            kind = rng.choice(["swap", "drop", "add"])
            edited = edited[:at] + {"swap": "z", "drop": "", "add": "k" + edited[at]}[kind] + edited[at + 1 :]
        docs.append(edited)
    joined = [d.encode() for d in docs] + [" ".join(docs).encode(), b"", ("é" * 70).encode()]
    index = decontaminate.build_index(list(enumerate(texts)), most_edits)
    want = {
        (d, n) for d, doc in enumerate(joined) for n, t in enumerate(index.texts)
        if decontaminate.edit_distance_within(t, decontaminate.plain(doc)) <= most_edits * len(t)
    }
    found = {(d, n) for d, n, _, _ in decontaminate.hits(index, joined, most_edits)}
    assert found == want and len(want) >= len(texts)


ODD = ["Ja", "x", "forty two", "Who wrote Emma?", "東京は日本の首都であり人口は約千四百万人である", "ภาษาไทยไม่มีการเว้นวรรคระหว่างคำ", "é"]


def test_items_of_few_words(spark):
    pad = "zzz qqq 0000 kkk"
    docs = [(n, f"{pad} {t} {pad}") for n, t in enumerate(ODD)]
    docs += [(100, f"{pad} whq wrote emmu {pad}"), (101, f"{pad} 東京は日本の首都であり人口は約千五百万人である {pad}")]
    docs += [(n, f"{pad[: n - 200]}{ODD[4][: n - 195]}" + ODD[4][n - 194 :] + pad) for n in range(200, 206)]
    docs += [(300, pad), (301, None), (302, "")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame(list(enumerate(ODD)) + [(50, ""), (51, "?!"), (52, None)], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(df, items).collect()}
    want = set()
    for n, t in enumerate(ODD):
        item = decontaminate.plain(t.encode())
        for d, text in docs:
            if text and decontaminate.edit_distance_within(item, decontaminate.plain(text.encode())) <= 0.2 * len(item):
                want.add((d, n))
    assert found == want and {(n, n) for n in range(len(ODD))} <= found
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(df, items).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}
