from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from wintide.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "don't 'tis I'll we'REs 've''s   x\t\n y \u3000z \x1c q", "'", "''s", "a 's b's's 'll", "aaaa" * 500,
    "  \n\n  ", "日本語テキスト 123½Ⅷ", "x'rex 'r 've", "\xa0a \xa0 b", "🙂🙂 'd", "ab" * 3000, " " * 5000,
]


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(bpe.read_ranks(PATH))


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={}
    )


def test_same_ids_as_the_library(own, library, corpus):
    rng = random.Random(0)
    made = ["".join(rng.choice("abst 'lverm\n\t 1,é") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    for text in [t or "" for _, t in corpus] + ODD + made:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_appends_and_edits(own):
    rng = random.Random(1)
    for _ in range(200):
        data = "".join(rng.choice("abstein the") for _ in range(rng.randint(0, 400))).encode()
        table = bpe.PrefixTable(own, data)
        start = rng.randint(0, len(data))
        stop = rng.randint(start, min(len(data), start + 5))
        new = "".join(rng.choice("abste") for _ in range(rng.randint(0, 5))).encode()
        table.replace(start, stop, new)
        table.append(b"xyz")
        want = data[:start] + new + data[stop:] + b"xyz"
        assert table.data == want and table.ids() == bpe.PrefixTable(own, want).ids() == own.merge(want)


def test_an_edit_stops_where_the_tables_agree(own):
    table = bpe.PrefixTable(own, b"the cat sat on the mat " * 200)
    assert table.replace(10, 11, b"o") < 500


def test_documents(documents, corpus, library):
    found = bpe.encode_documents(documents, PATH).collect()
    want = []
    for i, text in corpus:
        ids = library.encode_ordinary(text or "")
        line = " ".join(map(str, ids))
        sums = [hashlib.sha256(x).hexdigest() for x in (line.encode(), (text or "").encode())]
        want.append((i, len(ids), *sums, ids))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_empty(empty):
    assert bpe.encode_documents(empty, PATH).count() == 0
