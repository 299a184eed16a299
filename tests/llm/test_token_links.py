"""Token groups and link counts of two tokenizers, held to a plain walk over both."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wintide.llm import token_links

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "<|endoftext|> and <s></s><unk>", "▁ is a space to one of them", "aaaaaaaa" * 900, "日本語のテキスト。 ไทย русский", "\x00\x01 \t\r\n  x",
    "🙂🙃 é é", "  leading and trailing  ", "a" * 7 + "b" * 3 + "a" * 11, "ab" * 4_000, "word " * 3_000,
]


def plain(docs):
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = token_links.byte_alphabet()

    def piece(n):
        name = second.id_to_piece(n)
        return bytes([int(name[3:5], 16)]) if second.is_byte(n) else name.replace("▁", " ").encode()

    found, df = [], Counter()
    for name, text in docs:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        ends = []
        for parts in ([bytes(letters[c] for c in first.id_to_token(n)) for n in a], [piece(n) for n in b]):
            ends.append([sum(map(len, parts[: k + 1])) for k in range(len(parts))] if len(parts) < 500 else None)
            if ends[-1] is None:
                total, ends[-1] = 0, []
                for p in parts:
                    total += len(p)
                    ends[-1].append(total)
            if not text or b"".join(parts) != b" " + text.encode():
                found.append((name, None))
                break
        else:
            groups, cuts = [], sorted(set(ends[0]) & set(ends[1]))
            x = y = 0
            for cut in cuts:
                to_x, to_y = ends[0].index(cut, x) + 1, ends[1].index(cut, y) + 1
                groups.append((a[x:to_x], b[y:to_y]))
                x, y = to_x, to_y
            links = Counter((p, q) for left, right in groups for p in left for q in right)
            df.update(links.keys())
            found.append((name, (len(a), len(b), groups, links)))
    best = defaultdict(int)
    for (a, _), n in df.items():
        best[a] = max(best[a], n)
    out = []
    for name, one in found:
        if one is None:
            out.append((name, 0, 0, 0, 0, 0, 0, ""))
            continue
        line = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in one[2])
        good = sum(n for (a, b), n in one[3].items() if df[a, b] == best[a])
        count = sum(n * df[link] for link, n in one[3].items())
        digest = hashlib.sha256(line.encode()).hexdigest()
        out.append((name, one[0], one[1], len(one[2]), sum(one[3].values()), good, count, digest))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, *((x if x is not None else -1) for x in r)))


@pytest.mark.parametrize(("chunk", "large"), [(1 << 20, 1 << 12), (3_000, 3)])
def test_against_a_plain_walk(spark, corpus, monkeypatch, chunk, large):
    monkeypatch.setattr(token_links, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(token_links, "GROUP_LINKS", large)
    docs = corpus + [(20_000 + n, t) for n, t in enumerate(ODD)] + [(1, corpus[1][1])]
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in docs], "doc_id bigint, text string, chunk int, pairs string")
    found = token_links.align_tokens(df.repartition(3), A, B, public_tokenizers.PATTERN)
    assert found.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    want = plain(docs)
    assert ordered(map(tuple, found.collect())) == ordered(want)
    assert any(r[0] == 20_001 and r[1] == 0 for r in want)


def test_empty_table_and_other_keys(spark, empty):
    assert token_links.align_tokens(empty, A, B, public_tokenizers.PATTERN).count() == 0
    named = spark.createDataFrame([("x", "the word"), (None, None)], "doc_id string, text string")
    rows = token_links.align_tokens(named, A, B, public_tokenizers.PATTERN).collect()
    assert {(r["doc_id"], r["n_groups"]) for r in rows} == {("x", 2), (None, 0)}


def test_file_run_by_its_own_library():
    """A vocabulary whose ids are not its merges' ranks goes through the tokenizers library."""
    with open(A, "rb") as file:
        vocabulary = file.read()
    by_rank = token_links.byte_level(vocabulary, public_tokenizers.PATTERN)
    by_file = token_links.byte_level(vocabulary.replace(b'"add_prefix_space":false', b'"add_prefix_space": false', 1), public_tokenizers.PATTERN)
    other = token_links.byte_level(vocabulary.replace(b'"normalizer":null', b'"normalizer":{"type":"NFC"}', 1), public_tokenizers.PATTERN)
    texts = [t for t in ODD if t.isascii()]
    assert by_rank.encode(texts) == by_file.encode(texts) == other.encode(texts)
