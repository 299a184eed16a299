"""Which tokens of two tokenizers stand for the same bytes, and how often over a corpus.

A text's tokens of either side are laid on its bytes; where tokens of both end together, they are cut into
groups, and all tokens of one side are linked to all of the other side within a group. Most groups hold one
token of each side, which then have the same bytes. An array from each id of the first side to the second's
id of equal bytes tells such links apart: they are counted in a vector as long as the vocabulary. Only the
links of irregular groups become (a, b) pairs that are shuffled.

How many documents hold a pair is needed for every link of every document, so the documents are read twice:
once through both tokenizers, leaving a compact list of each document's distinct links, and once to add up
those lists. Documents are dealt in chunks; a chunk asks for each of its pairs once, whatever the number of
documents that hold it, and no task holds more than a chunk.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wintide.llm.shared import staged

CHUNK_TOKENS = 1 << 20  # a chunk is closed when its documents have so many tokens
GROUP_LINKS = 1 << 12  # groups of more links than this are counted by distinct ids first
SHIFT = np.int64(32)


@dataclass
class Side:
    """A tokenizer: ids of a text, and the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: list[bytes | None]

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(p) if p is not None else 0 for p in self.pieces], np.int64)

    def joined(self, ids: list[int]) -> bytes | None:
        try:
            return b"".join(map(self.pieces.__getitem__, ids))
        except TypeError:  # an id that stands for no bytes
            return None


def byte_alphabet() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def byte_level(vocabulary: bytes, pattern: str) -> Side:
    """A byte-level BPE from its JSON file; a space is put before each text.

    Where merges make ids in their order, as in rank files, and the pieces are cut by ``pattern``, the ids are
    the ranks and tiktoken encodes with them; otherwise the file is run by the tokenizers library.
    """
    model = json.loads(vocabulary)
    letters = byte_alphabet()
    special = {t["id"] for t in model["added_tokens"]}
    ids = model["model"]["vocab"]
    pieces: list[bytes | None] = [None] * (1 + max([*ids.values(), *special]))
    for token, n in ids.items():
        if n not in special:
            pieces[n] = bytes(letters[c] for c in token)
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    ranked = all(ids["".join(m)] == 256 + n for n, m in enumerate(merges)) and model["pre_tokenizer"] == {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
    }
    if ranked and model["normalizer"] is None:
        import tiktoken

        ranks = {p: n for n, p in enumerate(pieces) if p is not None}
        by_rank = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return Side(lambda texts: [by_rank.encode_ordinary(" " + t) for t in texts], pieces)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(vocabulary.decode())
    whole.encode_special_tokens = True
    return Side(
        lambda texts: [e.ids for e in whole.encode_batch([" " + t for t in texts], add_special_tokens=False)], pieces
    )


def word_pieces(model: bytes) -> Side:
    """A sentencepiece model, which puts a space before each text itself."""
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_proto=model)
    pieces: list[bytes | None] = []
    for n in range(processor.get_piece_size()):
        piece = processor.id_to_piece(n)
        if processor.is_byte(n):
            pieces.append(bytes([int(piece[3:5], 16)]))
        elif processor.is_control(n) or processor.is_unknown(n) or processor.is_unused(n):
            pieces.append(None)
        else:
            pieces.append(piece.replace("▁", " ").encode())
    return Side(lambda texts: processor.encode(texts, num_threads=1), pieces)


class Aligner:
    """Both tokenizers, the identity map between them, and the digest's parts."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        ids = {p: n for n, p in reversed(list(enumerate(b.pieces))) if p is not None}
        # a byte may also stand as a piece of its own, which a tokenizer takes before its fallback
        ids |= {p: n for n, p in enumerate(b.pieces) if p is not None and len(p) == 1}
        self.same = np.array([ids.get(p, -1) for p in a.pieces], np.int64)
        self.signs = [f"{n}{end}" for n in range(len(a.pieces)) for end in ",|"]
        self.signs += [f"{n}{end}" for n in range(len(b.pieces)) for end in ",;"]

    def align(self, texts: list[bytes]) -> Iterator[tuple]:
        """Of each text ``n_a``, ``n_b``, ``n_groups``, ``n_links``, the digest, and its distinct links with their counts.

        Links come as the ids of the first side whose link is the identity map's, and as pairs a << 32 | b.
        """
        strings = [t.decode("utf-8", "replace") for t in texts]
        none = np.zeros(0, np.int64)
        for text, a, b in zip(texts, self.a.encode(strings), self.b.encode(strings)):
            whole = b" " + text
            if not text or self.a.joined(a) != whole or self.b.joined(b) != whole:
                yield 0, 0, 0, 0, "", (none, none), (none, none)
                continue
            yield self._links(np.array(a, np.int64), np.array(b, np.int64))

    def _links(self, a: np.ndarray, b: np.ndarray) -> tuple:
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        _, last_a, last_b = np.intersect1d(ends_a, ends_b, return_indices=True)
        from_a, from_b = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
        of_a, of_b = last_a + 1 - from_a, last_b + 1 - from_b
        groups = len(last_a)
        # the digest: tokens of both sides in the groups' order
        signs = np.empty(len(a) + len(b), np.int64)
        sign_a, sign_b = 2 * a, 2 * (b + len(self.a.pieces))
        sign_a[last_a] += 1
        sign_b[last_b] += 1
        signs[np.arange(len(a)) + np.repeat(from_b, of_a)] = sign_a
        signs[np.arange(len(b)) + np.repeat(last_a + 1, of_b)] = sign_b
        line = "".join(map(self.signs.__getitem__, signs.tolist()))[:-1]
        links = of_a * of_b
        alone = links == 1
        one_a, one_b = a[from_a[alone]], b[from_b[alone]]
        regular = self.same[one_a] == one_b
        codes = [one_a[~regular] << SHIFT | one_b[~regular]]
        counts = [np.ones(len(codes[0]), np.int64)]
        plain = ~alone & (links <= GROUP_LINKS)
        size, width = links[plain], np.repeat(of_b[plain], links[plain])
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        left = a[np.repeat(from_a[plain], size) + at // width]
        right = b[np.repeat(from_b[plain], size) + at % width]
        codes.append(left << SHIFT | right)
        counts.append(np.ones(len(left), np.int64))
        for g in np.flatnonzero(links > GROUP_LINKS).tolist():
            x, x_n = np.unique(a[from_a[g] : last_a[g] + 1], return_counts=True)
            y, y_n = np.unique(b[from_b[g] : last_b[g] + 1], return_counts=True)
            codes.append((x[:, None] << SHIFT | y[None, :]).ravel())
            counts.append((x_n[:, None] * y_n[None, :]).ravel())
        code, where = np.unique(np.concatenate(codes), return_inverse=True)
        count = np.bincount(where, np.concatenate(counts), len(code)).astype(np.int64)
        # an irregular group can hold a link of the identity map as well
        known = self.same[code >> SHIFT] == (code & np.int64(0xFFFFFFFF))
        same = np.bincount(one_a[regular], minlength=len(self.same))
        np.add.at(same, code[known] >> SHIFT, count[known])
        ids = np.flatnonzero(same)
        digest = hashlib.sha256(line.encode()).hexdigest()
        pairs = code[~known], count[~known]
        return len(a), len(b), groups, int(links.sum()), digest, (ids, same[ids]), pairs


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length, the first ones rising."""
    parts = [np.diff(columns[0], prepend=0), *columns[1:]]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(parts).astype("<u4").tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64)
    return np.cumsum(flat[: len(flat) // 2]), flat[len(flat) // 2 :]


_BUILT: dict[tuple, Aligner] = {}


def _aligner(shared) -> Aligner:
    """The tokenizers of this Python worker, built once for each pair of files."""
    files = shared.value
    if files not in _BUILT:
        _BUILT.clear()
        _BUILT[files] = Aligner(byte_level(files[0], files[1]), word_pieces(files[2]))
    return _BUILT[files]


def _links(docs: DataFrame, shared, key: str, text: str, kind: str) -> DataFrame:
    """One pass through both tokenizers. ``part`` tells the rows apart:

    documents with their figures and packed links, each task's counts of identity links (``a``, ``n``), and each
    chunk's counts of other pairs (``chunk``, ``code``, ``n``).
    """
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    names = ["part", "chunk", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same", "pairs", "code", "n"]
    schema = (
        f"part string, chunk bigint, key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, same binary, pairs binary, code bigint, n bigint"
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared)
        counts = np.zeros(len(aligner.a.pieces), np.int64)
        number, held = 0, []
        whole, data = pa.int64(), pa.binary()
        types = dict(zip(names, [pa.string(), whole, None, whole, whole, whole, whole, pa.string(), data, data, whole, whole]))

        def rows(size: int, **columns) -> pa.RecordBatch:
            filled = [pa.array(columns[n], types[n]) if n in columns else pa.nulls(size, types[n]) for n in names]
            return pa.RecordBatch.from_arrays(filled, names)

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            chunk = (TaskContext.get().partitionId() << 32) | number
            number += 1
            codes = np.concatenate([h[1][6][0] for h in held])
            code, where, n = np.unique(codes, return_inverse=True, return_counts=True)
            cuts = np.cumsum([len(h[1][6][0]) for h in held])[:-1]
            for at in range(0, len(held), 1_024):
                mine = held[at : at + 1_024]
                columns = zip(*[h[1][:5] for h in mine])
                places = np.split(where, cuts)[at : at + 1_024]
                yield rows(
                    len(mine),
                    part=["docs"] * len(mine),
                    chunk=[chunk] * len(mine),
                    key=[h[0] for h in mine],
                    **dict(zip(names[3:8], columns)),
                    same=[_packed(*h[1][5]) for h in mine],
                    pairs=[_packed(p, h[1][6][1]) for p, h in zip(places, mine)],
                )
            for at in range(0, len(code), 1 << 14):
                some = code[at : at + (1 << 14)]
                yield rows(len(some), part=["pairs"] * len(some), chunk=[chunk] * len(some), code=some, n=n[at : at + len(some)])
            held = []

        tokens = 0
        for batch in batches:
            types["key"] = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                keys, texts = (c.to_pylist() for c in part.columns)
                for name, found in zip(keys, aligner.align(texts)):
                    counts[found[5][0]] += 1
                    held.append((name, found))
                    tokens += found[0] + found[1]
                    if tokens >= CHUNK_TOKENS:
                        yield from close()
                        tokens = 0
        if held:
            yield from close()
        seen = np.flatnonzero(counts)
        if len(seen):
            yield rows(len(seen), part=["same"] * len(seen), code=seen, n=counts[seen])

    return staged(source.mapInArrow(compute, schema), "token-links", ("part",))


def align_tokens(
    docs: DataFrame, byte_vocabulary: str, piece_model: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token groups of every document under both tokenizers, and how common its links are over all documents.

    Returns the key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose count is the highest of
    their first id, ties included), ``count_sum`` (over links) and ``groups_sha256``. A link's count is the number
    of documents that hold its id pair linked.

    One row for each row, repeated rows and null keys included, each a document of its own. Null and empty texts,
    and those whose tokens do not add up to a space and the text, have zeros and an empty digest. Other columns do
    not matter; an empty table gives no rows. The files are read by the driver and broadcast, as are two vectors of
    the first vocabulary's length; nothing that grows with the documents is.
    """
    spark = docs.sparkSession
    files = []
    for path in (byte_vocabulary, piece_model):
        with open(path, "rb") as file:
            files.append(file.read())
    shared = spark.sparkContext.broadcast((files[0], pattern, files[1]))
    kind = docs.schema[key].dataType.simpleString()
    found = _links(docs, shared, key, text, kind)
    same = found.where("part = 'same'").groupBy("code").agg(F.sum("n").alias("n"))
    asked = found.where("part = 'pairs'").select("chunk", "code", "n")
    counted = staged(asked.groupBy("code").agg(F.sum("n").alias("total")), "pair-counts")
    size = len(_aligner(shared).a.pieces)
    totals, highest = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in same.collect():
        totals[row["code"]] = row["n"]
    for row in counted.groupBy(F.shiftright("code", 32).alias("a")).agg(F.max("total").alias("n")).collect():
        highest[row["a"]] = row["n"]
    vectors = spark.sparkContext.broadcast((totals, np.maximum(totals, highest)))

    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    answers = asked.join(counted, "code").select(
        "chunk", F.lit(0).alias("kind"), "code", "total", F.lit(None).cast(kind).alias("key"),
        *[F.lit(None).cast("string" if n == "groups_sha256" else "bigint").alias(n) for n in names],
        F.lit(None).cast("binary").alias("same"), F.lit(None).cast("binary").alias("pairs"),
    )
    rows = answers.unionByName(
        found.where("part = 'docs'").select(
            "chunk", F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("code"), F.lit(0).cast("bigint").alias("total"),
            "key", *names, "same", "pairs",
        )
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, highest = vectors.value
        current, codes, counts = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            edges = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
            at = 0
            for end in edges.tolist():
                part, chunk, first = batch.slice(at, end - at), int(keys[at] >> 1), not keys[at] & 1
                at = end
                if chunk != current:
                    current, codes, counts = chunk, [], []
                if first:
                    codes.append(part.column(2).to_numpy())
                    counts.append(part.column(3).to_numpy())
                    continue
                if len(codes) > 1:
                    codes, counts = [np.concatenate(codes)], [np.concatenate(counts)]
                best, sums = [], []
                for row_same, row_pairs in zip(part.column(10).to_pylist(), part.column(11).to_pylist()):
                    ids, n = _unpacked(row_same)
                    good = int(n[totals[ids] == highest[ids]].sum())
                    total = int((n * totals[ids]).sum())
                    places, n = _unpacked(row_pairs)
                    if len(places):
                        mine = counts[0][places]
                        good += int(n[mine == highest[codes[0][places] >> SHIFT]].sum())
                        total += int((n * mine).sum())
                    best.append(good)
                    sums.append(total)
                yield pa.RecordBatch.from_arrays(
                    [part.column(4), *[part.column(k) for k in (5, 6, 7, 8)], pa.array(best, pa.int64()), pa.array(sums, pa.int64()), part.column(9)],
                    [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    schema = (
        f"`{key}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
        "groups_sha256 string"
    )
    return rows.repartition("chunk").sortWithinPartitions("chunk", "kind", "code").mapInArrow(add_up, schema)
