"""Byte-level BPE by prefix dynamic programming.

A byte string has one BPE encoding, and so has each of its prefixes. For every prefix the table keeps
the last token of that encoding. Two facts make the table cheap to fill: the encoding of a prefix,
without its last token, is the encoding of the shorter prefix that remains; and a token sequence is an
encoding exactly if every two neighbours are what BPE makes of their joined bytes. So the last token of
a prefix is the one token ending there whose left neighbour, read from the table, fits to it. Appending
bytes goes on from the table; after an edit, entries are filled anew only until they agree with the old
ones over the length of the longest token.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO_PIECES = 250_000
MEMO_PREFIXES = 600_000
MEMO_PAIRS = 1_000_000
LONGEST_KEPT_PIECE = 64


class ByteBpe:
    """Vocabulary of byte strings with ranks; a rank is the token's id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.vocab = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._sizes = {i: len(b) for b, i in ranks.items()}
        self._tails = {b[k:]: ranks.get(b[k:], -1) for b in ranks for k in range(len(b))}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._alone: dict[int, bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._old_pieces: dict[str, tuple[int, ...]] = {}
        self._prefixes: dict[bytes, int] = {}

    def merge(self, data: bytes) -> list[int]:
        """BPE by its definition: the lowest rank among neighbours merges first, leftmost first."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            found = [x for x in found if x[0] is not None]
            if not found:
                break
            _, k = min(found)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def _edge(self, token: int, right: bool) -> list[tuple[bytes, float]]:
        """Tokens at one edge of ``token`` while BPE builds it, each with the rank of the merge that ends it."""
        known = self._edges[right].get(token)
        if known is None:
            data = self.vocab[token]
            parts = [data[k : k + 1] for k in range(len(data))]
            edge, ranks = [parts[-right]], []
            while len(parts) > 1:
                rank, k = min(
                    (self.ranks.get(a + b, math.inf), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
                )
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                if parts[-right] != edge[-1]:
                    edge.append(parts[-right])
                    ranks.append(rank)
            known = self._edges[right][token] = list(zip(edge, [*ranks, math.inf]))
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens as they are when their bytes are joined.

        It does unless a merge across the border comes before the merges that take its two sides away.
        Merges inside a token come in the order of their ranks, as a later token is made of earlier ones.
        """
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= MEMO_PAIRS:
                self._pairs.clear()
            lefts, rights, i, j, known = self._edge(left, True), self._edge(right, False), 0, 0, True
            while True:
                (a, a_ends), (b, b_ends) = lefts[i], rights[j]
                across = self.ranks.get(a + b, math.inf)
                if across < a_ends and across <= b_ends and across != math.inf:
                    known = False
                    break
                if a_ends == b_ends == math.inf:
                    break
                if a_ends <= b_ends:
                    i += 1
                else:
                    j += 1
            self._pairs[key] = known
        return known

    def stands_alone(self, token: int) -> bool:
        known = self._alone.get(token)
        if known is None:
            known = self._alone[token] = self.merge(self.vocab[token]) == [token]
        return known

    def fill(self, data: bytes, last: list[int], stop: int) -> None:
        """Adds to ``last`` the last tokens of the encodings of ``data[:end]``, up to ``end == stop``."""
        tails, pairs = self._tails, self._pairs
        for end in range(len(last), stop + 1):
            found, k = [], end - 1
            while k >= 0:
                token = tails.get(data[k:end])
                if token is None:
                    break
                if token >= 0:
                    found.append((k, token))
                k -= 1
            for k, token in reversed(found):
                if k:
                    fit = pairs.get((last[k], token))
                    if fit is None:
                        fit = self.fits(last[k], token)
                else:
                    fit = self.stands_alone(token)
                if fit:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one match of the split pattern. Pieces share the entries of their common prefixes."""
        ids = self._pieces.get(piece) or self._old_pieces.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                ids = (whole,)
            elif len(data) > LONGEST_KEPT_PIECE:
                return tuple(PrefixTable(self, data).ids())
            else:
                ids = self._shared_prefixes(data)
        if len(self._pieces) >= MEMO_PIECES:
            self._old_pieces, self._pieces = self._pieces, {}
        self._pieces[piece] = ids
        return ids

    def _shared_prefixes(self, data: bytes) -> tuple[int, ...]:
        known, last = self._prefixes, [-1]
        if len(known) >= MEMO_PREFIXES:
            known.clear()
        n = len(data)
        while len(last) <= n:
            token = known.get(data[: len(last)])
            if token is None:
                break
            last.append(token)
        new = len(last)
        self.fill(data, last, n)
        for k in range(new, n + 1):
            known[data[:k]] = last[k]
        ids = []
        while n:
            ids.append(last[n])
            n -= self._sizes[last[n]]
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        bounds = piece_bounds(text)
        pieces = [text[a:b] for a, b in zip(bounds, bounds[1:])]
        found = list(map(self._pieces.get, pieces))
        if None in found:
            found = [ids or self.encode_piece(p) for ids, p in zip(found, pieces)]
        return list(chain.from_iterable(found))

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


class PrefixTable:
    """Encoding of one byte string, kept open for appends and edits. ``last[n]`` belongs to n bytes."""

    def __init__(self, bpe: ByteBpe, data: bytes = b"") -> None:
        self.bpe, self.data, self.last = bpe, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.fill(self.data, self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Puts ``new`` in place of ``data[start:stop]``; returns how many entries were filled anew."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[: start + 1]
        agreed = 0
        for end in range(start + 1, len(self.data) + 1):
            self.bpe.fill(self.data, self.last, end)
            settled = end - shift > stop and old[end - shift] == self.last[end]
            agreed = agreed + 1 if settled else 0
            if agreed == self.bpe.longest:
                self.last += old[end - shift + 1 :]
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.bpe.vocab[out[-1]])
        return out[::-1]


SPACE, LETTER, NUMBER, OTHER = range(4)


@cache
def _kinds() -> np.ndarray:
    """Kind of every code point, as the split pattern's classes have it."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for kind, name in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        for run in regex.finditer(f"{name}+", points):
            kinds[ord(run[0][0]) : ord(run[0][-1]) + 1] = kind
    return kinds


def piece_bounds(text: str) -> list[int]:
    """Starts of the split pattern's matches, and the text's end.

    The pattern is public_tokenizers.PATTERN. Its matches are runs of one kind; a plain space goes to
    the run after it, other last spaces stand alone, and an apostrophe takes the ending it introduces.
    """
    if not text:
        return [0]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[points]
    n = len(points)
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=start[1:])
    after_space = np.flatnonzero((kinds[1:] != SPACE) & (kinds[:-1] == SPACE)) + 1
    start[after_space - 1] = True
    start[after_space[points[after_space - 1] == 32]] = False
    for k in np.flatnonzero((points[:-1] == 39) & start[:-1] & (kinds[1:] == LETTER)).tolist():
        ending = text[k + 1 : k + 3]
        size = 2 if ending[0] in "stmd" else 3 if ending in ("re", "ve", "ll") else 0
        if size:
            start[k + 1] = False
            if k + size < n:
                start[k + size] = True
    return np.append(np.flatnonzero(start), n).tolist()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


_BUILT: dict[int, ByteBpe] = {}


def _bpe(shared) -> ByteBpe:
    """The vocabulary of this Python worker, built once for each broadcast."""
    ranks = shared.value
    if id(ranks) not in _BUILT:
        _BUILT.clear()
        _BUILT[id(ranks)] = ByteBpe(ranks)
    return _BUILT[id(ranks)]


def encode_documents(
    docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", ids: bool = True
) -> DataFrame:
    """Token ids of every whole text, and what they decode to.

    Returns the key, ``n_tokens``, ``ids`` (array, only if asked for), ``ids_sha256`` (of the decimal ids
    joined by one space) and ``decoded_sha256`` (of the bytes that the ids decode to). One row for each
    row, repeated rows included; a null key stays null, a null text counts as empty, other columns do
    not matter. An empty text has no ids. Rows are independent: no shuffle, no group, and a lost task
    is simply run again. The vocabulary file is read by the driver and broadcast; it holds one line per
    token and does not grow with the documents.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(shared)
        decimal = {i: str(i) for i in bpe.vocab}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts, ids_of, id_sums, sums = [], [], [], []
                for value in part.column(1):
                    found = bpe.encode(value.as_py())
                    counts.append(len(found))
                    line = " ".join(map(decimal.__getitem__, found))
                    id_sums.append(hashlib.sha256(line.encode()).hexdigest())
                    sums.append(hashlib.sha256(bpe.decode(found)).hexdigest())
                    if ids:
                        ids_of.append(found)
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(id_sums), pa.array(sums)]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    columns.append(pa.array(ids_of, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(encode, schema + (", ids array<int>" if ids else ""))
