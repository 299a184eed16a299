"""Hashes of all windows of long sequences, by numpy, and anchors that equal windows share.

A sequence's hash is a polynomial modulo 2**64 over its units (bytes, or hashes of words). With prefix
sums, the hash of any part costs one subtraction and one product. A window's anchor is the part of ``k``
units within it that has the smallest hash (the leftmost of equal ones); as it depends on the window's
content alone, equal windows have equal anchors at equal offsets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 20
LOW = np.uint64(0xFFFFFFFF)
HIGH = np.uint64(0xFFFFFFFF00000000)
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of them."""
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        for at, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            _powers[at] = np.cumprod(np.append(np.uint64(1), np.full(size, base, np.uint64)))
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


BYTE_UNITS = mix(np.arange(1, 257, dtype=np.uint64))


def prefix_sums(units: np.ndarray) -> np.ndarray:
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(len(units))[0][: len(units)], out=out[1:])
    return out


def part_hash(sums: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    return (sums[start + size] - sums[start]) * powers(len(sums))[1][start]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours: of block suffixes and block prefixes."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    count = n - width + 1
    return np.minimum(left[:count], right[width - 1 : width - 1 + count])


class Anchors(NamedTuple):
    """Runs of neighbouring windows with one anchor. ``seen`` hashes all that the run's windows cover."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    before: np.ndarray
    anchor: np.ndarray
    seen: np.ndarray


def anchors_of(units: np.ndarray, bounds: np.ndarray, width: int, k: int) -> Anchors:
    """Anchors of all windows of ``width`` units that lie within one document.

    ``bounds`` has each document's first unit and the end. ``start`` counts from the document's start,
    ``before`` is how far the anchor lies behind the run's first window.
    """
    n = len(units)
    lengths = np.diff(bounds)
    if n < width or not (lengths >= width).any():
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    sums = prefix_sums(units)
    hashes = mix(part_hash(sums, np.arange(n - k + 1), k))
    keys = (hashes & HIGH) | np.arange(n - k + 1, dtype=np.uint64)
    anchor = (sliding_min(keys, width - k + 1) & LOW).astype(np.int64)
    steps = np.zeros(n + 2, np.int32)
    long_enough = lengths >= width
    np.add.at(steps, bounds[:-1][long_enough], 1)
    np.add.at(steps, bounds[1:][long_enough] - width + 1, -1)
    starts = np.flatnonzero(np.cumsum(steps[: n - width + 1]))
    of = anchor[starts]
    new = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    first, count, at = starts[new], np.diff(np.append(new, len(starts))), of[new]
    doc = np.searchsorted(bounds, first, "right") - 1
    shape = mix((count.astype(np.uint64) << np.uint64(32)) | (at - first).astype(np.uint64))
    seen = mix(part_hash(sums, first, count - 1 + width) ^ shape)
    return Anchors(doc, first - bounds[doc], count, at - first, hashes[at], seen)


def window_hashes(units: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    return mix(part_hash(prefix_sums(units), starts, width))


def byte_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return BYTE_UNITS[data], np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text's first word (and the end), words' byte bounds in the joined data."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = SPACES[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = prefix_sums(BYTE_UNITS[data])
    hashes = mix(part_hash(sums, starts, ends - starts) + (ends - starts).astype(np.uint64))
    text_starts = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
    return hashes, np.searchsorted(starts, text_starts).astype(np.int64), starts, ends


def word_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return words_of(texts)[:2]


def in_chunks(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows in pieces of about ``CHUNK_BYTES`` of text (a longer text is a piece of its own), with their texts."""
    for batch in batches:
        lengths = batch.column(text_at)
        sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int32, len(lengths) + 1, 4 * lengths.offset))
        first, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if row > first and held + size > CHUNK_BYTES:
                part = batch.slice(first, row - first)
                yield part, part.column(text_at).to_pylist()
                first, held = row, 0
            held += size
        if first < batch.num_rows:
            part = batch.slice(first)
            yield part, part.column(text_at).to_pylist()
