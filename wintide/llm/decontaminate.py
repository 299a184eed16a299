"""Benchmark decontamination: leaves of items with at most one edit as seeds, bounded edit distances around them.

An item of ``n`` bytes within ``E`` edits is cut into ``E // 2 + 1`` leaves of up to nine bytes. Wherever the
edits lie, some leaf has at most one: else there were more than ``E``. The same count holds for every way to
cut the leaves into stretches: some stretch of ``L`` leaves has at most ``2 * L - 1`` edits, within it some pair or
triple of leaves, and within that a leaf. So every leaf is sought in the documents with one edit; its pair or
triple, then its stretch of up to 63 bytes, are held to the text by edit distance, a column at a time for all
candidates; those left by exact edit distance of the whole item. No step loses an item within the bound.

A leaf with one edit and its place in a text have equal bytes once one byte is left out of each: of the leaf,
and of the as many bytes of the text that begin there. What is left is eight bytes, a number.

Items below 50 bytes are sought by intact runs, which are so short that by the pigeonhole principle one is
left. Units are bytes, so no script needs word separators.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wintide.llm import rolling

MOST_EDITS = 0.2  # of the item's characters
LEAF = 9  # one byte less is a number of 64 bits
LEAST_LEAF = 7  # shorter ones are met too often; then runs
STRETCH = 3  # pairs of leaves, or two and a triple: at most 63 bytes
LEAST_BYTES = 50  # of an item that is cut into leaves
MOST_PAIRS = 128_000
SCANNED = 1 << 17
AROUND = 64
BLOCK_BYTES = 4 << 20
FILTER_BITS = 20
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
# space, letters, digits; bytes beyond ASCII share what is left, but for the last, which is no byte of a text
CODES = np.array(
    [c - 96 if 97 <= c <= 122 else c - 21 if 48 <= c <= 57 else 37 + c % 26 if c >= 128 else 0 for c in range(256)],
    np.uint8,
)
BEYOND = 63
MARGIN = 4 * AROUND


class Seeds(NamedTuple):
    """Runs of one length, sorted by hash."""

    run: int
    hashes: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    filter: np.ndarray


class Keys(NamedTuple):
    """Numbers to meet when one byte of a text is left out, sorted; ``leaf`` has those of each, from ``first`` on."""

    keys: np.ndarray
    first: np.ndarray
    leaf: np.ndarray
    shift: int
    filter: np.ndarray


class Leaves(NamedTuple):
    """Leaves of one length: their numbers, for each byte of the text that may be left out.

    The other columns have a row for each leaf: its item and first byte, and the first byte, the end and the
    most edits of its pair or triple (``near``) and of its stretch (``wide``). ``group`` is the row of ``masks``
    for its pair or triple.
    """

    size: int
    left_out: list[Keys]
    item: np.ndarray
    offset: np.ndarray
    near: np.ndarray
    wide: np.ndarray
    group: np.ndarray
    masks: np.ndarray


class Index(NamedTuple):
    """A block of items; ``data`` has their bytes, ``first`` each one's first and the end."""

    items: list
    texts: list[bytes]
    sizes: np.ndarray
    data: np.ndarray
    first: np.ndarray
    seeds: list[Seeds]
    leaves: list[Leaves]


def plain(text: bytes) -> bytes:
    return b" ".join(text.translate(WORDS).split())


def run_of(size: int, most_edits: float = MOST_EDITS) -> int:
    """Length of the seeds of an item that is not cut into leaves."""
    return max(1, size // (int(size * most_edits) + 1))


def leaf_bounds(size: int, most_edits: float = MOST_EDITS) -> list[int]:
    """First bytes of an item's leaves, and the end; none where runs are sought instead.

    The last leaf may go on for a byte behind the item, if there may be an edit more.
    """
    most = int(size * most_edits)
    leaves = most // 2 + 1
    if size < LEAST_BYTES or size < LEAST_LEAF * leaves:
        return []
    size += size + 1 == LEAF * leaves and most % 2 == 0
    return [min(LEAF * k, k * size // leaves) for k in range(leaves + 1)]


def _pairs(leaves: int) -> list[tuple[int, int]]:
    """Pairs of leaves, the last one a triple where their number is odd."""
    at = list(range(0, max(1, leaves - 1), 2))
    return list(zip(at, [*at[1:], leaves]))


def _run_hashes(sums: np.ndarray, run: int) -> np.ndarray:
    return rolling.mix(rolling.part_hash(sums, np.arange(max(0, len(sums) - run)), run))


def build_index(items: list[tuple[object, str]], most_edits: float = MOST_EDITS) -> Index:
    listed = [(name, plain((text or "").encode())) for name, text in items]
    listed = [(name, text) for name, text in listed if text]
    texts = [text for _, text in listed]
    units, first = rolling.byte_units(texts)
    bounds = [leaf_bounds(len(t), most_edits) for t in texts]
    runs = np.array([0 if b else run_of(len(t), most_edits) for t, b in zip(texts, bounds)], np.int64)
    sums, seeds = rolling.prefix_sums(units), []
    for run in np.unique(runs[runs > 0]).tolist():
        at = np.concatenate([np.arange(first[n], first[n + 1] - run + 1) for n in np.flatnonzero(runs == run)])
        hashes = _run_hashes(sums, run)[at]
        order = np.argsort(hashes, kind="stable")
        hashes, at = hashes[order], at[order]
        item = np.searchsorted(first, at, "right") - 1
        filter_ = np.zeros(1 << FILTER_BITS, bool)
        filter_[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        seeds.append(Seeds(run, hashes, item, at - first[item], filter_))
    data = np.frombuffer(b"".join(texts), np.uint8)
    return Index([name for name, _ in listed], texts, np.diff(first), data, first, seeds, _leaves(data, first, bounds))


def _leaves(data: np.ndarray, first: np.ndarray, bounds: list[list[int]]) -> list[Leaves]:
    rows = []
    for item, at in enumerate(bounds):
        pairs = _pairs(len(at) - 1) if at else []
        parts = -(-len(pairs) // STRETCH)
        for part in range(parts):
            stretch = pairs[part * len(pairs) // parts : (part + 1) * len(pairs) // parts]
            low, high = stretch[0][0], stretch[-1][1]
            for a, b in stretch:
                for k in range(a, b):
                    near, wide = (at[a], at[b], 2 * (b - a) - 1), (at[low], at[high], 2 * (high - low) - 1)
                    rows.append((item, at[k], at[k + 1] - at[k], *near, *wide))
    table, out = np.array(rows, np.int64).reshape(-1, 9), []
    words = _words(data)
    for size in np.unique(table[:, 2]).tolist():
        of = table[table[:, 2] == size]
        place = first[of[:, 0]] + of[:, 1]
        keys = np.stack([_without(words[place], words[place + 1], k, size) for k in range(size)])
        last, leaf = size - 1, np.arange(len(of))
        # a byte replaced leaves out the same of both, one put in the last of the leaf, one left out that of the text
        ways = [_keys(np.concatenate([keys[k], keys[last]]), np.tile(leaf, 2)) for k in range(last)]
        ways.append(_keys(keys.ravel(), np.tile(leaf, size)))
        near, wide = of[:, 3:6], of[:, 6:9]
        group, masks = _masks(data, first[of[:, 0]] + near[:, 0], near[:, 1] - near[:, 0])
        out.append(Leaves(size, ways, of[:, 0], of[:, 1], near, wide, group, masks))
    return out


def _keys(keys: np.ndarray, leaf: np.ndarray) -> Keys:
    # bytes that repeat give a leaf's number twice
    pairs = np.unique(np.stack([keys, leaf.astype(np.uint64)], axis=1), axis=0)
    keys, first = np.unique(pairs[:, 0], return_index=True)
    shift = 64 - min(26, len(keys).bit_length() + 5)
    filter_ = np.zeros(1 << (64 - shift), bool)
    filter_[_filed(keys, shift)] = True
    return Keys(keys, np.append(first, len(pairs)), pairs[:, 1].astype(np.int64), shift, filter_)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, and one place more; zeros follow the end."""
    padded = np.zeros(len(data) + LEAF, np.uint8)
    padded[: len(data)] = data
    rows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    return np.ascontiguousarray(rows).view("<u8")[:, 0]


def _without(here: np.ndarray, after: np.ndarray, left_out: int, size: int) -> np.ndarray:
    """Of the ``size`` bytes that ``here`` begins with, all but one; ``after`` begins a byte later."""
    out = after ^ ((here ^ after) & np.uint64((1 << 8 * left_out) - 1))
    return out if size == LEAF else out & np.uint64((1 << 8 * (size - 1)) - 1)


def _filed(keys: np.ndarray, shift: int) -> np.ndarray:
    return ((keys * np.uint64(rolling.BASE)) >> np.uint64(shift)).view(np.int64)


def candidates(
    index: Index, data: np.ndarray, first: np.ndarray, most_edits: float = MOST_EDITS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, byte at which the item would begin) of seeds whose surroundings are near, in order."""
    coded = np.full(len(data) + 2 * MARGIN, BEYOND, np.uint8)
    coded[MARGIN : MARGIN + len(data)] = CODES[data]
    found = [rows for leaves in index.leaves for rows in _leaf_candidates(index, leaves, data, coded, first)]
    sums = rolling.prefix_sums(rolling.BYTE_UNITS[data]) if index.seeds else None
    for seeds in index.seeds:
        hashes = _run_hashes(sums, seeds.run)
        at = np.flatnonzero(seeds.filter[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        # a run that goes on into the next text is none
        at = at[at + seeds.run <= first[np.searchsorted(first, at, "right")]]
        low = np.searchsorted(seeds.hashes, hashes[at])
        count = np.searchsorted(seeds.hashes, hashes[at], "right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        # a bounded number of pairs at a time
        cuts = np.flatnonzero(np.diff(np.cumsum(count) // MOST_PAIRS)) + 1
        for a, lo, n in zip(np.split(at, cuts), np.split(low, cuts), np.split(count, cuts)):
            if not len(a):
                continue
            place = np.repeat(a, n)
            entry = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            item, offset = seeds.item[entry], seeds.offset[entry]
            text = np.searchsorted(first, place, "right") - 1
            # of a longer run's seeds, which follow one another, one will do
            keys = ((text << 44) + (item << 20) + offset // (AROUND // 4)).view(np.uint64)
            keys = rolling.mix(rolling.mix(keys) + (place - offset).view(np.uint64))
            _, one = np.unique(keys, return_index=True)
            place, item, offset, text = place[one], item[one], offset[one], text[one]
            near = _near(index, item, offset, coded, place, seeds.run, most_edits)
            place, item, offset, text = place[near], item[near], offset[near], text[near]
            found.append(np.stack([text, item, place - offset - first[text]]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    rows = np.unique(np.concatenate(found, axis=1), axis=1)
    return rows[0], rows[1], rows[2]


def _leaf_candidates(
    index: Index, leaves: Leaves, data: np.ndarray, coded: np.ndarray, first: np.ndarray
) -> Iterator[np.ndarray]:
    """Rows of ``candidates`` by leaves of one length, a bounded number of places and of pairs at a time."""
    met, held = [], 0
    for low in range(0, len(data), SCANNED):
        words = _words(data[low : low + SCANNED + LEAF])
        count = min(SCANNED, len(data) - low)
        here, after = words[:count], words[1 : count + 1]
        for k, ways in enumerate(leaves.left_out):
            keys = _without(here, after, k, leaves.size)
            at = np.flatnonzero(ways.filter[_filed(keys, ways.shift)])
            keys = keys[at]
            row = np.minimum(np.searchsorted(ways.keys, keys), len(ways.keys) - 1)
            same = ways.keys[row] == keys
            at, row = at[same], row[same]
            begin, n = ways.first[row], ways.first[row + 1] - ways.first[row]
            cuts = np.flatnonzero(np.diff(np.cumsum(n) // MOST_PAIRS)) + 1
            for a, b, c in zip(np.split(at, cuts), np.split(begin, cuts), np.split(n, cuts)):
                entry = np.repeat(b - np.append(0, np.cumsum(c)[:-1]), c) + np.arange(c.sum())
                met.append((np.repeat(low + a, c) << 32) | ways.leaf[entry])
                held += len(entry)
                if held >= MOST_PAIRS:
                    yield _leaf_matches(index, leaves, coded, first, met)
                    met, held = [], 0
    if held:
        yield _leaf_matches(index, leaves, coded, first, met)


def _leaf_matches(
    index: Index, leaves: Leaves, coded: np.ndarray, first: np.ndarray, met: list[np.ndarray]
) -> np.ndarray:
    # the same place and leaf come with several bytes left out
    met = np.sort(np.concatenate(met))
    met = met[np.append(True, met[1:] != met[:-1])]
    place, leaf = met >> 32, met & ((1 << 32) - 1)
    for bounds in (leaves.near, leaves.wide):
        begin, stop, most = bounds[leaf].T
        part, near = stop - begin, np.zeros(len(leaf), bool)
        for size in np.unique(part).tolist():
            of = np.flatnonzero(part == size)
            if bounds is leaves.near:
                masks = leaves.group[leaf[of]], leaves.masks
            else:
                masks = _masks(index.data, index.first[leaves.item[leaf[of]]] + begin[of], part[of])
            start = place[of] - (leaves.offset[leaf[of]] - begin[of]) - most[of]
            near[of] = _least_edits(*masks, part[of], coded, start, part[of] + 2 * most[of]) <= most[of]
        place, leaf = place[near], leaf[near]
    text = np.searchsorted(first, place, "right") - 1
    return np.stack([text, leaves.item[leaf], place - leaves.offset[leaf] - first[text]])


def _near(
    index: Index,
    item: np.ndarray,
    offset: np.ndarray,
    coded: np.ndarray,
    place: np.ndarray,
    run: int,
    most_edits: float,
) -> np.ndarray:
    """Whether the ``AROUND`` bytes of the item around a seed, or all, may be near some part of the text there."""
    size = index.sizes[item]
    part = np.minimum(size, AROUND)
    begin = np.clip(offset - (part - run) // 2, 0, size - part)
    slack = np.minimum(AROUND, np.maximum(2, np.floor(size * most_edits).astype(np.int64) + 1))
    source, start = index.first[item] + begin, place - (offset - begin) - slack
    least = _least_edits(*_masks(index.data, source, part), part, coded, start, part + 2 * slack)
    return least <= size * most_edits


def _masks(source: np.ndarray, begin: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code, a word of the places it has in ``part`` bytes of the source; one row for equal parts."""
    word = np.uint32 if part.max(initial=0) <= 32 else np.uint64
    wanted, of = np.unique((begin << 8) | part, return_inverse=True)
    first, sizes = wanted >> 8, wanted & 255
    masks = np.zeros((len(wanted), 64), word)
    for k in range(int(sizes.max(initial=0))):
        rows = np.flatnonzero(sizes > k)
        masks[rows, CODES[source[np.minimum(first[rows] + k, len(source) - 1)]]] |= word(1 << k)
    return of, masks


def _least_edits(
    of: np.ndarray, masks: np.ndarray, part: np.ndarray, coded: np.ndarray, start: np.ndarray, steps: np.ndarray
) -> np.ndarray:
    """At most the fewest edits that turn ``part`` bytes of an item into some of the ``steps`` bytes from ``start`` on.

    Edit distance as in ``edit_distance_within``, of all rows at once in words of 32 or 64 bits. Texts follow one
    another and bytes beyond ASCII share codes, so the figure may be too low but never too high.
    """
    if not len(of):
        return np.zeros(0, np.int64)
    word = masks.dtype.type
    masks, of, at = masks.ravel(), of * 64, np.maximum(start + MARGIN, 0)
    one, top = word(1), word(1) << (part - 1).astype(word)
    whole = top | (top - one)
    plus, minus, distance = whole.copy(), np.zeros_like(whole), part.astype(np.int16)
    best = distance.copy()
    for step in range(int(steps.max())):
        equal = masks[of + coded.take(at + step, mode="clip")]
        same = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(diagonal | plus)
        down = plus & diagonal
        distance += (up & top) != 0
        distance -= (down & top) != 0
        up, down = up << one, down << one
        plus = (down | ~(same | up)) & whole
        minus = up & same & whole
        np.minimum(best, distance, out=best)
    return best


def edit_distance_within(item: bytes, window: bytes) -> int:
    """Fewest edits that turn the item into some part of the window: columns of the table as bit vectors."""
    size = len(item)
    masks: dict[int, int] = {}
    for k, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << k
    whole, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, distance = whole, 0, size
    best = size
    for c in window:
        equal = masks.get(c, 0)
        same = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(diagonal | plus) & whole
        down = plus & diagonal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up, down = up << 1 & whole, down << 1 & whole
        plus = down | ~(same | up) & whole
        minus = up & same
        best = min(best, distance)
    return best


def hits(index: Index, texts: list[bytes], most_edits: float = MOST_EDITS) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, word at which it begins) of every item found in a text, at its best place."""
    if not index.items:
        return []
    bodies = [plain(t) for t in texts]
    data = np.frombuffer(b"".join(bodies), np.uint8)
    if not len(data):
        return []
    first = np.append(0, np.cumsum([len(t) for t in bodies])).astype(np.int64)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    last: dict[tuple[int, int], int] = {}
    for text, item, begin in zip(*(x.tolist() for x in candidates(index, data, first, most_edits))):
        size = int(index.sizes[item])
        slack = math.ceil(size * most_edits)
        # the part searched spans a quarter of the slack more, so near places need no search of their own
        if begin - last.get((text, item), -size) <= slack // 4 and (text, item) in last:
            continue
        last[text, item] = begin
        window = bodies[text][max(0, begin - slack) : begin + size + slack + slack // 4 + 1]
        edits = edit_distance_within(index.texts[item], window)
        if edits <= most_edits * size:
            found = (edits, bodies[text].count(b" ", 0, max(0, begin)))
            best[text, item] = min(best.get((text, item), found), found)
    return [(text, item, *found) for (text, item), found in sorted(best.items())]


def item_blocks(
    items: DataFrame, key: str = "item_id", text: str = "text", most_edits: float = MOST_EDITS
) -> Iterator[Index]:
    """Indexes over all items, in blocks of about ``BLOCK_BYTES`` of text, each small enough for every task."""
    sizes = items.select(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, math.ceil(sizes / BLOCK_BYTES))
    of = F.pmod(F.xxhash64(key, text), F.lit(blocks))
    for n in range(blocks):
        rows = items.where(of == n).select(F.col(key).cast("bigint"), text).distinct().collect()
        listed = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        yield build_index(listed, most_edits)


def find_items(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", most_edits: float = MOST_EDITS
) -> DataFrame:
    """Benchmark items found in documents: key, ``item_id``, ``edits``, ``item_chars``, ``at_word``.

    A row for each document and item within ``most_edits`` edits per character of the item, at the item's
    best place. Both sides are lower-cased and reduced to words of letters and digits. Every item that has any
    is looked for, however short; null texts hold nothing. Repeated rows
    give repeated results, null keys are carried, other columns do not matter. The items are the query set:
    each block of them is met by all documents in turn.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    out = None
    for index in item_blocks(items, most_edits=most_edits):
        shared = context.broadcast(index)  # a block's seeds: its size is bounded by BLOCK_BYTES

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, texts in rolling.in_chunks(batches, 1):
                found = hits(shared.value, texts, most_edits)
                if found:
                    of = pa.array([f[0] for f in found])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(of),
                            pa.array([shared.value.items[f[1]] for f in found], pa.int64()),
                            pa.array([f[2] for f in found], pa.int64()),
                            pa.array([len(shared.value.texts[f[1]]) for f in found], pa.int64()),
                            pa.array([f[3] for f in found], pa.int64()),
                        ],
                        [key, "item_id", "edits", "item_chars", "at_word"],
                    )

        part = rows.mapInArrow(
            search, f"`{key}` bigint, item_id bigint, edits bigint, item_chars bigint, at_word bigint"
        )
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows in which no item is found, with all their columns."""
    context = docs.sparkSession.sparkContext
    at = docs.columns.index(text)
    out = docs
    for index in item_blocks(items):
        shared = context.broadcast(index)

        def choose(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, texts in rolling.in_chunks(batches, at):
                clean = np.ones(part.num_rows, bool)
                clean[[f[0] for f in hits(shared.value, [(t or "").encode() for t in texts])]] = False
                yield part.filter(pa.array(clean))

        out = out.mapInArrow(choose, docs.schema)
    return out
