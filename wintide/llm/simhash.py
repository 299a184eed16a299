"""SimHash fingerprints, linked within a radius by meet-in-the-middle ball hashing.

Two fingerprints within 4 bits differ in at most 2 bits of one of their halves, and then both reach a
common value of that half by changing at most one bit. So every fingerprint emits, for each half, all
values within half of that half's radius, and whoever shares a value is compared. Of the links within a
bucket only a spanning forest leaves the task: fewer rows than members. A bucket too large to compare in
full is hashed once more in the same way, now over all 64 bits: its members emit the whole variants
within 2 bits that have the bucket's half. Members of such a ball are within 4 bits of each other, so each
is linked to the first one only, and no group of copies is ever paired out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wintide.llm import rolling
from wintide.llm.components import connected
from wintide.llm.shared import staged

SHINGLE = 4
RADIUS = 4
SEED = 42
COMPARED = 1024  # half as many comparisons of a member in memory cost less than its up to 529 variants shuffled
PIECE = 1 << 16
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if over half of the shingles' hashes have it; 0 for a text without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    take = min(shingle, len(words))
    count = len(words) - take + 1
    starts, ends = starts[:count].tolist(), ends[take - 1 :].tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, count, PIECE):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + PIECE], ends[at : at + PIECE])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``print`` (the 64 bits as a signed number) and ``hash`` (of the text) of every row.

    A null text has no words, like an empty one.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in rolling.in_chunks(iter([batch]), 1):
                prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints), part.column(2)], ["id", "print", "hash"])

    rows = docs.select(
        F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    return rows.select("id", "text", F.xxhash64("text").alias("hash")).mapInArrow(compute, "id bigint, print bigint, hash bigint")


def _masks(first: int, bits: int, most: int) -> list[int]:
    """Bit patterns with at most ``most`` bits set, all between ``first`` and ``first + bits``; signed."""
    out = []
    for n in range(most + 1):
        for chosen in combinations(range(first, first + bits), n):
            value = sum(1 << b for b in chosen)
            out.append(value - (1 << 64) if value >= 1 << 63 else value)
    return out


def links(prints: DataFrame, radius: int = RADIUS, compared: int = COMPARED) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct prints within ``radius`` bits of each other.

    Every link joins prints within the radius, and prints within the radius are linked directly or
    through prints of one ball.
    """
    near = radius // 2  # one half differs by so many bits at most
    reach = -(-near // 2)
    half = {0: 0xFFFFFFFF, 1: 0xFFFFFFFF << 32}
    emitted = []
    for n in (0, 1):
        value = F.when(F.lit(n == 0), F.col("print").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(
            F.shiftrightunsigned("print", 32)
        )
        variant = F.explode(F.array(*[F.lit(m).cast("bigint") for m in _masks(0, 32, reach)]))
        emitted.append(
            prints.select("print", value.alias("value"), variant.alias("mask")).select(
                F.col("value").bitwiseXOR(F.col("mask")).bitwiseOR(F.lit(n << 32)).alias("bucket"), "print"
            )
        )
    rows = emitted[0].unionByName(emitted[1])
    outer = -(-radius // 2)
    ball = {n: [np.array(_masks(32 * (1 - n), 32, m), np.int64).view(np.uint64) for m in range(outer + 1)] for n in (0, 1)}

    def judged(buckets: np.ndarray, prints_: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All rows of some buckets, in order."""
        new = np.append(True, buckets[1:] != buckets[:-1])
        run = np.cumsum(new) - 1
        large = np.bincount(run)[run] > compared
        if large.any():
            yield from balls(buckets[large], prints_[large])
        small_runs, small = run[~large], prints_[~large]
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for step in range(1, compared):
            same = np.flatnonzero(small_runs[step:] == small_runs[:-step])
            if not len(same):
                break
            same = same[np.bitwise_count(small[same] ^ small[same + step]) <= radius].astype(np.int32)
            ends.append((same, same + np.int32(step)))
        if ends:
            a, b = (np.concatenate(e) for e in zip(*ends))
            tree = _forest(a, b, len(small))
            if len(tree):
                yield _link_rows(small[a[tree]], small[b[tree]], None)

    def balls(buckets: np.ndarray, prints_: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole variants that share the bucket's half and lie within half the radius."""
        for n in (0, 1):
            mine = (buckets >> 32) == n
            for at in range(0, int(mine.sum()), 2_000):
                own = prints_[mine][at : at + 2_000]
                halves = (buckets[mine][at : at + 2_000].view(np.uint64) & np.uint64(0xFFFFFFFF)) << np.uint64(32 * n)
                used = np.bitwise_count((own & np.uint64(half[n])) ^ halves)
                for spent in range(reach + 1):
                    chosen = used == spent
                    if chosen.any():
                        rest = own[chosen] & ~np.uint64(half[n])
                        centres = (halves[chosen] | rest)[:, None] ^ ball[n][outer - spent][None, :]
                        owners = np.repeat(own[chosen], centres.shape[1])
                        yield _link_rows(owners, None, centres.ravel())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_p, open_large = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            buckets, own = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if open_large is not None:
                cut = int(np.searchsorted(buckets, open_large, "right"))
                if cut:
                    yield from balls(buckets[:cut], own[:cut])
                buckets, own = buckets[cut:], own[cut:]
            if not len(buckets):
                continue
            open_large = None
            buckets, own = np.append(held_b, buckets), np.append(held_p, own)
            whole = int(np.searchsorted(buckets, buckets[-1]))
            if whole:
                yield from judged(buckets[:whole], own[:whole])
            held_b, held_p = buckets[whole:], own[whole:]
            if len(held_b) > compared:
                yield from balls(held_b, held_p)
                open_large = held_b[0]
                held_b, held_p = held_b[:0], held_p[:0]
        if len(held_b):
            yield from judged(held_b, held_p)

    found = staged(
        rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare, "a bigint, b bigint, centre bigint"),
        "simhash-buckets",
    )

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_centre, last_first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            centres, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.append(True, centres[1:] != centres[:-1])
            if last_centre == centres[0]:
                new[0] = False
            at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            first = np.where(at >= 0, own[at], last_first if last_first is not None else 0)
            other = first != own
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(own[other]), pa.array(first[other])], ["a", "b"])
            last_centre, last_first = centres[-1], first[-1]

    from_balls = (
        found.where("centre is not null")
        .select("centre", "a")
        .repartition("centre")
        .sortWithinPartitions("centre", "a")
        .mapInArrow(stars, "a bigint, b bigint")
    )
    return found.where("b is not null").select("a", "b").unionByName(from_balls).distinct()


def _forest(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """Positions of links that span what all links ``a``-``b`` connect, without a cycle.

    Every tree picks its first link to another tree and joins it, until no link leads out of a tree.
    """
    tree = np.arange(nodes)
    open_, picked = np.arange(len(a)), []
    while True:
        x, y = tree[a[open_]], tree[b[open_]]
        out = x != y
        open_, x, y = open_[out], x[out], y[out]
        if not len(open_):
            return np.concatenate(picked) if picked else open_
        least = np.full(nodes, len(a))
        np.minimum.at(least, x, open_)
        np.minimum.at(least, y, open_)
        joining = np.unique(least[least < len(a)])
        picked.append(joining)
        x, y = tree[a[joining]], tree[b[joining]]
        root = np.arange(nodes)
        while True:
            low = np.minimum(root[x], root[y])
            before = root.copy()
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
            root = root[root]
            if (root == before).all():
                break
        tree = root[tree]


def _link_rows(a: np.ndarray, b: np.ndarray | None, centre: np.ndarray | None) -> pa.RecordBatch:
    column = lambda x: pa.nulls(len(a), pa.int64()) if x is None else pa.array(x.view(np.int64))
    return pa.RecordBatch.from_arrays([column(a), column(b), column(centre)], ["a", "b", "centre"])


def _rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """Distinct prints with the ``root`` of the component that each belongs to."""
    roots = connected(links(nodes.select("print"), radius))
    return nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprint and component of every row: ``fingerprint`` (16 hex digits) and ``component_id``.

    The component is the smallest id reachable over links. Rows with one fingerprint are one node, so
    exact copies, empty and null texts (fingerprint 0) cost a row each. Null ids take part but are never
    the smallest; a component of null ids alone has a null id. Other columns do not matter.
    """
    if radius > 4:
        raise ValueError("halves meet in the middle up to a radius of 4")
    prints = staged(fingerprints(docs, shingle, key, text), "fingerprints")
    rooted = _rooted(prints.groupBy("print").agg(F.min("id").alias("first")), radius)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = rooted.join(least, "root").select("print", "component_id")
    return prints.join(labelled, "print").select(
        F.col("id").alias(key),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id, then the smallest hash of the text.

    Rows of one id but different texts are told apart, so none goes unless its component keeps another. Null
    ids come last, so such a row stays only where its component has no id. Null and empty texts are one
    component. Of rows that repeat id and text, the first by their JSON form stays. An empty table stays empty.
    """
    prints = staged(fingerprints(docs, shingle, key, text), "fingerprints")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "hash")
    rooted = _rooted(prints.groupBy("print").agg(F.min(place).alias("first")), radius)
    chosen = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.hash")
    counted = prints.groupBy("id", "hash").agg(F.count(F.lit(1)).alias("rows"))
    same = F.col("chosen.id").eqNullSafe(F.col("counted.id")) & (F.col("chosen.hash") == F.col("counted.hash"))
    kept = staged(
        chosen.alias("chosen").join(counted.alias("counted"), same).select("chosen.id", "chosen.hash", "rows"), "kept-rows"
    )
    mine = docs[key].cast("bigint"), F.xxhash64(F.coalesce(docs[text], F.lit("")).cast("binary"))
    once, often = (
        docs.join(kept.where(some), mine[0].eqNullSafe(kept["id"]) & (mine[1] == kept["hash"]), "left_semi")
        for some in (F.col("rows") == 1, F.col("rows") > 1)
    )
    number = next(f"row_{n}" for n in range(len(docs.columns) + 1) if f"row_{n}" not in docs.columns)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    first = Window.partitionBy(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit("")))).orderBy(whole)
    return once.unionByName(often.withColumn(number, F.row_number().over(first)).where(F.col(number) == 1).drop(number))
