"""Ranked lexical search by MaxScore whose bounds come from term pairs.

The index is kept in shards of bounded size, each with its documents, their lengths and, for every term, the
documents that hold it. For pairs of terms that a set of queries asks for together, each shard also has the
list of documents with both and the largest score that both give jointly. That maximum is often far below the
sum of the two terms' own, as the documents where each peaks are not the same ones.

A query's terms are taken in pairs. A document gains from a pair at most the joint maximum if it stands in the
list, else the larger of the two single maxima. The pairs are taken by falling bound; once the bounds of those
left add up to less than the scores of the best documents so far, no further document can enter, and the
rest is looked up for the remaining candidates only, whose own bounds depend on which lists they stand in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wintide.llm.shared import discard, staged

SHARD_TERMS = 2_000_000  # a shard is closed when its documents hold so many terms
BLOCK_BYTES = 1 << 22  # of query texts searched at once
OUTSIDE = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
TERM_BYTES = bytes(32 if b in OUTSIDE else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other than ASCII, A-Z lower-cased."""
    return text.translate(TERM_BYTES).split()


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shards of documents (``ids``, ``sizes``) and postings (``term``, ``gaps``, ``counts``), as columns a and b.

    Documents without terms are left out; an id may be null. ``gaps`` are the distances between the positions
    in the shard of the documents that hold the term, ``counts`` its occurrences in each. Nothing is
    shuffled: a task indexes the documents it reads.
    """
    rows = docs.select(
        F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    schema = "part string, shard bigint, term binary, a array<bigint>, b array<int>"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, numbers, seen, ids, sizes = 0, {}, [], [], []
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            shard = (TaskContext.get().partitionId() << 32) | number
            number += 1
            yield _rows("docs", shard, [None], [0, len(ids)], pa.array(ids, pa.int64()), np.array(sizes))
            flat = np.concatenate(seen)
            doc = np.repeat(np.arange(len(ids)), sizes)
            code, counts = np.unique(flat * len(ids) + doc, return_counts=True)
            term, doc = np.divmod(code, len(ids))
            starts = np.searchsorted(term, np.arange(len(numbers) + 1))
            gaps = np.diff(doc, prepend=0)
            gaps[starts[:-1]] = doc[starts[:-1]]
            words = list(numbers)
            for at in range(0, len(words), 4_096):
                cut = starts[at : at + 4_097]
                mine = slice(cut[0], cut[-1])
                yield _rows("terms", shard, words[at : at + 4_096], cut - cut[0], gaps[mine], counts[mine])

        for batch in batches:
            for row in range(batch.num_rows):
                words = terms_of(batch.column(1)[row].as_py())
                if not words:
                    continue
                get = numbers.setdefault
                seen.append(np.fromiter((get(w, len(numbers)) for w in words), np.int64, len(words)))
                ids.append(batch.column(0)[row].as_py())
                sizes.append(len(words))
                held += len(words)
                if held >= SHARD_TERMS:
                    yield from close()
                    held, numbers, seen, ids, sizes = 0, {}, [], [], []
        if ids:
            yield from close()

    return staged(rows.mapInArrow(index, schema), "lexical-index", ("part",))


def _documents(index: DataFrame) -> DataFrame:
    return index.where("part = 'docs'").select("shard", F.col("a").alias("ids"), F.col("b").alias("sizes"))


def _postings(index: DataFrame) -> DataFrame:
    return index.where("part = 'terms'").select("shard", "term", F.col("a").alias("gaps"), F.col("b").alias("counts"))


def _rows(part: str, shard: int, words: list, starts, a, b: np.ndarray) -> pa.RecordBatch:
    starts = pa.array(np.asarray(starts), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(words)),
            pa.array(np.full(len(words), shard)),
            pa.array(words, pa.binary()),
            pa.ListArray.from_arrays(starts, pa.array(a, pa.int64())),
            pa.ListArray.from_arrays(starts, pa.array(b.astype(np.int32))),
        ],
        ["part", "shard", "term", "a", "b"],
    )


@dataclass
class Plan:
    """A block of queries: the weight of each term that documents hold, and each query's pairs and single term."""

    documents: int
    length: int
    weights: dict[bytes, int]
    pairs: dict[tuple[bytes, bytes], int] = field(default_factory=dict)
    queries: list[tuple[int, list[tuple[bytes, ...]]]] = field(default_factory=list)

    def add(self, query: int, words: set[bytes]) -> None:
        """Neighbours by weight make a pair: their bounds are alike, so a joint maximum can lower the sum most."""
        ranked = sorted((w for w in words if self.weights.get(w, 0) > 0), key=lambda w: (self.weights[w], w))
        units = [tuple(ranked[k : k + 2]) for k in range(0, len(ranked), 2)]
        for unit in units:
            if len(unit) == 2:
                self.pairs.setdefault(unit, len(self.pairs))
        self.queries.append((query, units))


class Shard:
    """Postings of a shard with the score that each document gains from a term."""

    def __init__(self, plan: Plan, ids: pa.Array, sizes: np.ndarray) -> None:
        self.plan, self.ids = plan, ids.fill_null(0).to_numpy()
        self.named = ids.is_valid().to_numpy(zero_copy_only=False)  # the others gain nothing
        self.norms = 20 * (50 + (50 * sizes * plan.documents) // plan.length)
        self.postings: dict[bytes, tuple[np.ndarray, np.ndarray, int]] = {}
        self.joint: dict[tuple[bytes, bytes], tuple[np.ndarray, int]] = {}

    def add(self, term: bytes, gaps: np.ndarray, counts: np.ndarray) -> None:
        docs = np.cumsum(gaps)
        gains = self.plan.weights[term] * ((1_000_000_000 * counts) // (1_000 * counts + self.norms[docs]))
        gains *= self.named[docs]
        self.postings[term] = docs, gains, int(gains.max())

    def pair(self, unit: tuple[bytes, bytes]) -> tuple[np.ndarray, int] | None:
        """Documents with both terms and the largest score both give; none if a term is missing here."""
        if unit[0] not in self.postings or unit[1] not in self.postings:
            return None
        (a, x, _), (b, y, _) = (self.postings[t] for t in unit)
        both, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        return both, int((x[at] + y[to]).max()) if len(both) else 0

    def bounds(self, unit: tuple[bytes, ...]) -> tuple[int, int]:
        """The most that a document gains from the unit if it stands in its list, and if not."""
        single = max((self.postings[t][2] for t in unit if t in self.postings), default=0)
        return (self.joint[unit][1] if unit in self.joint else 0), single

    def search(self, units: list[tuple[bytes, ...]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the ``k`` best documents, of more where the last ones score alike."""
        ranked = sorted(((max(self.bounds(u)), u) for u in units), key=lambda x: (-x[0], x[1]))
        ranked = [(bound, unit) for bound, unit in ranked if bound]
        left = sum(bound for bound, _ in ranked)
        scores = np.zeros(len(self.ids), np.int64)
        least, at = 1, 0
        for _, unit in ranked:
            for term in unit:
                if term in self.postings:
                    docs, gains, _ = self.postings[term]
                    scores[docs] += gains
            at += 1
            left -= max(self.bounds(unit))
            if left < scores.max():
                least = max(least, _kth(scores, k))
            if left < least:
                break
        open_ = np.flatnonzero(scores + left >= least)
        open_ = open_[scores[open_] > 0]
        gained = scores[open_]
        rest = ranked[at:]
        # what each candidate can still gain, by the lists it stands in
        most = np.zeros(len(open_), np.int64)
        spare = []
        for _, unit in rest:
            joint, single = self.bounds(unit)
            each = np.full(len(open_), single)
            if unit in self.joint:
                each[_stands_in(open_, self.joint[unit][0])[0]] = joint
            spare.append(each)
            most += each
        for n, (_, unit) in enumerate(rest):
            least = max(least, _kth(gained, k))
            keep = gained + most >= least
            if not keep.all():
                open_, gained, most = open_[keep], gained[keep], most[keep]
                spare[n:] = [s[keep] for s in spare[n:]]
            most -= spare[n]
            for term in unit:
                if term in self.postings:
                    docs, gains, _ = self.postings[term]
                    found, where = _stands_in(open_, docs)
                    gained[found] += gains[where]
        least = max(least, _kth(gained, k))
        keep = gained >= least
        return open_[keep], gained[keep]


def _stands_in(some: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``some`` of those that ``docs`` has, and theirs in ``docs``; both are sorted."""
    where = np.minimum(np.searchsorted(docs, some), len(docs) - 1)
    found = np.flatnonzero(docs[where] == some) if len(docs) else np.zeros(0, np.int64)
    return found, where[found] if len(docs) else found


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def _by_shard(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[tuple[int, Shard]]:
    """Shards one after the other; rows are sorted by shard, its documents first, then terms, then pair lists."""
    number, shard = None, None
    names = {n: unit for unit, n in plan.pairs.items()}
    for batch in batches:
        numbers = batch.column(0).to_numpy()
        for row in range(batch.num_rows):
            if numbers[row] != number:
                if shard is not None:
                    yield number, shard
                number, shard = numbers[row], None
            a, b = (batch.column(n)[row].values for n in (3, 4))
            if batch.column(1)[row].as_py() == 0:
                shard = Shard(plan, a, b.to_numpy().astype(np.int64))
            elif batch.column(1)[row].as_py() == 1:
                shard.add(batch.column(2)[row].as_py(), a.to_numpy(), b.to_numpy().astype(np.int64))
            else:
                unit = names[int.from_bytes(batch.column(2)[row].as_py(), "big")]
                # the list's last entry is the joint maximum
                shard.joint[unit] = np.cumsum(a[:-1].to_numpy()), a[len(a) - 1].as_py()
    if shard is not None:
        yield number, shard


def _parts(index: DataFrame, words: DataFrame) -> DataFrame:
    """Documents of the shards and the postings of the block's terms."""
    docs = _documents(index).select(
        "shard", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("name"), F.col("ids").alias("a"), F.col("sizes").alias("b")
    )
    mine = _postings(index).join(F.broadcast(words), "term", "left_semi")
    return docs.unionByName(
        mine.select("shard", F.lit(1).alias("kind"), F.col("term").alias("name"), F.col("gaps").alias("a"), F.col("counts").alias("b"))
    )


def _sorted_shards(rows: DataFrame) -> DataFrame:
    return rows.repartition("shard").sortWithinPartitions("shard", "kind", "name")


def pair_lists(index: DataFrame, words: DataFrame, plan) -> DataFrame:
    """The intersection lists of all shards: the pair's number, the gaps of its documents and, last, its joint maximum."""

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, shard in _by_shard(batches, plan.value):
            names, lists = [], []
            for unit, n in plan.value.pairs.items():
                found = shard.pair(unit)
                if found is not None:
                    names.append(n.to_bytes(4, "big"))
                    lists.append(np.append(np.diff(found[0], prepend=0), found[1]))
                if names and (len(names) == 512):
                    yield _pair_rows(number, names, lists)
                    names, lists = [], []
            if names:
                yield _pair_rows(number, names, lists)

    rows = _sorted_shards(_parts(index, words))
    return staged(rows.mapInArrow(intersect, "shard bigint, name binary, a array<bigint>"), "pair-lists")


def _pair_rows(shard: int, names: list[bytes], lists: list[np.ndarray]) -> pa.RecordBatch:
    starts = np.append(0, np.cumsum([len(x) for x in lists]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(names), shard)),
            pa.array(names, pa.binary()),
            pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(lists), pa.int64())),
        ],
        ["shard", "name", "a"],
    )


def search_block(index: DataFrame, lists: DataFrame, words: DataFrame, plan, k: int) -> DataFrame:
    """``query``, ``id`` and ``score`` of every shard's best documents for each query of the block."""
    rows = _parts(index, words).unionByName(
        lists.select("shard", F.lit(2).alias("kind"), "name", "a", F.lit(None).cast("array<int>").alias("b"))
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard in _by_shard(batches, plan.value):
            for query, units in plan.value.queries:
                at, scores = shard.search(units, k)
                if len(at):
                    order = np.lexsort((shard.ids[at], -scores))[:k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(order), query)), pa.array(shard.ids[at][order]), pa.array(scores[order])],
                        ["query", "id", "score"],
                    )

    return _sorted_shards(rows).mapInArrow(find, "query bigint, id bigint, score bigint")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` documents of highest score for every item: the item's and the document's key, ``rank`` and ``score``.

    The score is an integer form of a saturating weight: a term of weight w that occurs tf times in a document of
    n terms gives w * ((10**9 * tf) div (1000 * tf + 20 * m)), m = 50 + (50 * n * N) div L; w is
    floor(1000 * ln((2 * N + 2) / (2 * df + 1))). Ties go to the smaller key, only scores above 0 count.

    Every row is a document, repeated rows and keys included. Rows with a null key count for N, L and df, but cannot
    be named and are not returned; null texts and texts without terms count nowhere. Items with a null key or
    without terms get no rows; items that repeat get theirs once for each row. Empty tables give no rows.

    Items of equal text are searched once. They are taken in blocks of about ``BLOCK_BYTES``, dealt by hash, one
    block at a time; the driver and the broadcasts hold one block.
    """
    spark = docs.sparkSession
    index = build_index(docs, key, text)
    length = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda s, x: s + x)
    totals = _documents(index).agg(F.sum(F.size("ids")).alias("n"), F.sum(length).alias("l")).first()
    named = staged(
        items.select(F.col(item_key).alias("item"), F.col(item_text).cast("binary").alias("words")).where(
            "item is not null and words is not null"
        ),
        "items",
    )
    number = F.monotonically_increasing_id().alias("query")
    queries = staged(named.select("words").distinct().select(number, "words"), "item-texts")
    kinds = items.schema[item_key].dataType.simpleString(), docs.schema[key].dataType.simpleString()
    total = queries.agg(F.sum(F.length("words"))).first()[0]
    if not total or not totals["n"]:
        return spark.createDataFrame([], f"`{item_key}` {kinds[0]}, rank int, `{key}` {kinds[1]}, score bigint")
    blocks = -(-total // BLOCK_BYTES)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    found = None
    for block in range(blocks):
        texts = queries.where(F.pmod(F.hash("words"), F.lit(blocks)) == block).collect()
        asked = [(row["query"], set(terms_of(bytes(row["words"])))) for row in texts]
        words = spark.createDataFrame([(w,) for w in sorted(set().union(*(a[1] for a in asked)))], "term binary")
        weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * totals["n"] + 2) / (2 * F.col("df") + 1)))
        held = (
            _postings(index)
            .join(F.broadcast(words), "term", "left_semi")
            .groupBy("term")
            .agg(F.sum(F.size("gaps")).alias("df"))
            .select("term", weight.alias("w"))
            .collect()
        )
        plan = Plan(totals["n"], totals["l"], {bytes(r["term"]): r["w"] for r in held})
        for query, mine in asked:
            plan.add(query, mine)
        shared = spark.sparkContext.broadcast(plan)
        lists = pair_lists(index, words, shared)
        ranks = search_block(index, lists, words, shared, k).withColumn("rank", place).where(F.col("rank") <= k)
        part = staged(ranks, "ranked")
        discard(lists)
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    discard(index)
    return named.join(queries, "words").join(found, "query").select(
        F.col("item").alias(item_key),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").cast(kinds[1]).alias(key),
        "score",
    )
