"""Repeated windows of a corpus: which windows of which documents occur elsewhere too.

Shared by the two repeat removers. Suffixes are sampled: a suffix is kept where it starts at the anchor of
some window (see ``rolling``), so that equal windows always meet under one sampled suffix. A *class* is
all occurrences of one suffix whose windows cover the same content. Classes of one member whose suffix
starts like no other need no more work; those of several members repeat as a whole; and classes whose
suffixes start alike but differ in what they cover are compared window by window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wintide.llm import rolling
from wintide.llm.shared import staged

LARGEST_ID = (1 << 63) - 1
MOST_IN_TASK = 20_000


class Shape(NamedTuple):
    """What counts as a unit, how long windows and anchors are, and whether a first occurrence stays."""

    units: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    width: int
    k: int
    keep_first: bool


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id`` (null: larger than any), ``tie`` (tells texts of one id apart) and the text's bytes."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(LARGEST_ID)).alias("id"),
        F.xxhash64(body).alias("tie"),
        body.cast("binary").alias("text"),
    )


def suffix_classes(docs: DataFrame, shape: Shape) -> DataFrame:
    """Sampled suffixes, those of one class within a piece of a task's rows already made one row.

    ``suffix`` hashes how it starts, ``seen`` what its windows cover, ``n`` counts occurrences; ``id``,
    ``tie`` and ``start`` are of the first one.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.in_chunks(batches, 2):
            found = rolling.anchors_of(*shape.units(texts), shape.width, shape.k)
            if not len(found.doc):
                continue
            ids, ties = part.column(0).to_numpy()[found.doc], part.column(1).to_numpy()[found.doc]
            order = np.lexsort((found.start, ties, ids, found.seen, found.anchor))
            anchor, seen = found.anchor[order], found.seen[order]
            new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (seen[1:] != seen[:-1])))
            pick = order[new]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.anchor[pick].view(np.int64)),
                    pa.array(found.seen[pick].view(np.int64)),
                    pa.array(np.diff(np.append(new, len(order)))),
                    pa.array(ids[pick]),
                    pa.array(ties[pick]),
                    pa.array(found.start[pick].astype(np.int32)),
                    pa.array(found.count[pick].astype(np.int32)),
                    pa.array(found.before[pick].astype(np.int32)),
                ],
                ["suffix", "seen", "n", "id", "tie", "start", "count", "before"],
            )

    return docs.mapInArrow(
        sample, "suffix bigint, seen bigint, n bigint, id bigint, tie bigint, start int, count int, before int"
    )


def merged(classes: DataFrame) -> DataFrame:
    """Classes from several batches, in suffix order within each partition; equal ones become one."""
    first = F.min(F.struct("id", "tie", "start")).alias("first")
    return (
        classes.repartition("suffix")
        .groupBy("suffix", "seen")
        .agg(F.sum("n").alias("n"), first, F.first("count").alias("count"), F.first("before").alias("before"))
        .select("suffix", "seen", "n", "first.*", "count", "before")
    )


def repeated_classes(classes: DataFrame) -> DataFrame:
    """Merged classes that repeat, or may: ``alike`` counts the classes whose suffixes start the same."""
    alike = F.count(F.lit(1)).over(Window.partitionBy("suffix"))
    return classes.withColumn("alike", alike).where("n > 1 or alike > 1")


def _windows(docs: DataFrame, wanted: DataFrame, shape: Shape) -> DataFrame:
    """The wanted classes with the hashes of their windows (as bytes), read from the first occurrence's text."""
    by_doc = wanted.groupBy("id", "tie").agg(
        F.collect_list(F.struct("suffix", "seen", "start", "count", "before")).alias("wanted")
    )
    joined = docs.join(by_doc, ["id", "tie"]).select("id", "tie", "text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.in_chunks(batches, 2):
            units, bounds = shape.units(texts)
            asked = part.column(3)
            rows = asked.flatten()
            sizes = asked.value_lengths().to_numpy()
            doc = np.repeat(np.arange(len(texts)), sizes)
            start, count = rows.field(2).to_numpy(), rows.field(3).to_numpy()
            at = np.repeat(bounds[doc] + start - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
            hashes = rolling.window_hashes(units, at, shape.width)
            ends = np.append(0, np.cumsum(count)) * 8
            for lo in range(0, len(count), 2_000):
                hi = min(lo + 2_000, len(count))
                data = hashes[ends[lo] // 8 : ends[hi] // 8].tobytes()
                blob = pa.Array.from_buffers(
                    pa.binary(),
                    hi - lo,
                    [None, pa.py_buffer((ends[lo : hi + 1] - ends[lo]).astype(np.int32)), pa.py_buffer(data)],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.field(0).slice(lo, hi - lo),
                        rows.field(1).slice(lo, hi - lo),
                        part.column(0).take(pa.array(doc[lo:hi])),
                        part.column(1).take(pa.array(doc[lo:hi])),
                        pa.array((start[lo:hi] + rows.field(4).to_numpy()[lo:hi]).astype(np.int32)),
                        blob,
                    ],
                    ["suffix", "seen", "id", "tie", "anchor_at", "windows"],
                )

    return joined.mapInArrow(
        cut, "suffix bigint, seen bigint, id bigint, tie bigint, anchor_at int, windows binary"
    )


def _runs(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of neighbouring windows: row, first window, end. Input is sorted by row, then window."""
    new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (at[1:] != at[:-1] + 1)))
    last = np.append(new[1:], len(rows)) - 1
    return rows[new], at[new], at[last] + 1


def _compare_in_tasks(windows: DataFrame, shape: Shape) -> DataFrame:
    """Runs of repeated windows of each class; all classes whose suffixes start alike meet in one task."""

    def judge(table: pa.Table) -> pa.RecordBatch:
        suffix, seen = table["suffix"].to_numpy(), table["seen"].to_numpy()
        order = np.lexsort((seen, suffix))  # a document listed twice gives its classes twice
        new = np.append(True, (np.diff(suffix[order]) != 0) | (np.diff(seen[order]) != 0))[: len(order)]
        table = table.take(pa.array(order[new]))
        sizes = np.array([len(x) // 8 for x in table["windows"].to_pylist()], np.int64)
        hashes = np.frombuffer(b"".join(table["windows"].to_pylist()), np.uint64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(hashes)) - np.repeat(np.append(0, np.cumsum(sizes)[:-1]), sizes)
        if shape.keep_first:
            column = lambda name: table[name].to_numpy()[row]
            order = np.lexsort((column("anchor_at"), column("tie"), column("id"), hashes))
        else:
            order = np.argsort(hashes, kind="stable")
        again = np.append(False, hashes[order][1:] == hashes[order][:-1])
        if not shape.keep_first:
            again |= np.append(again[1:], False)
        hit = np.sort(order[again])
        rows, first, end = _runs(row[hit], at[hit]) if len(hit) else (hit, hit, hit)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(table["suffix"].to_numpy()[rows]),
                pa.array(table["seen"].to_numpy()[rows]),
                pa.array(first.astype(np.int32)),
                pa.array(end.astype(np.int32)),
            ],
            ["suffix", "seen", "from", "to"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            suffixes = batch.column(0).to_numpy()
            whole = int(np.searchsorted(suffixes, suffixes[-1]))
            if whole or (len(held) > 1 and held[-2].column(0)[-1].as_py() != suffixes[0]):
                yield judge(pa.Table.from_batches([*held[:-1], batch.slice(0, whole)]))
                held = [batch.slice(whole)]
        if held:
            yield judge(pa.Table.from_batches(held))

    return windows.repartition("suffix").sortWithinPartitions("suffix").mapInArrow(
        compare, "suffix bigint, seen bigint, from int, to int"
    )


def _compare_by_rows(windows: DataFrame, shape: Shape) -> DataFrame:
    """The same for suffixes with very many classes: a row for each window, so no task meets them all."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                blobs = part.column(5).to_pylist()
                sizes = np.array([len(b) // 8 for b in blobs])
                row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                at = np.arange(sizes.sum()) - np.repeat(np.append(0, np.cumsum(sizes)[:-1]), sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c).take(row) for c in range(5)],
                        pa.array(at.astype(np.int32)),
                        pa.array(np.frombuffer(b"".join(blobs), np.int64)),
                    ],
                    ["suffix", "seen", "id", "tie", "anchor_at", "at", "hash"],
                )

    rows = windows.dropDuplicates(["suffix", "seen"]).mapInArrow(
        spread, "suffix bigint, seen bigint, id bigint, tie bigint, anchor_at int, at int, hash bigint"
    )
    place = F.struct("id", "tie", "anchor_at")
    known = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    hit = rows.join(known, "hash")
    if shape.keep_first:
        hit = hit.where(place != F.col("first"))
    return hit.select("suffix", "seen", F.col("at").alias("from"), (F.col("at") + 1).alias("to"))


def _members(docs: DataFrame, shape: Shape) -> DataFrame:
    """Every occurrence of every sampled suffix; those of one class in one document share a row."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.in_chunks(batches, 2):
            found = rolling.anchors_of(*shape.units(texts), shape.width, shape.k)
            if not len(found.doc):
                continue
            order = np.lexsort((found.start, found.seen, found.anchor, found.doc))
            doc, anchor, seen = found.doc[order], found.anchor[order], found.seen[order]
            new = np.flatnonzero(
                np.append(True, (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (seen[1:] != seen[:-1]))
            )
            pick = pa.array(doc[new])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[new].view(np.int64)),
                    pa.array(seen[new].view(np.int64)),
                    part.column(0).take(pick),
                    part.column(1).take(pick),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(new, len(order)).astype(np.int32)),
                        pa.array(found.start[order].astype(np.int32)),
                    ),
                ],
                ["suffix", "seen", "id", "tie", "starts"],
            )

    return docs.mapInArrow(sample, "suffix bigint, seen bigint, id bigint, tie bigint, starts array<int>")


def repeated_parts(docs: DataFrame, classes: DataFrame, shape: Shape) -> DataFrame:
    """Covered parts of each document: ``id``, ``tie`` and ``parts``, an array of (from, to) in units.

    ``docs`` as ``identified`` makes them; ``classes`` are merged classes of all documents.
    """
    repeated = staged(repeated_classes(classes), "repeated-classes")
    asked = repeated.where("alike > 1")
    in_tasks = _windows(docs, asked.where(F.col("alike") <= MOST_IN_TASK), shape)
    by_rows = _windows(docs, asked.where(F.col("alike") > MOST_IN_TASK), shape)
    runs = (
        _compare_in_tasks(in_tasks, shape)
        .unionByName(_compare_by_rows(by_rows, shape))
        .groupBy("suffix", "seen")
        .agg(F.collect_list(F.struct("from", "to")).alias("runs"))
    )
    judged = repeated.select(
        "suffix", "seen", "n", F.struct("id", "tie", "start").alias("first"), "count"
    ).join(runs, ["suffix", "seen"], "left")
    judged = judged.where("n > 1 or runs is not null")
    met = _members(docs, shape).join(judged, ["suffix", "seen"])
    found = met.select("id", "tie", F.explode("starts").alias("start"), "n", "first", "count", "runs")
    whole = F.col("n") > 1
    if shape.keep_first:
        whole = whole & (F.struct("id", "tie", "start") != F.col("first"))
    parts: Column = F.when(
        whole, F.array(F.struct(F.lit(0).alias("from"), F.col("count").alias("to")))
    ).otherwise(F.coalesce("runs", F.expr("cast(array() as array<struct<`from`:int,`to`:int>>)")))
    covered = found.select("id", "tie", "start", F.inline(parts)).select(
        "id",
        "tie",
        F.struct(
            (F.col("start") + F.col("from")).alias("from"),
            (F.col("start") + F.col("to") - 1 + shape.width).alias("to"),
        ).alias("part"),
    )
    return covered.groupBy("id", "tie").agg(F.collect_set("part").alias("parts"))


def merged_parts(parts: list[dict]) -> list[tuple[int, int]]:
    """Overlapping and touching parts made one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((p["from"], p["to"]) for p in parts):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
