"""Exact substring removal over a logarithmic family of suffix indexes.

Documents come in batches. A batch gets its own sorted array of sampled suffixes (``repeats``); levels
hold such arrays for 1, 2, 4, ... batches. A new batch is merge-scanned against the levels: rows of all
arrays that start the same meet, and the scan finds the long matches among them. Where a level has the
size of what comes in, the two merge into one of twice the size, as a binary counter carries, so a suffix
is rewritten a logarithmic number of times. The order is that of the suffixes' hashed beginnings: only
equality over the match length counts, and hashes sort and store in eight bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wintide.llm import repeats, rolling
from wintide.llm.shared import drop_folder, fresh_folder

LEAST_MATCH = 400
ANCHOR = 128
BATCHES = 4


class SuffixLevels:
    """Levels in the shared folder: number of batches in each, and where it lies."""

    def __init__(self, spark: SparkSession, shape: repeats.Shape) -> None:
        self.spark, self.shape = spark, shape
        self.levels: list[tuple[int, str]] = []

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def _with_levels(self, docs: DataFrame) -> DataFrame:
        rows = repeats.suffix_classes(docs, self.shape)
        for _, path in self.levels:
            rows = rows.unionByName(self._read(path))
        return repeats.merged(rows)

    def add(self, docs: DataFrame) -> None:
        """Takes a batch in; equal-sized levels merge with it."""
        rows, size, old = repeats.suffix_classes(docs, self.shape), 1, []
        while self.levels and self.levels[-1][0] == size:
            size, path = size * 2, self.levels.pop()[1]
            rows = rows.unionByName(self._read(path))
            old.append(path)
        path = fresh_folder(self.spark, f"suffix-level-{size}")
        repeats.merged(rows).write.parquet(path)
        self.levels.append((size, path))
        for path in old:
            drop_folder(self.spark, path)

    def scan(self, docs: DataFrame) -> DataFrame:
        """Merge scan of a batch that is not taken in, against all levels: the merged classes."""
        return self._with_levels(docs)

    def drop(self) -> None:
        for _, path in self.levels:
            drop_folder(self.spark, path)
        self.levels = []


def byte_shape(least: int = LEAST_MATCH, anchor: int = ANCHOR) -> repeats.Shape:
    return repeats.Shape(rolling.byte_units, least, min(anchor, least), keep_first=False)


def remove_repeats(
    docs: DataFrame,
    least: int = LEAST_MATCH,
    anchor: int = ANCHOR,
    batches: int = BATCHES,
    key: str = "doc_id",
    text: str = "text",
    kept: bool = True,
) -> DataFrame:
    """Every text without the bytes that lie in a ``least``-byte string which starts anywhere else too.

    Returns the key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and,
    if asked for, ``kept`` (binary: a cut may fall inside a character). Texts are UTF-8 bytes, a null text
    is empty, and matches do not cross documents. One row for each row; rows that repeat an id and its
    text match each other. Null ids count as one larger than all. Other columns do not matter.
    """
    spark, shape = docs.sparkSession, byte_shape(least, anchor)
    rows = repeats.identified(docs, key, text)
    of = F.pmod(F.xxhash64("id", "tie"), F.lit(batches))
    family = SuffixLevels(spark, shape)
    for n in range(batches - 1):
        family.add(rows.where(of == n))
    # the last batch is scanned against the levels, and matches of all batches show in that scan
    parts = repeats.repeated_parts(rows, family.scan(rows.where(of == batches - 1)), shape)
    joined = rows.join(parts, ["id", "tie"], "left").select("id", "text", "parts")
    name = f"`{key}` bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out: list[list] = [[], [], [], [], []]
                for data, covered in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    spans = repeats.merged_parts(covered or [])
                    pieces, last = [], 0
                    for start, end in spans:
                        pieces.append(data[last:start])
                        last = end
                    left = b"".join([*pieces, data[last:]])
                    values = (len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left)
                    for column, value in zip(out, values):
                        column.append(value)
                ids = part.column(0).to_numpy()
                columns = [
                    pa.array(ids, mask=ids == repeats.LARGEST_ID),
                    *[pa.array(c, pa.int64()) for c in out[:3]],
                    pa.array(out[3], pa.string()),
                ]
                names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if kept:
                    columns.append(pa.array(out[4], pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(cut, name + (", kept binary" if kept else ""))
