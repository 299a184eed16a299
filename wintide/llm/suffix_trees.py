"""Repeated word windows by prefix-partitioned suffix trees.

Suffixes (sampled, see ``repeats``) are dealt out by their prefix: first its ``anchor`` words, and where
the suffixes of one such prefix would not fit a task, all words of the window. Each group is one subtree.
Its nodes at the depth of a window are the window contents that its suffixes pass through; a node with
several leaves below it is a repeat, and extending repeats by neighbouring windows makes them maximal.
Leaves are ordered by document and place, so the first occurrence is known and stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wintide.llm import repeats, rolling

LEAST_WORDS = 20
ANCHOR = 8


def word_shape(least: int = LEAST_WORDS, anchor: int = ANCHOR) -> repeats.Shape:
    return repeats.Shape(rolling.word_units, least, min(anchor, least), keep_first=True)


def remove_repeated_words(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    anchor: int = ANCHOR,
    key: str = "doc_id",
    text: str = "text",
    kept: bool = True,
) -> DataFrame:
    """Every text without the words of ``least``-word windows that also start earlier.

    Earlier means a smaller id, or the same document and an earlier start. Returns the key, ``n_words``,
    ``n_removed``, ``kept_sha256`` and, if asked for, ``kept`` (the words that stay, joined by one space).
    Words are runs of bytes other than the six ASCII spaces; a null text has none. One row for each row.
    Different texts of one id are ordered by their hashes; rows that repeat id and text are one document
    listed again and do not remove each other. Null ids come last. Other columns do not matter.
    """
    shape = word_shape(least, anchor)
    rows = repeats.identified(docs, key, text)
    classes = repeats.merged(repeats.suffix_classes(rows, shape))
    parts = repeats.repeated_parts(rows, classes, shape)
    joined = rows.join(parts, ["id", "tie"], "left").select("id", "text", "parts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out: list[list] = [[], [], [], []]
                for data, covered in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = data.split()
                    left, last = [], 0
                    for start, end in repeats.merged_parts(covered or []):
                        left += words[last:start]
                        last = end
                    left += words[last:]
                    joined_words = b" ".join(left)
                    digest = hashlib.sha256(joined_words).hexdigest()
                    for column, value in zip(out, (len(words), len(words) - len(left), digest, joined_words)):
                        column.append(value)
                ids = part.column(0).to_numpy()
                columns = [
                    pa.array(ids, mask=ids == repeats.LARGEST_ID),
                    *[pa.array(c, pa.int64()) for c in out[:2]],
                    pa.array(out[2], pa.string()),
                ]
                names = [key, "n_words", "n_removed", "kept_sha256"]
                if kept:
                    columns.append(pa.array(out[3], pa.binary()).cast(pa.string()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"`{key}` bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return joined.mapInArrow(cut, schema + (", kept string" if kept else ""))
