"""Quality by ordinal cumulative-link regression on hashed text.

Grades are ordered: 0 toxic, 1 poor, 2 good. One score s = w x of a document's hashed features and rising
thresholds give P(grade >= k) = 1 / (1 + exp(t_k - s)); the expected grade is the sum of these tails.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wintide.llm import rolling

DIMENSION = 1 << 18
GRADES = 3
TRAINING_ROWS = 16_000
LEAST_DOCUMENTS = 4
EPOCHS = 200
SHRINK = 5e-4
RARE_GRADES = 0.3
KEEP_AT = 0.5

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
_MARKS = bytes(c if 33 <= c < 127 and not chr(c).isalnum() else 32 for c in range(256))
_KIND = np.array([1 if 65 <= c <= 90 else 2 if 33 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 else 0 for c in range(256)], np.uint8)


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, sorted and each once: the words and runs of marks that occur, and shares in steps."""
    hashes, first, _, _ = rolling.words_of([t.translate(_LETTERS) for t in texts])
    marks, first_mark, _, _ = rolling.words_of([t.translate(_MARKS) for t in texts])
    lengths = np.array([max(1, len(t)) for t in texts])
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    word = np.unique((text.astype(np.uint64) << np.uint64(32)) | (hashes % np.uint64(DIMENSION)))
    n_words = np.diff(first)
    distinct = np.bincount((word >> np.uint64(32)).astype(np.int64), minlength=len(texts))
    kinds = _KIND[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    bounds = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
    sums = [np.append(0, np.cumsum(kinds == k)) for k in (1, 2)]
    shares = [(s[bounds[1:]] - s[bounds[:-1]]) / lengths for s in sums]
    shares += [distinct / np.maximum(1, n_words), np.minimum(1, np.log2(1 + n_words) / 16)]
    marked = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(first_mark)) << np.uint64(32)
    out = [word, np.unique(marked | (rolling.mix(marks) % np.uint64(DIMENSION)))]
    for n, share in enumerate(shares):
        steps = np.floor(np.sqrt(share) * 20).astype(np.uint64)
        hashed = rolling.mix(steps + np.uint64(1_000 * (n + 1))) % np.uint64(DIMENSION)
        out.append((np.arange(len(texts), dtype=np.uint64) << np.uint64(32)) | hashed)
    pairs = np.unique(np.concatenate(out))
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & rolling.LOW).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Weights and thresholds that make the grades most likely; rare grades count for more than their share."""
    weights, steps = np.zeros(DIMENSION), np.array([-1.0, 0.5])  # first threshold, log of the gap
    if not len(grades):
        return Model(weights, np.array([-20.0, -10.0]))
    often = np.bincount(columns, minlength=DIMENSION) >= LEAST_DOCUMENTS
    used = often[columns]
    rows, columns = rows[used], columns[used]
    share = np.bincount(grades, minlength=GRADES) / len(grades)
    importance = 1 / np.maximum(share, 1e-9)[grades] ** RARE_GRADES
    importance /= importance.sum()
    moments = [np.zeros(DIMENSION), np.zeros(DIMENSION), np.zeros(2), np.zeros(2)]
    for epoch in range(1, epochs + 1):
        score = np.bincount(rows, weights[columns], len(grades))
        low, gap = steps[0], np.exp(steps[1])
        tail1, tail2 = _sigmoid(score - low), _sigmoid(score - low - gap)
        # derivatives of -log P(grade) by the score and by the second threshold
        chance = np.maximum(np.choose(grades, [1 - tail1, tail1 - tail2, tail2]), 1e-9)
        slope1, slope2 = tail1 * (1 - tail1), tail2 * (1 - tail2)
        by_first = np.choose(grades, [slope1, -slope1, 0 * slope1]) / chance * importance
        by_second = np.choose(grades, [0 * slope2, slope2, -slope2]) / chance * importance
        by_score = by_first + by_second
        gradients = [
            np.bincount(columns, by_score[rows], DIMENSION) + SHRINK * weights,
            np.array([-by_score.sum(), -by_second.sum() * gap]),
        ]
        for n, (value, gradient) in enumerate(zip((weights, steps), gradients)):
            mean, square = moments[2 * n], moments[2 * n + 1]
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            value -= 0.05 * (mean / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.99**epoch)) + 1e-8)
    return Model(weights, np.array([steps[0], steps[0] + np.exp(steps[1])]))


def tails(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Scores, and P(grade >= k) for k = 1, 2 of each text."""
    rows, columns = features(texts)
    score = np.bincount(rows, model.weights[columns], len(texts))
    return score, _sigmoid(score[:, None] - model.thresholds[None, :])


def train(
    docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, key: str = "doc_id", text: str = "text"
) -> Model:
    """Fits on at most ``most`` labelled documents, those whose ids hash lowest.

    The grade is 0 for toxic documents, else 1 plus their quality; rows of ``labels`` with a null are left
    out. Features are computed by tasks; the driver gets those of the bounded sample only. Without labelled
    documents the model gives every document the highest grade.
    """
    grade = F.when(F.col("toxic") == 1, 0).otherwise(1 + F.col("quality"))
    graded = (
        labels.select(F.col(key).cast("bigint").alias("id"), grade.cast("int").alias("grade"))
        .where(F.col("id").isNotNull() & F.col("grade").isNotNull())
        .orderBy(F.xxhash64("id"), "id", "grade")
        .limit(most)
    )
    # at most ``most`` rows of two numbers
    sample = docs.select(
        F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    ).join(F.broadcast(graded), "id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.in_chunks(batches, 1):
            rows, columns = features(texts)
            ends = np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(columns.astype(np.int32))),
                ],
                ["id", "grade", "features"],
            )

    found = sample.mapInArrow(extract, "id bigint, grade int, features array<int>").toArrow().sort_by("id")
    sizes = found["features"].combine_chunks().value_lengths().to_numpy() if found.num_rows else np.zeros(0, int)
    columns = found["features"].combine_chunks().flatten().to_numpy() if found.num_rows else np.zeros(0, int)
    return fit(np.repeat(np.arange(len(sizes)), sizes), columns, found["grade"].to_numpy().astype(np.int64))


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score, tails and expected grade of every row; ``keep`` if P(grade >= 2) reaches the limit.

    A null or empty text is scored as one without words. Repeated rows, null ids and other columns do not
    matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rolling.in_chunks(batches, 1):
            score, tail = tails(shared.value, texts)
            columns = [part.column(0), score, tail.sum(axis=1), tail[:, 0], tail[:, 1], tail[:, 1] >= KEEP_AT]
            yield pa.RecordBatch.from_arrays(
                [columns[0], *map(pa.array, columns[1:])],
                [key, "score", "expected_grade", "p_not_toxic", "p_good", "keep"],
            )

    return rows.mapInArrow(
        judge,
        f"`{key}` {kind}, score double, expected_grade double, p_not_toxic double, p_good double, keep boolean",
    )


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that ``score_documents`` would keep, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = [(t or "").encode() for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(tails(shared.value, texts)[1][:, 1] >= KEEP_AT))

    return docs.mapInArrow(choose, docs.schema)
