"""Quality by an ordinal regression on graded ratings, with a cumulative logit link.

All grades share one weight per hashed feature of the text; ordered thresholds divide the resulting
scale. P(grade >= k) = sigmoid(score - threshold_k), so the tail probabilities of a text never cross.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estate.llm.arrays import SPACED, WordHash, find_words, ragged, text_bytes, text_slices
from estate.llm.ngrams import SparseRows, adam, gram_counts, labelled_sample, list_column, sigmoid

#: Features beside the n-grams, in ten steps each: share of distinct words, share of words that repeat the one before.
STEPS = 10
EXTRA = 2 * STEPS


@dataclass
class QualityModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; one less than the grades
    sizes: tuple[int, ...]
    bits: int


def _vectors(batch: pa.RecordBatch, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text, codes and values: square roots of the n-grams' shares, and the steps of the two word shares."""
    data, offsets = text_bytes(batch.column("text"))
    starts, ends, counts = find_words(data, offsets, SPACED)
    words = WordHash(3)(data, starts, ends)
    for i, total in enumerate(gram_counts(batch, sizes, bits)):
        codes = np.flatnonzero(total)
        own = words[counts[i] : counts[i + 1]]
        # Distinct among the words, set against a text's length by Heaps' law: the share falls with the root of it.
        distinct = min(STEPS - 1, int(STEPS * len(np.unique(own)) / max(1.0, 4 * len(own) ** 0.75)))
        again = min(STEPS - 1, int(2 * STEPS * (own[1:] == own[:-1]).sum() / max(1, len(own) - 1)))
        values = np.sqrt(total[codes] / max(1, total.sum()))
        yield np.append(codes, [(1 << bits) + distinct, (1 << bits) + STEPS + again]), np.append(values, [0.5, 0.5])


def _features(sizes: tuple[int, ...], bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            rows = list(_vectors(batch, sizes, bits))
            n = np.array([len(c) for c, _ in rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column("target").cast(pa.int32()), ragged(np.concatenate([c for c, _ in rows]), n, pa.int32()), ragged(np.concatenate([v for _, v in rows]), n, pa.float32())],
                names=["target", "codes", "values"],
            )

    return run


def fit_quality(
    docs: DataFrame, labels: DataFrame, grade: Column, grades: int, rows: int = 8000, sizes: tuple[int, ...] = (2, 3), bits: int = 14,
    penalty: float = 1e-5, steps: int = 200, id_col: str = "doc_id", text_col: str = "text",
) -> QualityModel:
    """Fit weights and thresholds on at most `rows` labelled rows that are not held out.

    `grade` gives each label's grade, 0 to grades - 1; others are not used. Without any label every
    grade is equally likely.
    """
    usable = F.when(grade.between(0, grades - 1), grade.cast("int"))
    sample = labelled_sample(docs, labels, usable, rows, id_col, text_col)
    data = sample.mapInArrow(_features(sizes, bits), "target int, codes array<int>, values array<float>").toArrow()
    columns = (1 << bits) + EXTRA
    even = np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1))
    if not data.num_rows:
        return QualityModel(np.zeros(columns, np.float32), even, sizes, bits)
    y = np.asarray(data.column("target"))
    count, codes = list_column(data, "codes")
    x = SparseRows(count, codes, list_column(data, "values")[1], columns)
    share = np.array([(y >= k).sum() + 1.0 for k in range(1, grades)]) / (len(y) + 2.0)
    first = -np.log(share / (1 - share))
    # The gaps between thresholds are held as logarithms, so that they stay in order.
    start = np.concatenate([np.zeros(columns), first[:1], np.log(np.maximum(np.diff(first), 0.1))])

    def gradient(p: np.ndarray) -> np.ndarray:
        w, gaps = p[:columns], np.exp(p[columns + 1 :])
        limits = np.concatenate([[-np.inf], p[columns] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        s = x.times(w)
        low, high = sigmoid(s - limits[y]), sigmoid(s - limits[y + 1])
        chance = np.maximum(low - high, 1e-12)
        dlow, dhigh = low * (1 - low), high * (1 - high)
        toward = -(dlow - dhigh) / chance / len(y)
        by_limit = np.zeros(grades + 1)
        np.add.at(by_limit, y, dlow / chance / len(y))
        np.add.at(by_limit, y + 1, -dhigh / chance / len(y))
        inner = by_limit[1:-1]
        tails = np.cumsum(inner[::-1])[::-1]
        return np.concatenate([x.transposed(toward) + penalty * w, tails[:1], tails[1:] * gaps])

    p = adam(gradient, start, steps, 0.1)
    return QualityModel(p[:columns].astype(np.float32), p[columns] + np.concatenate([[0.0], np.cumsum(np.exp(p[columns + 1 :]))]), sizes, bits)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with expected_grade and tail, where tail[k - 1] is P(grade >= k).

    A null or empty text has no n-grams and is scored as such. Columns of `docs` with these two names
    are replaced.
    """
    docs = docs.drop("expected_grade", "tail")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != text_col]
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in text_slices(batches, "text"):
            s = np.array([(m.weights[codes] * values).sum(dtype=float) for codes, values in _vectors(batch, m.sizes, m.bits)])
            tail = sigmoid(s[:, None] - m.thresholds[None, :])
            lists = ragged(tail.ravel(), np.full(len(s), len(m.thresholds)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tail.sum(axis=1), pa.float64()), lists], names=[*batch.schema.names, "expected_grade", "tail"])

    scored = plain.mapInArrow(run, plain.withColumns({"expected_grade": F.lit(0.0), "tail": F.array(F.lit(0.0))}).schema)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], F.col("text").alias(text_col), "expected_grade", "tail")


def selected(at_least: int, probability: float = 0.5) -> Column:
    """Whether a scored row reaches a grade with the given probability."""
    return F.element_at("tail", at_least) >= probability


