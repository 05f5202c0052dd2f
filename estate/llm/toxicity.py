"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Each n-gram that occurs in a text is a feature; its value is the logarithm of how much more often
toxic than clean labelled texts hold it. A logistic regression is fitted on these values to convergence.
As it is surer of the texts that it learnt from than of others, its scores are then calibrated on texts
of the sample that models of its other parts have scored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.arrays import ragged, text_slices
from estate.llm.ngrams import FOLDS, SparseRows, SplitCodes, held_out, labelled_sample, lbfgs, list_column, present_grams, sigmoid


@dataclass
class ToxicityModel:
    weights: np.ndarray  # per code: regression weight times log-count ratio
    bias: float
    sizes: tuple[int, ...]
    bits: int


def _features(sizes: tuple[int, ...], bits: int):
    upper = max(1, (1 << bits) >> 16)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            found = list(present_grams(batch, sizes, bits))
            low = np.concatenate(found).astype(np.uint16).view(np.int16)
            per = np.concatenate([np.bincount(f >> 16, minlength=upper) for f in found]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("target").cast(pa.int32()), batch.column("fold"), ragged(low, np.array([len(f) for f in found]), pa.int16()), ragged(per, np.full(len(found), upper), pa.int32())],
                names=["target", "fold", "low", "per_upper"],
            )

    return run


def log_count_ratios(x: SparseRows, y: np.ndarray, used: np.ndarray | float = 1.0, smoothing: float = 1.0) -> np.ndarray:
    """log(p / q), p and q the smoothed shares of the used toxic and clean texts that hold a code."""
    yes, no = y * used, (1.0 - y) * used
    inside, outside = x.transposed(yes) + smoothing, x.transposed(no) + smoothing
    return np.log(inside / (yes.sum() + 2 * smoothing)) - np.log(outside / (no.sum() + 2 * smoothing))


def _fit(x: SparseRows, y: np.ndarray, used: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights per code and bias, learnt from the used rows; both classes weigh the same."""
    ratio = log_count_ratios(x, y, used)
    yes, n = (y * used).sum(), used.sum()
    weigh = used * np.where(y == 1, 1 / (2 * yes), 1 / (2 * (n - yes)))

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.times(p[:-1] * ratio) + p[-1]
        error = weigh * (sigmoid(z) - y)
        value = weigh @ (np.logaddexp(0, z) - y * z) + penalty / 2 * (p[:-1] @ p[:-1])
        return value, np.append(ratio * x.transposed(error) + penalty * p[:-1], error.sum())

    p = lbfgs(loss, np.zeros(x.columns + 1), steps)
    return p[:-1] * ratio, float(p[-1])


def calibration(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(scale, shift) that make sigmoid(scale * z + shift) a probability, fitted on smoothed labels."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        u = p[0] * z + p[1]
        error = (sigmoid(u) - target) / len(y)
        return (np.logaddexp(0, u) - target * u).mean(), np.array([error @ z, error.sum()])

    scale, shift = lbfgs(loss, np.array([1.0, 0.0]), 100, tolerance=1e-9)
    return (float(scale), float(shift)) if scale > 0 else (1.0, 0.0)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, rows: int = 8000, sizes: tuple[int, ...] = (4, 5, 6), bits: int = 18, penalty: float = 0.1,
    steps: int = 40, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> ToxicityModel:
    """Fit on at most `rows` labelled rows that are not held out; the tasks extract the features.

    Without any label, or with one class alone, the model says the smoothed share of that class. Where
    the other parts of the sample lack a class, scores are not calibrated. The driver holds two bytes
    for each different n-gram of a row of the sample, and at most 2 ** bits n-grams a row.
    """
    sample = labelled_sample(docs, labels, F.col(label_col).cast("int"), rows, id_col, text_col)
    data = sample.mapInArrow(_features(sizes, bits), "target int, fold int, low array<smallint>, per_upper array<int>").toArrow()
    y = np.asarray(data.column("target")).astype(float) if data.num_rows else np.zeros(0)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2)
        return ToxicityModel(np.zeros(1 << bits, np.float32), float(np.log(share / (1 - share))), sizes, bits)
    fold = np.asarray(data.column("fold"))
    count, low = list_column(data, "low")
    per_upper = list_column(data, "per_upper")[1].reshape(len(y), -1)
    del data
    x = SparseRows(count, SplitCodes(low, per_upper), None, 1 << bits)
    others = [(fold != k).astype(float) for k in range(FOLDS)]
    if not all(0 < y @ o < o.sum() for o in others):
        others = []
    # The fits do not depend on each other, and numpy lets threads work side by side.
    with ThreadPoolExecutor(1 + FOLDS) as pool:
        (weights, bias), *apart = pool.map(lambda used: _fit(x, y, used, penalty, steps), [np.ones(len(y)), *others])
    scale, shift = 1.0, 0.0
    if apart:
        z = np.zeros(len(y))
        for k, (own, constant) in enumerate(apart):
            z = np.where(fold == k, x.times(own) + constant, z)
        scale, shift = calibration(z, y)
    return ToxicityModel((scale * weights).astype(np.float32), scale * bias + shift, sizes, bits)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with `score`, the probability that the whole text is toxic.

    A null or empty text is scored by what the model says about no n-grams but that of two spaces'
    ends. A column of `docs` called score is replaced.
    """
    docs = docs.drop("score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != text_col]
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in text_slices(batches, "text"):
            z = np.array([m.weights[codes].sum(dtype=float) for codes in present_grams(batch, m.sizes, m.bits)]) + m.bias
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(z), pa.float64())], names=[*batch.schema.names, "score"])

    scored = plain.mapInArrow(run, plain.withColumn("score", F.lit(0.0)).schema)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], F.col("text").alias(text_col), "score")


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """(id, held_out, score, predicted) of every row of `docs`, with a model fitted on labelled rows.

    A null id counts as an empty one for held_out. Repeated rows get equal scores.
    """
    model = fit_toxicity(docs, labels, id_col=id_col, text_col=text_col, **fit)
    rows = score_toxicity(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return rows.select(F.col("doc_id").alias(id_col), held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
