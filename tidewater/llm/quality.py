"""Quality by Naive Bayes support vectors.

Indicators of words and word pairs, hashed, are scaled by their log-count ratio
between the classes; on these a linear model with squared hinge loss is fitted
by dual coordinate descent. Margins become probabilities by a logistic curve
that is fitted on margins of rows left out of the descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import texts
from tidewater.llm.learning import SAMPLE, Terms, labelled_sample, platt, read_sample, score_texts, sigmoid, term_rows

BITS = 18
FOLDS, FOLD = 3, 1
THRESHOLD = 0.5


def make_terms() -> Terms:
    return Terms(BITS, pairs=True)


@dataclass(frozen=True)
class SupportVectors:
    """Weights per term, the ratios multiplied in; squared ratios; the bias; the logistic curve."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def scorer(self):
        terms = make_terms()

        def score(text: str) -> float:
            idx = terms(text)
            norm = float(np.sqrt(self.squares[idx].sum()))
            margin = (self.weights[idx].sum() / norm if norm else 0.0) + self.bias
            return float(sigmoid(self.slope * margin + self.shift))

        return score


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    counts = np.ones((2, size))
    for idx, y in zip(rows, labels, strict=True):
        counts[int(y == 1), idx] += 1
    shares = counts / np.array([[(labels != 1).sum() + 2.0], [(labels == 1).sum() + 2.0]])
    return np.log(shares[1] / shares[0])


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = 1.0, rounds: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """w and bias of the linear model over unit-length rows of ratios, squared hinge loss."""
    y = np.where(labels == 1, 1.0, -1.0)
    share = max(min((y > 0).mean(), 0.999), 0.001) if len(y) else 0.5
    slack = np.where(y > 0, 1 / (2 * cost * 0.5 / share), 1 / (2 * cost * 0.5 / (1 - share)))
    values = [ratios[idx] / max(np.linalg.norm(ratios[idx]), 1e-12) for idx in rows]
    w, bias, alpha, rng = np.zeros(len(ratios)), 0.0, np.zeros(len(y)), np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            idx, x = rows[i], values[i]
            g = y[i] * (w[idx] @ x + bias) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - g / (2.0 + slack[i]), 0.0)  # x.x is 1, and 1 for the bias
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[idx] += step * x
                bias += step
                alpha[i] = new
    return w, bias


def fit(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """Ratios, weights, bias, slope, shift. With one class only, or none, every score is that class's smoothed share."""
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        share = ((labels == 1).sum() + 1) / (len(labels) + 2)
        return np.zeros(size), np.zeros(size), 0.0, 1.0, float(np.log(share / (1 - share)))
    spare = np.arange(len(labels)) % 5 == 0
    train = [r for r, s in zip(rows, spare, strict=True) if not s]
    ratios = log_count_ratios(train, labels[~spare], size)
    w, bias = dual_descent(train, labels[~spare], ratios)

    def margin(idx: np.ndarray) -> float:
        x = ratios[idx]
        return float(w[idx] @ x / max(np.linalg.norm(x), 1e-12) + bias)

    margins = np.array([margin(r) for r, s in zip(rows, spare, strict=True) if s])
    slope, shift = platt(margins, (labels[spare] == 1).astype(float))
    return ratios, w, bias, slope, shift


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, fold: int = FOLD, limit: int = SAMPLE) -> SupportVectors:
    """Fit on at most ``limit`` labelled rows outside the held-out fold, in one task; its size doesn't grow with the corpus."""
    rows = term_rows(labelled_sample(texts(docs), labels, label, folds, fold, limit), make_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, w, bias, slope, shift = fit(*read_sample(batches))
        parts = [(w * ratios).astype(np.float32).tobytes(), (ratios**2).astype(np.float32).tobytes()]
        yield pa.RecordBatch.from_pydict({"weights": pa.array([parts[0]], pa.binary()), "squares": pa.array([parts[1]], pa.binary()), "bias": [bias], "slope": [slope], "shift": [shift]})

    got = rows.repartition(1).sortWithinPartitions("turn", "id").mapInArrow(run, "weights binary, squares binary, bias double, slope double, shift double").first()
    if got is None:  # no labelled row at all, so no task had anything to fit
        ratios, w, bias, slope, shift = fit([], np.empty(0, np.int64))
        return SupportVectors(w * ratios, ratios**2, bias, slope, shift)
    return SupportVectors(np.frombuffer(bytes(got.weights), np.float32), np.frombuffer(bytes(got.squares), np.float32), got.bias, got.slope, got.shift)


def score_quality(docs: DataFrame, model: SupportVectors, threshold: float = THRESHOLD, keep_text: bool = False, **more) -> DataFrame:
    """(id, score, predicted, ...), and if asked the text, for every row of ``docs``, over its whole text; a null text is empty and gets the score of no terms."""
    return score_texts(texts(docs, **more), model.scorer, threshold, keep_text)
