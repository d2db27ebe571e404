"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of w over the terms + sum over pairs of terms of the
product of their factors), so that two words together can weigh more than each.
Fitted by adaptive gradient steps on the logistic loss, over all terms of the
labelled sample. Steps are the longer the more speaks for a term: for its
weight, how far its share differs between the classes; for its factors, the
pair with another term that single weights leave most unexplained, so that two
words which tell nothing alone can weigh together.
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
FACTORS = 8
#: Lengths of word beginnings that are terms of their own, since insults are inflected.
HEADS = (4, 5, 6)
#: Standard errors of a term's log odds ratio, and of what is left unexplained of its best pair, from which on steps are full.
APART, PAIR_APART = 3.0, 6.0
#: Steps shrink with these powers of the standard errors, down to a least share that every term has.
POWER, PAIR_POWER = 4, 8
LEAST, PAIR_LEAST = 1e-3, 1e-3
FOLDS, FOLD = 4, 2
THRESHOLD = 0.3
ROUNDS = 6
RATE, PAIR_RATE, SHRINK = 0.1, 0.03, 1e-5


def make_terms(only: np.ndarray | None = None) -> Terms:
    return Terms(BITS, heads=HEADS, only=only)


@dataclass(frozen=True)
class FactorMachine:
    linear: np.ndarray  # per term
    factors: np.ndarray  # per term and factor
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, idx: np.ndarray) -> float:
        v = self.factors[idx]
        total = v.sum(axis=0)
        return float(self.bias + self.linear[idx].sum() + 0.5 * (total @ total - (v * v).sum()))

    def scorer(self):
        terms = make_terms(only=(self.linear != 0) | self.factors.any(axis=1))
        return lambda text: float(sigmoid(self.slope * self.margin(terms(text)) + self.shift))


def telling(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Share of a full step for each term's weight, by how well the term alone tells the classes apart; 0 for terms in no row."""
    counts = [np.bincount(np.concatenate([np.empty(0, np.int64), *(r for r, y in zip(rows, labels, strict=True) if (y == 1) == one)]), minlength=size) + 0.5 for one in (False, True)]
    ones = (labels == 1).sum()
    ratio = np.log(counts[1] / (ones + 1)) - np.log(counts[0] / (len(labels) - ones + 1))
    apart = np.abs(ratio) / np.sqrt(1 / counts[0] + 1 / counts[1])
    return np.where(counts[0] + counts[1] > 1, np.clip((apart / APART) ** POWER, LEAST, 1), 0.0)


def paired(rows: list[np.ndarray], labels: np.ndarray, model: FactorMachine, size: int) -> np.ndarray:
    """Share of a full step for each term's factors; 0 for terms in no row.

    Of all pairs with the term it takes the one whose rows the weights of
    ``model`` leave most unexplained, in standard errors. Terms that come only
    together are one term for that. A term's errors in one direction bound what
    any of its pairs can reach, so terms that can't leave the least share are not counted.
    """
    p = sigmoid(np.array([model.margin(r) for r in rows]))
    left, spread = (labels == 1) - p, p * (1 - p)
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate([np.empty(0, np.int64), *rows])
    n = np.bincount(flat, minlength=size)
    bound = np.maximum(*(np.bincount(flat, np.repeat(np.maximum(x, 0), lengths), size) for x in (left, -left)))
    some = np.flatnonzero(bound > PAIR_APART * PAIR_LEAST ** (1 / PAIR_POWER))
    number = np.full(size, -1)
    number[some] = np.arange(len(some))
    rows = [x[x >= 0] for x in (number[r] for r in rows)]
    lengths, flat = np.array([len(r) for r in rows]), np.concatenate([np.empty(0, np.int64), *rows])
    holders = np.repeat(np.arange(len(rows)), lengths)[np.argsort(flat, kind="stable")]
    starts, best = np.concatenate([[0], np.cumsum(n[some])]), np.zeros(size)
    for j, term in enumerate(some):
        at = holders[starts[j] : starts[j + 1]]
        others, many = np.concatenate([rows[i] for i in at]), lengths[at]
        both = np.bincount(others, minlength=len(some))
        errors = np.abs(np.bincount(others, np.repeat(left[at], many), len(some))) / np.sqrt(np.bincount(others, np.repeat(spread[at], many), len(some)) + 1)
        best[term] = errors[(both < len(at)) & (both < n[some])].max(initial=0.0)
    return np.where(n > 0, np.clip((best / PAIR_APART) ** PAIR_POWER, PAIR_LEAST, 1), 0.0)


def descend(rows: list[np.ndarray], labels: np.ndarray, single: np.ndarray, pair: np.ndarray | None = None, rounds: int = ROUNDS, seed: int = 1) -> FactorMachine:
    """Steps over all rows, ``single`` and ``pair`` of their full length for a term's weight and factors; without ``pair`` factors are 0."""
    rng, size = np.random.default_rng(seed), len(single)
    y = (labels == 1).astype(float)
    share = (y.sum() + 1) / (len(y) + 2)
    w, v, bias = np.zeros(size), np.zeros((size, FACTORS)), float(np.log(share / (1 - share)))
    if pair is not None:
        v = rng.normal(0, 0.01, (size, FACTORS)) * pair[:, None]
    seen_w, seen_v, seen_b = np.full(size, 1e-1), np.full((size, FACTORS), 1e-1), 1.0
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            idx = rows[i]
            m = bias + w[idx].sum()
            if pair is not None:
                vi = v[idx]
                total = vi.sum(axis=0)
                m += 0.5 * (total @ total - (vi * vi).sum())
            g = 1 / (1 + np.exp(-min(max(m, -30.0), 30.0))) - y[i]
            seen_b += g * g
            bias -= RATE * g / np.sqrt(seen_b)
            gw = g + SHRINK * w[idx]
            seen = seen_w[idx] + gw * gw
            seen_w[idx] = seen
            w[idx] -= RATE * single[idx] * gw / np.sqrt(seen)
            if pair is None:
                continue
            gv = g * (total - vi) + SHRINK * vi
            seen = seen_v[idx] + gv * gv
            seen_v[idx] = seen
            v[idx] = vi - PAIR_RATE * pair[idx][:, None] * gv / np.sqrt(seen)
    return FactorMachine(w, v, bias)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> FactorMachine:
    """With one class only, or none, every score is that class's smoothed share."""
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        share = ((labels == 1).sum() + 1) / (len(labels) + 2)
        return FactorMachine(np.zeros(size), np.zeros((size, FACTORS)), float(np.log(share / (1 - share))))
    spare = np.arange(len(labels)) % 5 == 0
    fitted, known = [r for r, s in zip(rows, spare, strict=True) if not s], labels[~spare]
    single = telling(fitted, known, size)
    model = descend(fitted, known, single, paired(fitted, known, descend(fitted, known, single), size))
    margins = np.array([model.margin(r) for r, s in zip(rows, spare, strict=True) if s])
    slope, shift = platt(margins, (labels[spare] == 1).astype(float))
    return FactorMachine(model.linear, model.factors, model.bias, slope, shift)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, fold: int = FOLD, limit: int = SAMPLE) -> FactorMachine:
    """Fit on at most ``limit`` labelled rows outside the held-out fold, in one task; its size doesn't grow with the corpus."""
    rows = term_rows(labelled_sample(texts(docs), labels, label, folds, fold, limit), make_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = fit(*read_sample(batches))
        yield pa.RecordBatch.from_pydict({"linear": pa.array([m.linear.astype(np.float32).tobytes()], pa.binary()), "factors": pa.array([m.factors.astype(np.float32).tobytes()], pa.binary()), "bias": [m.bias], "slope": [m.slope], "shift": [m.shift]})

    got = rows.repartition(1).sortWithinPartitions("turn", "id").mapInArrow(run, "linear binary, factors binary, bias double, slope double, shift double").first()
    if got is None:  # no labelled row at all, so no task had anything to fit
        return fit([], np.empty(0, np.int64))
    factors = np.frombuffer(bytes(got.factors), np.float32).reshape(-1, FACTORS)
    return FactorMachine(np.frombuffer(bytes(got.linear), np.float32), factors, got.bias, got.slope, got.shift)


def score_toxicity(docs: DataFrame, model: FactorMachine, threshold: float = THRESHOLD, **more) -> DataFrame:
    """(id, score, predicted, ...) for every row of ``docs``, over its whole text; a null text is empty and gets the score of no terms."""
    return score_texts(texts(docs, **more), model.scorer, threshold)
