"""What the two text classifiers share: the labelled sample, hashed terms, calibration."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import release

#: Words and runs of signs.
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+")
#: Labelled rows that a model is fitted on, at most: those with the smallest hash of their id.
SAMPLE = 20_000
#: Words whose terms a task remembers.
REMEMBER = 200_000


def _hash(term: str) -> int:
    return crc32(term.encode("utf-8", "surrogatepass"))


class Terms:
    """Text to the sorted, distinct term ids of a document, the whole text.

    Terms are its words, and with ``pairs`` the pairs of neighbouring words and,
    as one more term, a word that follows itself; with ``heads`` the first
    letters of longer words, one term for each of those lengths. ``only``, a
    flag per id, leaves out terms that a model gives no weight.
    """

    def __init__(self, bits: int, pairs: bool = False, heads: tuple[int, ...] = (), only: np.ndarray | None = None):
        self.mask, self.pairs, self.heads = (1 << bits) - 1, pairs, heads
        self.only = None if only is None else set(np.flatnonzero(only).tolist())
        self.known: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= REMEMBER:
            self.known.clear()
        ids = [_hash(word), *(_hash(f"{word[:n]}-") for n in self.heads if len(word) > n)]
        if not self.pairs:
            ids = [(h ^ h >> 15) & self.mask for h in ids]
        found = self.known[word] = tuple(ids if self.only is None else (t for t in ids if t in self.only))
        return found

    def __call__(self, text: str) -> np.ndarray:
        words, known, of = TOKEN.findall(text.lower()), self.known, self._of
        if not self.pairs:
            found = set()
            for w in set(words):
                ids = known[w] if w in known else of(w)
                if ids:
                    found.update(ids)
            return np.sort(np.fromiter(found, np.int64, len(found)))
        h = np.fromiter((known[w][0] if w in known else of(w)[0] for w in words), np.uint64, len(words))
        if len(h) > 1:
            both = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
            both[h[:-1] == h[1:]] = 1
            h = np.concatenate([h, both ^ (both >> np.uint64(29))])
        return np.unique((h ^ (h >> np.uint64(15))) & np.uint64(self.mask)).astype(np.int64)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(texts: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, limit: int = SAMPLE) -> DataFrame:
    """(turn, id, text, label) of at most ``limit`` labelled documents outside the held-out fold.

    Of several labels of one id the largest counts; null labels and null ids
    don't. At most ``limit`` pairs of id and label go to every task, which bounds what is sent.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("id"), labels[label].cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    known = known.where(~held_out(F.col("id"), folds, fold)).groupBy("id").agg(F.max("label").alias("label"))
    turn = F.xxhash64(F.lit(17), "id")
    chosen = known.select(turn.alias("turn"), "id", "label").orderBy("turn", "id").limit(limit)
    return texts.join(F.broadcast(chosen), "id").select("turn", "id", "text", "label")


def term_rows(sample: DataFrame, make_terms: Callable[[], Terms]) -> DataFrame:
    """(turn, id, label, terms): term ids as packed 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = make_terms()
        for b in batches:
            packed = [terms(t.as_py()).astype(np.int32).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("turn"), b.column("id"), b.column("label"), pa.array(packed, pa.binary())], ["turn", "id", "label", "terms"])

    return sample.select("turn", "id", "text", "label").mapInArrow(run, "turn long, id long, label int, terms binary")


def read_sample(batches: Iterator[pa.RecordBatch]) -> tuple[list[np.ndarray], np.ndarray]:
    rows, labels = [], []
    for b in batches:
        rows += [np.frombuffer(t, np.int32).astype(np.int64) for t in b.column("terms").to_pylist()]
        labels += b.column("label").to_pylist()
    return rows, np.array(labels, np.int64)


def platt(margins: np.ndarray, labels: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a m + b))) for the labels, by Newton steps with a light pull to a = 1, b = 0."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - labels) * margins).sum() + (a - 1), (p - labels).sum() + b])
        w = p * (1 - p)
        hess = np.array([[(w * margins**2).sum() + 1, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1]])
        step = np.linalg.solve(hess, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(max(a, 1e-3)), float(b)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_texts(texts: DataFrame, make_scorer: Callable[[], Callable[[str], float]], threshold: float, keep_text: bool = False) -> DataFrame:
    """The rows of ``texts``, without the text unless asked to keep it, and score, predicted. ``make_scorer()`` gives text -> score, once per task."""
    kept = [c for c in texts.columns if keep_text or c != "text"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name in kept), "score double", "predicted int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # the worker may have served another stage
        scorer = make_scorer()
        for b in batches:
            score = np.fromiter((scorer(t.as_py()) for t in b.column("text")), np.float64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*kept, "score", "predicted"])
        del scorer
        release()

    return texts.mapInArrow(run, schema)
