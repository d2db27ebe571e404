"""Boosted trees on binned rows, equal rows as one with their number, with subsampling.

The trees are those of ``pyspark.ml``'s GBTClassifier: variance as impurity, the
first tree on the labels as -1 and 1, the others on the gradient of the log
loss. A tree draws each single row with the same chance; of n equal rows it so
draws a binomial number, which takes one draw for all of them.

Rows are packed into blocks, each with the margin that the trees of earlier
passes give it. A level of a tree is one pass that sums weights and gradients by
(node, feature, bin); what comes to the driver is such a table per task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import work_dir

#: Bin numbers are smaller than this.
WIDTH = 64
#: Rows of a block; of a task, at least and at most.
BLOCK_ROWS, TASK_ROWS, FILE_ROWS = 16_384, 50_000, 1_000_000
#: Trees after which margins are written.
REFRESH = 10

_BLOCK = "block long, bins binary, positive binary, n binary, margin binary"


@dataclass
class Tree:
    """Nodes in the order of a heap: feature (-1: none), the last bin that goes left, value."""

    depth: int
    weight: float
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        size = 2 ** (self.depth + 1) - 1
        self.feature, self.cut, self.value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in; ``bins`` has a line per feature."""
        at = np.zeros(bins.shape[1], np.uint8 if self.depth < 7 else np.int32)
        for level in range(self.depth):
            split, right = np.zeros(len(at), bool), np.zeros(len(at), bool)
            for i in range(2**level - 1, 2 ** (level + 1) - 1):
                if self.feature[i] >= 0:
                    here = at == i
                    split |= here
                    right |= here & (bins[self.feature[i]] > int(self.cut[i]))
            at = at + split * (at + right.astype(at.dtype) + at.dtype.type(1))
        return at


def _margin(trees: Sequence[Tree], bins: np.ndarray) -> np.ndarray:
    out = np.zeros(bins.shape[1])
    for t in trees:
        out += t.weight * t.value[t.places(bins)]
    return out


@dataclass(frozen=True)
class BoostedTrees:
    features: tuple[str, ...]
    trees: tuple[Tree, ...]

    def probability(self) -> Column:
        """The chance of label 1 from the columns of binned features."""
        trees = self.trees

        @F.pandas_udf("double")
        def chance(rows: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in rows:
                yield pd.Series(1 / (1 + np.exp(-2 * _margin(trees, np.array(columns).astype(np.uint8)))))

        return chance(*self.features)


def _packed(features: Sequence[str], label: str, count: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(at, BLOCK_ROWS)
                bins = np.array([b.column(c).to_numpy(zero_copy_only=False) for c in features]).astype(np.uint8)
                parts = [bins, (b.column(label).to_numpy(zero_copy_only=False) == 1).astype(np.uint8), b.column(count).to_numpy(zero_copy_only=False).astype(np.int64), np.zeros(b.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array([task << 32 | number], pa.int64()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=["block", "bins", "positive", "n", "margin"])
                number += 1

    return run


def _read(batch: pa.RecordBatch, recent: Sequence[Tree]):
    """Of every block its number, bins, positive flags, counts and margins."""
    for i, block in enumerate(batch.column("block").to_pylist()):
        raw = {c: batch.column(c)[i].as_buffer() for c in ("bins", "positive", "n", "margin")}
        positive, n = np.frombuffer(raw["positive"], np.uint8), np.frombuffer(raw["n"], np.int64)
        bins = np.frombuffer(raw["bins"], np.uint8).reshape(-1, len(n))
        yield block, bins, positive, n, np.frombuffer(raw["margin"], np.float64) + _margin(recent, bins)


def _drawn(n: np.ndarray, share: float, *seed: int) -> np.ndarray:
    """How many of the n equal rows are drawn."""
    if share >= 1:
        return n
    rng = np.random.default_rng(seed)
    out = (rng.random(len(n)) < share).astype(np.int64)
    many = np.flatnonzero(n > 1)
    out[many] = rng.binomial(n[many], share)
    return out


def _sums(recent: Sequence[Tree], tree: Tree, number: int, level: int, n_features: int, weight: float, share: float, seed: int):
    """Sums of weights and of weighted targets by (node of the level, feature, bin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, nodes = 2**level - 1, 2**level
        total = np.zeros((2, n_features, nodes * WIDTH))
        for batch in batches:
            for block, bins, positive, n, margin in _read(batch, recent):
                sign = np.where(positive == 1, 1.0, -1.0)
                target = sign if number == 0 else 4 * sign / (1 + np.exp(2 * sign * margin))
                w = _drawn(n, share, seed, number, block) * np.where(positive == 1, weight, 1.0)
                node = tree.places(bins).astype(np.int64) - first
                w = np.where(node >= 0, w, 0.0)  # rows whose node was not split have none in this level
                base, wt = np.maximum(node, 0) * WIDTH, w * target
                for f in range(n_features):
                    spot = base + bins[f]
                    total[0, f] += np.bincount(spot, w, nodes * WIDTH)
                    total[1, f] += np.bincount(spot, wt, nodes * WIDTH)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    return run


def _moved(recent: Sequence[Tree]):
    """The blocks with the margins that these trees add."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [m.tobytes() for *_, m in _read(batch, recent)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("block", "bins", "positive", "n")], pa.array(margins, pa.binary())], names=["block", "bins", "positive", "n", "margin"])

    return run


def _grow(tree: Tree, level: int, total: np.ndarray) -> bool:
    """Splits the nodes of a level where that lowers the variance; whether one was split."""
    first, n_features, grown = 2**level - 1, total.shape[1], False
    w, g = total.reshape(2, n_features, -1, WIDTH)
    for node in range(2**level):
        all_w, all_g = w[0, node].sum(), g[0, node].sum()
        if all_w <= 0:
            continue
        if level == 0:
            tree.value[0] = all_g / all_w
        left_w, left_g = np.cumsum(w[:, node], axis=1), np.cumsum(g[:, node], axis=1)
        right_w, right_g = left_w[:, -1:] - left_w, left_g[:, -1:] - left_g
        fine = (left_w > 0) & (right_w > 1e-9 * all_w)
        gain = np.where(fine, left_g**2 / np.where(fine, left_w, 1) + right_g**2 / np.where(fine, right_w, 1) - all_g**2 / all_w, -1.0)
        f, cut = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[f, cut] <= 1e-12 * all_w:
            continue
        at, grown = first + node, True
        tree.feature[at], tree.cut[at] = f, cut
        tree.value[2 * at + 1], tree.value[2 * at + 2] = left_g[f, cut] / left_w[f, cut], right_g[f, cut] / right_w[f, cut]
    return grown


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fit_trees(groups: DataFrame, features: Sequence[str], label: str, count: str, positive_weight: float, trees: int, depth: int, rate: float, share: float, seed: int) -> BoostedTrees:
    """Trees over ``groups``: bin numbers from 0 in the columns ``features``, a label of 0 or 1, and how many equal rows a row stands for.

    ``share`` is the chance of a single row to be drawn for a tree. The groups
    are read once and packed below the scratch folder; at most two states of
    the blocks are there at a time, and none in the end.
    """
    spark = groups.sparkSession
    rows = groups.count()
    tasks = max(min(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), -(-rows // FILE_ROWS), 1)
    state = work_dir(spark, "boosting")
    packed = groups.select(*features, label, count).repartition(tasks)
    packed.mapInArrow(_packed(features, label, count), _BLOCK).write.parquet(state)
    done: list[Tree] = []
    recent: list[Tree] = []
    for number in range(trees):
        blocks, tree = spark.read.schema(_BLOCK).parquet(state), Tree(depth, rate if number else 1.0)
        for level in range(depth):
            found = blocks.mapInArrow(_sums(recent, tree, number, level, len(features), positive_weight, share, seed), "sums binary").toArrow()
            total = np.zeros((2, len(features), 2**level * WIDTH))
            for one in found["sums"]:
                total += np.frombuffer(one.as_buffer(), np.float64).reshape(total.shape)
            if not _grow(tree, level, total):
                break
        done.append(tree)
        recent.append(tree)
        if len(recent) == REFRESH and number + 1 < trees:
            moved = work_dir(spark, "boosting")
            blocks.mapInArrow(_moved(recent), _BLOCK).write.parquet(moved)
            _remove(spark, state)
            state, recent = moved, []
    _remove(spark, state)
    return BoostedTrees(tuple(features), tuple(done))
