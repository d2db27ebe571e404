"""Isolation forest: trees grown on small hashed samples, rows scored in Arrow batches.

Every tree sees about ``sample`` rows, whatever the table's size, so growing is
one small group per tree and the forest has at most ``2 ** (depth + 1)`` nodes a
tree, its depth being log2 of ``sample``. Scoring is a narrow pass over the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ranking import exact_percentile
from tidewater.session import pin

_NODE = "tree int, node int, feature int, cut double, path double"


def expected_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, n: np.ndarray, rng: np.random.Generator, depth: int, limit: int, node: int, out: list) -> None:
    """Nodes in heap numbering: children of node i are 2i + 1 and 2i + 2. ``n`` says how many rows each of ``x`` stands for."""
    spread = np.flatnonzero(x.max(axis=0) > x.min(axis=0)) if len(x) > 1 else []
    if depth >= limit or len(spread) == 0:
        out.append((node, -1, 0.0, depth + expected_path(float(n.sum()))))
        return
    feature = int(rng.choice(spread))
    low, high = x[:, feature].min(), x[:, feature].max()
    cut = float(rng.uniform(low, high))
    left = x[:, feature] <= cut
    out.append((node, feature, cut, 0.0))
    _grow(x[left], n[left], rng, depth + 1, limit, 2 * node + 1, out)
    _grow(x[~left], n[~left], rng, depth + 1, limit, 2 * node + 2, out)


def _samples(df: DataFrame, key: str, vector: Column, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, x, n): vectors of a tree's sample and how many rows have them.

    One rule at every size: a tree takes the rows whose hash of key, vector and
    round lies in its interval of width ``sample / rows``, at most 1, and a round
    serves as many trees as such intervals fit. No row is cut off afterwards;
    equal rows, however many, are one entry with their number.
    """
    rows = df.agg(F.count(F.lit(1))).first()[0]
    width = min(1.0, sample / max(rows, 1))
    per_round = int(1 / width)
    rounds = math.ceil(trees / per_round)
    unit = F.pmod(F.xxhash64(F.col(key), F.col("x"), F.col("round"), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    placed = (
        df.select(key, vector.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"))
        .withColumn("slot", F.floor(unit / F.lit(width)).cast("bigint"))
        .where(F.col("slot") < per_round)
        .select((F.col("round") * per_round + F.col("slot")).alias("tree"), "x")
        .where(F.col("tree") < trees)
    )
    return placed.groupBy("tree", "x").agg(F.count(F.lit(1)).alias("n"))


def forest(df: DataFrame, key: str, features: Sequence[str], trees: int = 200, sample: int = 256, seed: int = 42) -> DataFrame:
    """Node table of the forest."""
    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    limit = math.ceil(math.log2(sample))

    def grow(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(group[0])
        ordered = sorted(zip(rows["x"].map(tuple), rows["n"], strict=True))
        x, n = np.array([v for v, _ in ordered]), np.array([k for _, k in ordered])
        out: list = []
        _grow(x, n, np.random.default_rng((seed, tree)), 0, limit, 0, out)
        nodes = pd.DataFrame(out, columns=["node", "feature", "cut", "path"])
        nodes.insert(0, "tree", tree)
        return nodes

    return _samples(df, key, vector, trees, sample, seed).groupBy("tree").applyInPandas(grow, _NODE)


def isolation_scores(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    trees: int = 200,
    sample: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
) -> DataFrame:
    """Rows with ``anomaly_score`` in (0, 1] and a flag on the top ``contamination`` share."""
    nodes = forest(df, key, features, trees, sample, seed).toPandas()  # bounded by the depth: at most 4 * sample nodes a tree
    tables = [t.sort_values("node") for _, t in nodes.groupby("tree")]
    width = 2 ** (math.ceil(math.log2(sample)) + 1)
    feature = np.full((len(tables), width), -1, dtype=np.int32)
    cut, path = np.zeros((len(tables), width)), np.zeros((len(tables), width))
    for i, t in enumerate(tables):
        feature[i, t["node"]], cut[i, t["node"]], path[i, t["node"]] = t["feature"], t["cut"], t["path"]
    norm = expected_path(sample)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_numpy()) if len(batch) else np.empty((0, len(features)))
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for f, c, p in zip(feature, cut, path):
                at = np.zeros(len(x), dtype=np.int64)
                while True:
                    inner = f[at] >= 0
                    if not inner.any():
                        break
                    r = rows[inner]
                    here = at[inner]
                    at[inner] = 2 * here + np.where(x[r, f[here]] <= c[here], 1, 2)
                total += p[at]
            yield pd.Series(np.exp2(-total / (max(len(feature), 1) * norm)))

    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    # Pinned because it is read twice, for the cut and for the rows.
    scored = pin(df.withColumn("anomaly_score", F.round(score(vector), 6)))
    limit = exact_percentile(scored, "anomaly_score", 1 - contamination).scalar()
    return scored.withColumn("is_anomaly", F.col("anomaly_score") > limit)
