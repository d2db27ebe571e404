"""Exact copies by a content sort.

Sampled splitters range-partition the rows by their normalised bytes, each
partition is sorted (Spark's external sort), and neighbours are compared in
full. The sort key is the head of the normalised text, its SHA-256, the
length of the original text, falling, and the id. So equal texts are
adjacent, splitters stay short however long the texts are, and a group of
copies may spread over many partitions: only where two partitions meet are
texts compared across them, and a chain of such runs is added up from one row
per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import BLANK, texts
from tidewater.session import pin

HEAD = 64
RUNS = "part int, run int, runs int, first boolean, last boolean, doc_id long, n_chars long, keep_id long, group_size long, leads boolean, text_sha256 string, edge string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition; texts stay at its first and last row only."""
    held, same, before, opening = [], [], None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        norm = batch.column("norm")
        if opening is None:
            opening = norm[0].as_py()
        same.append(np.array([before is not None and before == norm[0].as_py()]))
        same.append(pc.equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False).astype(bool))
        before = norm[-1].as_py()
        held.append(batch.select(["id", "n_chars", "sha"]))
    if not held:
        return
    rows, equal = pa.Table.from_batches(held).combine_chunks(), np.concatenate(same)
    n, run = len(equal), np.cumsum(~equal) - 1
    starts = np.flatnonzero(~equal)
    sizes = np.diff(np.append(starts, n))
    spot = np.arange(n)
    edge = np.full(n, None, dtype=object)
    edge[0], edge[-1] = opening, before
    out = {
        "part": np.full(n, TaskContext.get().partitionId(), np.int32),
        "run": run.astype(np.int32),
        "runs": np.full(n, len(starts), np.int32),
        "first": spot == 0,
        "last": spot == n - 1,
        "doc_id": rows["id"],
        "n_chars": rows["n_chars"],
        "keep_id": rows["id"].take(pa.array(starts[run])),
        "group_size": sizes[run].astype(np.int64),
        "leads": ~equal,
        "text_sha256": rows["sha"],
        "edge": pa.array(edge, pa.string()),
    }
    yield from pa.table(out).to_batches(max_chunksize=20_000)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when they are the same after deleting every blank
    (space and U+0009 to U+000D). Of equal texts the row with the most code
    points stays, then the smallest id. A null text counts as empty, and empty
    texts are a group like any other. A null id comes after all other ids. Of
    rows that repeat id and text one stays. An empty table gives no rows;
    further columns are left behind, whatever their names.
    """
    base = texts(docs, id_col, text_col)
    norm = base.select("id", F.char_length("text").cast("long").alias("n_chars"), F.regexp_replace("text", BLANK + "+", "").alias("norm"))
    keyed = norm.select("id", "n_chars", "norm", F.substring("norm", 1, HEAD).alias("head"), F.sha2("norm", 256).alias("sha"))
    order = ["head", "sha", F.desc("n_chars"), F.asc_nulls_last("id")]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = pin(ranged.select("id", "n_chars", "norm", "sha").mapInArrow(_runs, RUNS))

    # one row per partition that has rows, first with the texts at its ends, then without
    first = runs.where("first").select("part", "runs", F.col("edge").alias("opening"), F.col("keep_id").alias("first_keep"), F.col("group_size").alias("first_size"))
    last = runs.where("last").select("part", F.col("edge").alias("closing"), F.col("keep_id").alias("last_keep"), F.col("group_size").alias("last_size"))
    by_part = Window.orderBy("part")
    before = first.select("part", F.lag("part").over(by_part).alias("before"))
    meets = first.join(before, "part").join(last.select(F.col("part").alias("before"), "closing"), "before", "left")
    parts = (
        meets.select("part", "runs", "before", "first_keep", "first_size", F.coalesce(F.col("opening") == F.col("closing"), F.lit(False)).alias("goes_on"))
        .join(last.drop("closing"), "part")
        .withColumn("tail", F.last(F.when((F.col("runs") > 1) | ~F.col("goes_on"), F.col("part")), ignorenulls=True).over(by_part))
        .withColumn("joins", F.lag("tail").over(by_part))
    )
    pieces = parts.select("part", (F.col("runs") - 1).alias("run"), F.col("tail").alias("chain"), F.col("last_keep").alias("keep"), F.col("last_size").alias("size")).unionByName(
        parts.where("goes_on AND runs > 1").select("part", F.lit(0).alias("run"), F.col("joins").alias("chain"), F.col("first_keep").alias("keep"), F.col("first_size").alias("size"))
    )
    chains = pieces.groupBy("chain").agg(F.min(F.struct("part", "keep")).alias("lead"), F.sum("size").alias("size"))
    ends = pieces.select("part", "run", "chain").join(chains, "chain").select("part", "run", F.col("lead.part").alias("at"), F.col("lead.keep").alias("keep"), "size")
    # two rows per shuffle partition at most, so small enough to send to every task
    done = runs.drop("edge").join(F.broadcast(ends), ["part", "run"], "left")
    split = F.col("at").isNotNull()
    return done.select(
        "doc_id",
        F.when(split, F.col("keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(split, F.col("size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("leads") & (~split | (F.col("at") == F.col("part")))).alias("kept"),
        "text_sha256",
        "n_chars",
    )
