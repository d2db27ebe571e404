"""Merkle manifest of a table: every row's digest, its proof, and one root for all.

Rows are leaves, in order within their group; a run of ``fanout`` consecutive
nodes becomes the digest of its digests until one is left, the subroot of the
group. The subroots, in the order of the groups, make the root the same way.
A proof names, per level, the digests before and after the own one.

Slot pivot: a node's place in its run is its slot, and conditional aggregates
over the run give every child the digests of all slots as ``fanout`` columns.
Put together they make the parent's digest; without the own slot they are the
siblings. Several levels share one shuffle: rows are dealt by the block of
``fanout ** levels`` nodes they lie in and sorted once, and every level's runs
are ranges of that order. A block's top goes on as a node of the next round.

Nulls: a null value is a leaf part of its own, a null group comes first, null
ids come first in their group. Equal rows are leaves of their own, next to
each other. An empty table has no leaves and no root.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.ranking import with_global_rank
from tidewater.session import pin

FANOUT = 2
#: Nodes of a block, at most: they share a task, and a shuffle is spent per factor of this.
BLOCK_NODES = 256
#: Groups whose few numbers may be broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 10_000
#: What a row must have.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<before: string, after: string>>"


def leaf_of(parts: Sequence[Column]) -> Column:
    """Digest of the parts, each as byte count and value, or a dash where null."""
    text = [p.cast("string") for p in parts]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda at, step: F.sha2(F.concat(step["before"], at, step["after"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, from left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def _height(most: int, fanout: int) -> int:
    """Levels above the leaves of a group of ``most``."""
    height = 0
    while most > 1:
        most, height = -(-most // fanout), height + 1
    return height


def _round(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Nodes with ``block``, ``steps`` (their proof up to the block's top) and ``top``, its digest.

    ``nodes`` has group ``g``, place ``idx`` from 0, digest ``h`` and ``n``, the number of nodes of the group.
    """
    places = [f"idx div {fanout**j} AS _p{j}" for j in range(levels)]
    out = nodes.selectExpr("*", f"idx div {fanout**levels} AS block", *places, "h AS top").repartition("g", "block")
    steps = []
    for j in range(levels):
        run = ", ".join(["g", "block", *[f"_p{i}" for i in reversed(range(j + 1, levels))]])
        own, slots = f"_p{j} % {fanout}", [f"_c{j}_{s}" for s in range(fanout)]
        out = out.selectExpr("*", *[f"coalesce(max(CASE WHEN {own} = {s} THEN top END) OVER (PARTITION BY {run}), '') AS {c}" for s, c in enumerate(slots)])
        more = f"n > {fanout**j}"  # else the group has one node on this level already
        before = ", ".join(f"CASE WHEN {own} > {s} THEN {c} ELSE '' END" for s, c in enumerate(slots))
        after = ", ".join(f"CASE WHEN {own} < {s} THEN {c} ELSE '' END" for s, c in enumerate(slots))
        steps.append(f"CASE WHEN {more} THEN named_struct('before', concat({before}), 'after', concat({after})) END")
        kept = [f"`{c}`" for c in out.columns if c != "top"]
        out = out.selectExpr(*kept, f"CASE WHEN {more} THEN sha2(concat({', '.join(slots)}), 256) ELSE top END AS top")
    path = F.array_compact(F.array(*[F.expr(x) for x in steps])).cast(PROOF) if levels else F.array().cast(PROOF)
    return out.select(*nodes.columns, "block", path.alias("steps"), "top")


def tree(nodes: DataFrame, fanout: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(nodes with ``block`` and ``proof``; per group its ``subroot``); ``most`` is the size of the largest group.

    Upwards only digests move, and each round's tops are pinned: a table of at
    most one row per block. Downwards the rows meet the proof of their block's top.
    """
    height = _height(most, fanout)
    levels = min(max(int(math.log(BLOCK_NODES, fanout) + 1e-9), 1), height)
    if height <= levels:
        done = _round(nodes, fanout, levels)
        return done.withColumnRenamed("steps", "proof"), done.groupBy("g").agg(F.max("top").alias("subroot"))
    size = fanout**levels
    low = _round(nodes.select("g", "idx", "h", "n"), fanout, levels)
    tops = pin(low.groupBy("g", F.col("block").alias("idx")).agg(F.max("top").alias("h"), F.ceil(F.max("n") / size).cast("long").alias("n")))
    above, subroots = tree(tops, fanout, -(-most // size))
    above = pin(above.select("g", F.col("idx").alias("block"), F.col("proof").alias("_above")))
    done = _round(nodes, fanout, levels).join(above, ["g", "block"])
    return done.select(*nodes.columns, "block", F.concat("steps", "_above").alias("proof"), "top"), subroots


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    fanout: int = FANOUT,
    **more: Column,
) -> DataFrame:
    """(id, group, leaf, subroot, root, proof, more...) of every row; ``more`` are further columns taken from the rows.

    The text is read once; what goes on is a digest a row. Its order within the
    groups is a range sort. Only the number of groups and the largest size come to the driver.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    leaves = docs.select(
        docs[id_col].alias("id"),
        docs[group_col].alias("group"),
        leaf_of([docs[c] for c in fields]).alias("h"),
        *[c.alias(n) for n, c in more.items()],
        F.xxhash64(F.monotonically_increasing_id()).alias("_tie"),  # spreads rows that are equal
    )
    order = [F.col(c).asc_nulls_first() for c in ("group", "id", "h", "_tie")]
    ranked = with_global_rank(pin(leaves), order, "_rank", "_total").drop("_tie", "_total")
    sizes = ranked.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("_rank").alias("_first"))
    groups = pin(with_global_rank(sizes, [F.col("group").asc_nulls_first()], "_g", "_groups"))
    seen = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    n_groups, most = seen[0], seen[1] or 1

    def few(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n_groups <= BROADCAST_GROUPS else df

    placed = groups.select(F.col("group").alias("_group"), "n", "_first", (F.col("_g") - 1).alias("g"))
    nodes = ranked.join(few(placed), F.col("group").eqNullSafe(F.col("_group")))
    nodes = nodes.withColumn("idx", F.col("_rank") - F.col("_first")).drop("_rank", "_first", "_group")
    rows, subroots = tree(nodes, fanout, most)
    subroots = pin(subroots)
    tops = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.col("subroot").alias("h"), F.lit(n_groups).cast("long").alias("n"))
    above, root = tree(tops, fanout, n_groups)
    above = above.join(root.select("g", F.col("subroot").alias("root")), "g")
    roots = pin(above.select(F.col("idx").alias("g"), F.col("proof").alias("_above"), F.col("h").alias("subroot"), "root"))
    out = rows.join(few(roots), "g")
    return out.select("id", "group", F.col("h").alias("leaf"), "subroot", "root", F.concat("proof", "_above").alias("proof"), *more)
