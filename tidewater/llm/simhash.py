"""Near-duplicates by SimHash, linked through the generalised pigeonhole principle.

The 64 bits are dealt into partitions, correlated bits together. If the
thresholds of the partitions add up to LIMIT - partitions + 1, two fingerprints
that differ in LIMIT bits at most are within the threshold in one partition at
least. Every fingerprint takes its own thresholds, by dynamic programming on
the number of fingerprints that each threshold would make it look at. It then
asks for all values that near in each partition, and what it meets is compared
in full. All counts cover all fingerprints.

Equal fingerprints are one class throughout. A value that many classes share is
dealt into chunks, and tasks hand on a spanning forest of what they link, so no
group of near copies is written out in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import row_key, texts
from tidewater.session import pin

WORDS, SEED, LIMIT = 4, 42, 4
PARTS = 4
WIDTH = 64 // PARTS
#: Thresholds a partition may get; -1 asks for nothing.
CHOICES = (-1, 0, 1, 2)
#: What a question costs, in comparisons.
ASK = 4.0
#: Classes that share a value, per chunk.
CHUNK = 4096
#: Rows that a task links at once.
ROWS, PAIRS = 200_000, 1 << 21


def fingerprint(text: str) -> int:
    """Bit by bit what over half of the shingle hashes have set."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(len(words) - WORDS + 1, 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: n - 1]]
    ends = ends[WORDS - 1 :] if len(words) >= WORDS else ends[-1:]
    digest, seed = xxhash.xxh64_intdigest, SEED
    h = np.fromiter((digest(joined[s : e - 1], seed) for s, e in zip(starts, ends, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        ones += np.unpackbits(h[i : i + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
        kept = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), pa.array(fps)], [*kept, "fp"])


def _unsigned(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy().view(np.uint64)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair of bits is set together, over one task."""
    both = np.zeros((64, 64))
    for b in batches:
        for i in range(0, b.num_rows, 1 << 16):
            bits = ((_unsigned(b.slice(i, 1 << 16))[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            both += bits.T @ bits
    yield pa.RecordBatch.from_pydict({"bit": pa.array(np.repeat(np.arange(64), 64)), "other": pa.array(np.tile(np.arange(64), 64)), "n": pa.array(both.ravel().astype(np.int64))})


def group_bits(together: np.ndarray, n: int) -> np.ndarray:
    """Bits in PARTS rows of WIDTH: each row starts at the most correlated free bit and takes the bits nearest to its own."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    near = np.abs(np.divide(together / max(n, 1) - np.outer(p, p), spread, out=np.zeros((64, 64)), where=spread > 0))
    np.fill_diagonal(near, 0)
    free, rows = set(range(64)), []
    while free:
        left = sorted(free)
        row = [max(left, key=lambda b: (near[b, left].sum(), -b))]
        free.discard(row[0])
        while len(row) < WIDTH:
            row.append(max(sorted(free), key=lambda b: (near[b, row].sum(), -b)))
            free.discard(row[-1])
        rows.append(row)
    return np.array(rows)


def _values(fps: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The value of every partition, one row each."""
    out = np.zeros((PARTS, len(fps)), np.int64)
    for i, row in enumerate(rows):
        for j, bit in enumerate(row):
            out[i] |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << j
    return out


def _masks(e: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for r in range(e + 1) for c in combinations(range(WIDTH), r)], np.int64)


def near_counts(counts: np.ndarray) -> np.ndarray:
    """For a partition's counts by value: how many lie within each choice of threshold of each value."""
    at = np.zeros((max(CHOICES) + 1, len(counts)), np.int64)
    at[0] = counts
    spot = np.arange(len(counts))
    for j in range(WIDTH):
        flipped = at[:, spot ^ (1 << j)]
        at[1:] += flipped[:-1]
    return np.stack([np.zeros_like(counts) if e < 0 else at[: e + 1].sum(axis=0) for e in CHOICES])


def allocate(costs: np.ndarray) -> np.ndarray:
    """The cheapest thresholds that add up to LIMIT - PARTS + 1; costs by partition, choice and fingerprint."""
    n, goal = costs.shape[2], LIMIT - PARTS + 1
    best, came = {0: np.zeros(n)}, []
    for i in range(PARTS):
        new, how = {}, {}
        for total, cost in best.items():
            for c, e in enumerate(CHOICES):
                to, sum_ = total + e, cost + costs[i, c]
                if to not in new:
                    new[to], how[to] = sum_, np.full(n, c)
                else:
                    less = sum_ < new[to]
                    new[to] = np.where(less, sum_, new[to])
                    how[to] = np.where(less, c, how[to])
        best = new
        came.append(how)
    out, total = np.zeros((PARTS, n), np.int64), np.full(n, goal)
    for i in range(PARTS - 1, -1, -1):
        for t, how in came[i].items():
            here = total == t
            out[i, here] = how[here]
        total = total - np.array(CHOICES)[out[i]]
    return out


def components_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node of the links a-b, root the smallest of its component."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _asker(rows: np.ndarray, counts: np.ndarray):
    """Every fingerprint as an entry in each partition, and its questions."""
    near = np.stack([near_counts(c) for c in counts])
    masks = [_masks(e) if e >= 0 else np.empty(0, np.int64) for e in CHOICES]
    chunks = np.maximum(-(-counts // CHUNK), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = _unsigned(b)
            if not len(fps):
                continue
            values = _values(fps, rows)
            costs = np.stack([near[i][:, values[i]] + ASK * np.array([len(m) for m in masks])[:, None] for i in range(PARTS)])
            chosen = allocate(costs)
            for i in range(PARTS):
                own = (fps * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % chunks[i][values[i]]
                yield _rows(i, values[i], own, fps, False)
                for c, m in enumerate(masks):
                    who = np.flatnonzero(chosen[i] == c)
                    if not len(m) or not len(who):
                        continue
                    asked = (values[i][who][:, None] ^ m).ravel()
                    asking = np.repeat(fps[who], len(m))
                    there = counts[i][asked] > 0  # nothing has the other values
                    asked, asking = asked[there], asking[there]
                    many = chunks[i][asked]
                    chunk = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    yield _rows(i, np.repeat(asked, many), chunk, np.repeat(asking, many), True)

    return run


def _rows(part: int, value: np.ndarray, chunk: np.ndarray, fps: np.ndarray, asks: bool) -> pa.RecordBatch:
    key = (part << WIDTH | value).astype(np.int32)
    return pa.RecordBatch.from_pydict({"value": pa.array(key), "chunk": pa.array(chunk.astype(np.int32)), "fp": pa.array(fps.view(np.int64)), "asks": pa.array(np.full(len(fps), asks))})


def _link_large(have: np.ndarray, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two long lists, block by block; pairs that are joined already are passed over."""
    nodes, inv = np.unique(np.concatenate([have, ask]), return_inverse=True)
    h, q, label = inv[: len(have)], inv[len(have) :], np.arange(len(nodes))
    step = max(PAIRS // max(len(have), 1), 1)
    for i in range(0, len(ask), step):
        part = q[i : i + step]
        open_ = label[part][:, None] != label[h][None, :]
        rows, cols = np.nonzero(open_)
        if not len(rows):
            continue
        x, y = part[rows], h[cols]
        close = np.bitwise_count(nodes[x] ^ nodes[y]) <= LIMIT
        if close.any():
            joined, roots = components_of(label[x[close]], label[y[close]])
            move = np.arange(len(nodes))
            move[joined] = roots
            label = move[label]
    off = label != np.arange(len(nodes))
    return nodes[off], nodes[label[off]]


def _link_groups(keys: np.ndarray, fps: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links found in whole groups, sorted by key."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
    order = np.lexsort((asks, group))  # entries before questions
    fps, asks, group = fps[order], asks[order], group[order]
    size = np.diff(np.append(starts, len(keys)))
    asking = np.bincount(group, asks, len(starts)).astype(np.int64)
    having = size - asking
    found_a, found_b = [], []
    large = np.flatnonzero(asking * having > PAIRS)
    for g in large:
        mid = starts[g] + having[g]
        a, b = _link_large(fps[starts[g] : mid], fps[mid : mid + asking[g]])
        found_a.append(a)
        found_b.append(b)
    pairs = asking * having
    pairs[large] = 0
    edges = [0, *(np.searchsorted(np.cumsum(pairs), np.arange(PAIRS, pairs.sum() + PAIRS, PAIRS), side="left") + 1)]  # 0 alone without pairs
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        n = pairs[lo:hi]
        if not n.sum():
            continue
        g = np.repeat(np.arange(lo, lo + len(n)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x = fps[starts[g] + nth % having[g]]
        y = fps[starts[g] + having[g] + nth // having[g]]
        close = (x != y) & (np.bitwise_count(x ^ y) <= LIMIT)
        found_a.append(x[close])
        found_b.append(y[close])
    if not sum(map(len, found_a)):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    nodes, roots = components_of(np.concatenate(found_a), np.concatenate(found_b))
    off = nodes != roots
    return nodes[off], roots[off]


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one task's groups, which come sorted by value and chunk."""
    held = [np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int8)]

    def out(whole: int) -> pa.RecordBatch:
        a, b = _link_groups(*(h[:whole] for h in held))
        return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    waiting, more = [], 0
    for b in batches:
        key = b.column("value").to_numpy().astype(np.int64) << 32 | b.column("chunk").to_numpy()
        waiting.append([key, _unsigned(b), b.column("asks").to_numpy(zero_copy_only=False).astype(np.int8)])
        more += b.num_rows
        if more < ROWS:
            continue
        held = [np.concatenate(x) for x in zip(held, *waiting, strict=True)]
        waiting, more = [], 0
        whole = np.searchsorted(held[0], held[0][-1])  # the last group may go on
        if whole:
            yield out(whole)
            held = [h[whole:] for h in held]
    held = [np.concatenate(x) for x in zip(held, *waiting, strict=True)]
    if len(held[0]):
        yield out(len(held[0]))


def links(classes: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of all pairs of the distinct values of ``fp`` that differ in LIMIT bits at most."""
    both = np.zeros((64, 64), np.int64)
    for r in classes.mapInArrow(_together, "bit long, other long, n long").groupBy("bit", "other").agg(F.sum("n").alias("n")).collect():  # 4,096 rows
        both[r.bit, r.other] = r.n
    n = classes.count()
    rows = group_bits(both, n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((PARTS, 1 << WIDTH), np.int64)
        for b in batches:
            for i, v in enumerate(_values(_unsigned(b), rows)):
                seen[i] += np.bincount(v, minlength=1 << WIDTH)
        part, value = np.nonzero(seen)
        yield pa.RecordBatch.from_pydict({"part": pa.array(part), "value": pa.array(value), "n": pa.array(seen[part, value])})

    counts = np.zeros((PARTS, 1 << WIDTH), np.int64)
    # PARTS * 2^WIDTH rows at most, however many fingerprints there are
    found = classes.mapInArrow(count, "part long, value long, n long").groupBy("part", "value").agg(F.sum("n").alias("n")).toArrow()
    counts[found["part"].to_numpy(), found["value"].to_numpy()] = found["n"].to_numpy()
    asked = classes.mapInArrow(_asker(rows, counts), "value int, chunk int, fp long, asks boolean")
    return asked.repartition("value", "chunk").sortWithinPartitions("value", "chunk").mapInArrow(_link, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots: the smallest node of its component.

    Stars are built by turns: every node hands its larger neighbours, then its
    smaller ones, to the smallest. Rounds grow with the logarithm of the graph.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())

    e = pin(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = state(e)
    while before[0]:
        all_ = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = all_.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m")).select("of", F.least("of", "m").alias("m"))
        large = all_.join(low, F.col("u") == F.col("of")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
        moved = large.join(least, F.col("u") == F.col("of")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = pin(moved.unionByName(least.select(F.col("of").alias("u"), F.col("m").alias("v"))).distinct())
        now = state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """One row per row of ``docs``: id, fp (long), fingerprint (16 hex digits), root, component_id, and ``more``.

    Fingerprints link when they differ in four bits at most; component_id is
    the smallest id that links lead to, itself included. A text without words,
    or a null one, has fingerprint zero, which links like any other. Null ids
    are passed over for component_id, which is null where a component has no
    other. Repeated rows come back as often. An empty table gives no rows.
    """
    base = texts(docs, id_col, text_col, **more)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != "text"), "fp long"])
    fps = pin(base.mapInArrow(_fingerprints, schema))
    classes = pin(fps.groupBy("fp").agg(F.min("id").alias("least")))
    stars = connected(links(classes.select("fp")))
    rooted = classes.join(stars, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    tops = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(tops, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: the one with the component's smallest id.

    Rows without an id come after all others; of rows that repeat an id the one
    whose text has the smallest digest, and of rows equal in both just one.
    """
    row = F.struct(*[docs[c] for c in docs.columns])
    keyed = near_groups(docs, key=row_key(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit(""))))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "key")
    stays = keyed.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.key").alias("key"))
    packed = docs.select(row.alias("row"), row_key(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit(""))).alias("key"))
    return packed.join(stays, "key").dropDuplicates(["key"]).select("row.*")
