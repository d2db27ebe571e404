"""Passages of 50 bytes or more that an earlier document holds, by merging sorted suffix runs.

Only suffixes that start at anchors are sorted. An anchor is a place whose
16-byte hash is the smallest of 35 in a row, so every 50-byte string has one,
and equal strings have it at the same offset: what lies up to 34 bytes before
an anchor and 50 after it decides about every 50-byte string around it.

1. Documents are dealt into blocks. Blocks send the hashes of their anchors;
   an anchor whose 16 bytes are in no second document can't be in a passage
   that repeats, and goes no further.
2. Each block sorts the suffixes at the anchors left, equal ones as one entry
   with the smallest id, and sends them as front-coded runs, dealt by the
   hash of their first 16 bytes.
3. A part merges its runs with a loser tree that keeps the common prefix of
   every waiting suffix with the last one out, so known prefixes are never
   compared again. The merged order with its prefix lengths, and the same of
   what stands before the anchors, gives every entry the smallest id that
   holds each of its 50-byte strings.
4. The answers go back to the blocks, which remove the bytes.

Entries with equal bytes meet once per block, so a passage in a third of all
documents is as many rows as there are blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidewater.llm.common import BLOCK_BYTES, block_count, frugal, in_blocks, texts, unpack

SIZE, GRAM = 50, 16
WINDOW = SIZE - GRAM + 1
BEFORE = WINDOW - 1
#: Bytes of a block that are searched for anchors at once.
STRETCH = 1 << 20
#: Entries whose answers are laid out at once.
SLICE = 1 << 15
#: Stands for a null id, so that it comes after all others.
LAST_ID = 2**63 - 1
MULT = 0x9E3779B97F4A7C15
PACKED = "part int, block int, kind int, a binary, b binary, c binary, d binary, e binary"


def _rolling(hashes: np.ndarray, n: int, pick: Callable) -> np.ndarray:
    """pick (minimum or maximum) over every ``n`` values in a row."""
    out, have = hashes, 1
    while have * 2 <= n:
        out, have = pick(out[:-have], out[have:]), have * 2
    return out if have == n else pick(out[: len(out) - (n - have)], out[n - have :])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in ``data``, whole documents that end at ``ends``, and their 63-bit hashes."""
    if len(data) < SIZE:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h, have, base = data.astype(np.uint64) + np.uint64(1), 1, MULT
    while have < GRAM:
        h = h[:-have] * np.uint64(base) + h[have:]
        have, base = have * 2, base * base % 2**64
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    rank = (h >> np.uint64(32)).astype(np.uint32)
    if len(rank) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = _rolling(rank, WINDOW, np.minimum)
    across = (ends[:-1, None] - np.arange(1, SIZE)).ravel()  # strings that run into the next document have no anchor
    least[across[(across >= 0) & (across < len(least))]] = 0
    pad = np.zeros(WINDOW - 1, np.uint32)
    chosen = rank == _rolling(np.concatenate([pad, least, pad]), WINDOW, np.maximum)
    spots = np.flatnonzero(chosen)
    # mixed anew, since anchors are where the upper bits are small, and parts go by the upper bits
    mixed = (h[spots] ^ h[spots] >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
    return spots, mixed >> np.uint64(1)


class Block:
    """The documents of one block as bytes in a row, and the anchors in them."""

    def __init__(self, packed: pa.Table):
        self.docs = unpack(packed)
        self.number = packed["block"][0].as_py()
        self.ids = self.docs["id"].fill_null(LAST_ID).to_numpy()
        text = self.docs["text"].combine_chunks().cast(pa.binary())
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        self.data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.starts, self.ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        spots, hashes, first = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
        while first < len(self.ids):
            last = max(int(np.searchsorted(self.ends, self.starts[first] + STRETCH, side="right")), first + 1)
            lo, hi = self.starts[first], self.ends[last - 1]
            s, h = anchors(self.data[lo:hi], self.ends[first:last] - lo)
            spots.append(s + lo)
            hashes.append(h)
            first = last
        self.spots, self.hashes = np.concatenate(spots), np.concatenate(hashes)
        self.doc = np.searchsorted(self.ends, self.spots, side="right")

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct hashes, whether each is in several documents, and the hash number of every anchor."""
        order = np.argsort(self.hashes, kind="stable")
        h = self.hashes[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
        starts = np.flatnonzero(new)
        if not len(h):
            return h, np.empty(0, bool), np.empty(0, np.int64)
        doc = self.doc[order]
        several = doc[starts] != doc[np.append(starts[1:], len(h)) - 1]
        number = np.empty(len(h), np.int64)
        number[order] = np.cumsum(new) - 1
        return h[starts], several, number

    def keep(self, some: np.ndarray) -> None:
        self.spots, self.hashes, self.doc = self.spots[some], self.hashes[some], self.doc[some]

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct context (suffix and length, then what stands before it and its length): the bytes; per anchor its number; the hash of each; the order of anchors."""
        n = len(self.spots)
        rows = np.zeros((n, SIZE + 1 + BEFORE + 1), np.uint8)
        padded = np.concatenate([np.zeros(BEFORE, np.uint8), self.data, np.zeros(SIZE, np.uint8)])
        rows[:, :SIZE] = np.lib.stride_tricks.sliding_window_view(padded, SIZE)[self.spots + BEFORE]
        rows[:, SIZE + 1 : -1] = np.lib.stride_tricks.sliding_window_view(padded, BEFORE)[self.spots][:, ::-1]
        right = np.minimum(self.ends[self.doc] - self.spots, SIZE)
        left = np.minimum(self.spots - self.starts[self.doc], BEFORE)
        for cut, size, at in ((right, SIZE, 0), (left, BEFORE, SIZE + 1)):
            short = np.flatnonzero(cut < size)
            part = rows[short, at : at + size]
            part[np.arange(size) >= cut[short][:, None]] = 0
            rows[short, at : at + size] = part
        rows[:, SIZE], rows[:, -1] = right, left
        order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
        rows = rows[order]
        new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])[:n]
        number = np.empty(n, np.int64)
        number[order] = np.cumsum(new) - 1
        return rows[new], number, self.hashes[order][new], order


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(31)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pack(rows: list[tuple]) -> pa.Table:
    names = [f.split()[0] for f in PACKED.split(", ")]
    kinds = [pa.int32()] * 3 + [pa.binary()] * 5
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _squeeze(sorted_numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Rising 64-bit numbers as differences of as few bytes as the largest needs."""
    steps = np.diff(sorted_numbers, prepend=np.uint64(0))
    width = max((int(steps.max()).bit_length() + 7) // 8, 1) if len(steps) else 1
    return bytes([width]), np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unsqueeze(width: bytes, packed: bytes) -> np.ndarray:
    steps = np.zeros((len(packed) // width[0], 8), np.uint8)
    steps[:, : width[0]] = np.frombuffer(packed, np.uint8).reshape(-1, width[0])
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _send_hashes(parts: int) -> Callable[[pa.Table], pa.Table]:
    def run(docs: pa.Table) -> pa.Table:
        found = Block(docs)
        h, several, _ = found.distinct()
        block, cuts = found.number, np.searchsorted(_part_of(h, parts), np.arange(parts + 1))
        return _pack([(p, block, 0, *_squeeze(h[lo:hi]), np.packbits(several[lo:hi]).tobytes(), b"", b"") for p, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if hi > lo])

    return run


def _find_repeated(sent: pa.Table) -> pa.Table:
    """For each block and hash that it sent, whether a second document has it: a bit each, in the order sent."""
    runs = [_unsqueeze(w.as_py(), a.as_py()) for w, a in zip(sent["a"], sent["b"], strict=True)]
    flags = [np.unpackbits(np.frombuffer(f.as_py(), np.uint8), count=len(r)).astype(bool) for f, r in zip(sent["c"], runs, strict=True)]
    every = np.sort(np.concatenate(runs))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    rows = []
    for part, block, run, flag in zip(sent["part"].to_pylist(), sent["block"].to_pylist(), runs, flags, strict=True):
        at = np.minimum(np.searchsorted(twice, run), max(len(twice) - 1, 0))
        again = flag | (twice[at] == run) if len(twice) else flag
        rows.append((part, block, 0, np.packbits(again).tobytes(), len(run).to_bytes(8, "little"), b"", b"", b""))
    return _pack(rows)


def _repeated_anchors(docs: pa.Table, sent: pa.Table) -> Block:
    """The block with those anchors only whose bytes another document has too."""
    block = Block(docs)
    _, _, number = block.distinct()
    bits = [np.unpackbits(np.frombuffer(a, np.uint8), count=int.from_bytes(b, "little")) for _, k, a, b in sorted(zip(*(sent[c].to_pylist() for c in ("part", "kind", "a", "b")), strict=True)) if k == 0]
    again = np.concatenate([np.empty(0, np.uint8), *bits]).astype(bool)
    block.keep(again[number])
    return block


def _common(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before, within their lengths; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[1:] = np.minimum(first, np.minimum(lengths[1:], lengths[:-1]))
    return out


def _send_runs(parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, sent: pa.Table) -> pa.Table:
        if not docs.num_rows or not sent.num_rows:
            return _pack([])
        block, out = _repeated_anchors(docs, sent), []
        rows, number, hashes, order = block.contexts()
        if not len(rows):
            return _pack([])
        ids, sorted_number = block.ids[block.doc][order], number[order]
        starts = np.searchsorted(sorted_number, np.arange(len(rows)))
        least = np.minimum.reduceat(ids, starts)
        several = least != np.maximum.reduceat(ids, starts)
        part, n = _part_of(hashes, parts), block.number
        by_part = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[by_part], np.arange(parts + 1))
        shrink = zstandard.ZstdCompressor(level=1).compress
        for p in range(parts):
            own = by_part[cuts[p] : cuts[p + 1]]
            if not len(own):
                continue
            mine = rows[own]
            new = np.concatenate([[True], (mine[1:, : SIZE + 1] != mine[:-1, : SIZE + 1]).any(axis=1)])
            suffix = mine[new]
            length = suffix[:, SIZE].astype(np.int64)
            common = _common(suffix[:, :SIZE], length)
            spot = np.arange(SIZE)
            rest = suffix[:, :SIZE][(spot >= common[:, None]) & (spot < length[:, None])]
            heads = np.stack([common, length], axis=1).astype(np.uint8)
            members = np.diff(np.append(np.flatnonzero(new), len(own))).astype(np.int32)
            before = mine[:, SIZE + 1 :].copy()
            before[:, -1] |= several[own].astype(np.uint8) << 7
            out.append((p, n, 1, shrink(heads.tobytes()), shrink(rest.tobytes()), shrink(members.tobytes()), shrink(before.tobytes()), shrink(least[own].tobytes())))
        return _pack(out)

    return run


def merge_runs(runs: list[list[bytes]], commons: list[list[int]]) -> tuple[list[int], list[int]]:
    """Run numbers in merged order, each for the next suffix of that run, and the common prefix of each with the one before.

    A loser tree: a node keeps the run that lost there. ``known[r]`` is the
    common prefix of run r's next suffix with the last one out of those it has
    met; the longer one is the smaller suffix, and only where they tie are
    bytes looked at, from there on.
    """
    k = len(runs)
    size = 1 << max(k - 1, 0).bit_length()
    heads: list[bytes | None] = [r[0] if r else None for r in runs] + [None] * (size - k)
    at, known, losers = [0] * size, [0] * size, [-1] * size
    order, common = [], []

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        i, j = known[a], known[b]
        if i != j:
            return (a, b) if i > j else (b, a)
        if x[i:] == y[i:]:
            known[max(a, b)] = len(x)
            return min(a, b), max(a, b)
        n = min(len(x), len(y))
        apart = int.from_bytes(x[i:n]) ^ int.from_bytes(y[i:n])
        m = n - (apart.bit_length() + 7) // 8
        if m == n:
            a_first = len(x) < len(y)
        else:
            a_first = x[m] < y[m]
        if a_first:
            known[b] = m
            return a, b
        known[a] = m
        return b, a

    def fill(node: int) -> int:
        if node >= size:
            return node - size
        winner, loser = play(fill(2 * node), fill(2 * node + 1))
        losers[node] = loser
        return winner

    winner = fill(1)
    while heads[winner] is not None:
        order.append(winner)
        common.append(known[winner])
        at[winner] += 1
        if at[winner] < len(runs[winner]):
            heads[winner], known[winner] = runs[winner][at[winner]], commons[winner][at[winner]]
        else:
            heads[winner] = None
        node = winner + size >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1
    return order, common


def _merge_part(sent: pa.Table) -> pa.Table:
    """For every entry of every block: ranges of offsets and the smallest id that holds the 50-byte strings there."""
    grow = zstandard.ZstdDecompressor().decompress
    blocks, runs, commons, members, befores, least = [], [], [], [], [], []
    for row in sent.sort_by("block").to_pylist():
        heads = np.frombuffer(grow(row["a"]), np.uint8).reshape(-1, 2)
        rest, run, last, spot = grow(row["b"]), [], b"", 0
        for common, length in heads.tolist():
            last = last[:common] + rest[spot : spot + length - common]
            spot += length - common
            run.append(last)
        blocks.append(row["block"])
        runs.append(run)
        commons.append(heads[:, 0].tolist())
        members.append(np.frombuffer(grow(row["c"]), np.int32))
        befores.append(np.frombuffer(grow(row["d"]), np.uint8).reshape(-1, BEFORE + 1))
        least.append(np.frombuffer(grow(row["e"]), np.int64))
    order, common = merge_runs(runs, commons)
    del runs, commons
    order, common = np.array(order, np.int32), np.array(common, np.int32)
    places = np.concatenate([np.repeat(np.flatnonzero(order == r), m) for r, m in enumerate(members)])
    owner = np.repeat(np.arange(len(befores)), [len(b) for b in befores])
    nth = np.concatenate([np.arange(len(b)) for b in befores])
    before, ids = np.concatenate(befores), np.concatenate(least)
    several, left = before[:, -1] >> 7 == 1, (before[:, -1] & 127).astype(np.int64)
    right = np.concatenate([np.frombuffer(grow(a), np.uint8).reshape(-1, 2)[:, 1] for a in sent.sort_by("block")["a"].to_pylist()]).astype(np.int64)
    right = np.repeat(right, np.concatenate(members))
    bare = before.copy()
    bare[:, -1] = left
    keys, turn = _ranked(bare)
    left_common = _common(keys[:, :BEFORE], keys[:, -1].astype(np.int64))
    every, ids = np.unique(ids, return_inverse=True)  # ids by rank from here on, half the memory
    ids, none = ids.astype(np.int32), len(every)
    smallest = np.full((WINDOW, len(ids)), none, np.int32)
    for t in range(WINDOW):
        group = np.cumsum(common < SIZE - t)[places] * (len(keys) + 1) + np.cumsum(left_common < t)[turn]
        by = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], group[by][1:] != group[by][:-1]]))
        low = np.minimum.reduceat(ids[by], starts)
        smallest[t, by] = np.repeat(low, np.diff(np.append(starts, len(ids))))
        there = (t <= left) & (SIZE - t <= right) & (several | (smallest[t] < ids))
        smallest[t, ~there] = none
    found = []
    for i in range(0, len(ids), SLICE):
        some = smallest[:, i : i + SLICE]
        change = np.ones((WINDOW + 1, some.shape[1]), bool)
        change[1:-1] = some[1:] != some[:-1]
        entry, lo = np.nonzero((change[:-1] & (some < none)).T)
        _, hi = np.nonzero((change[1:] & (some < none)).T)
        found.append(np.stack([entry + i, lo, hi]))
    who, lo, hi = np.concatenate(found, axis=1)
    rows, part = [], sent["part"][0].as_py()
    shrink = zstandard.ZstdCompressor(level=1).compress
    cuts = np.searchsorted(owner[who], np.arange(len(blocks) + 1))
    for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            w = who[a:b]
            rows.append((part, blocks[r], 2, shrink(nth[w].astype(np.int32).tobytes()), shrink(np.stack([lo[a:b], hi[a:b]], axis=1).astype(np.uint8).tobytes()), shrink(every[smallest[lo[a:b], w]].tobytes()), b"", b""))
    return _pack(rows)


def _ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the place of every row among them."""
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")
    ordered = rows[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])[: len(rows)]
    turn = np.empty(len(rows), np.int64)
    turn[order] = np.cumsum(new) - 1
    return ordered[new], turn


def _covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Flags of the places that lie in a span."""
    gone = np.zeros(n, bool)
    if len(spans):
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        reach = np.maximum.accumulate(spans[:, 1])
        first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
        for lo, hi in zip(spans[first, 0].tolist(), reach[np.append(first[1:], len(spans)) - 1].tolist(), strict=True):
            gone[lo:hi] = True
    return gone


def _remove(parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(docs: pa.Table, sent: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        block = _repeated_anchors(docs, sent)
        spans = [np.empty((0, 2), np.int64)]
        rows, number, hashes, order = block.contexts()
        by_part = np.argsort(_part_of(hashes, parts), kind="stable")
        cuts = np.searchsorted(_part_of(hashes, parts)[by_part], np.arange(parts + 1))
        at = np.searchsorted(number[order], np.arange(len(rows) + 1))
        grow = zstandard.ZstdDecompressor().decompress
        for row in sent.to_pylist():
            if row["kind"] != 2:
                continue
            entry = by_part[cuts[row["part"]] : cuts[row["part"] + 1]][np.frombuffer(grow(row["a"]), np.int32)]
            offsets = np.frombuffer(grow(row["b"]), np.uint8).reshape(-1, 2).astype(np.int64)
            holder = np.frombuffer(grow(row["c"]), np.int64)
            many = at[entry + 1] - at[entry]
            member = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(at[entry], many)]
            lo, hi, first = (np.repeat(x, many) for x in (offsets[:, 0], offsets[:, 1], holder))
            later = block.ids[block.doc[member]] > first
            spot = block.spots[member][later]
            spans.append(np.stack([spot - hi[later], spot - lo[later] + SIZE], axis=1))
        gone = _covered(np.concatenate(spans), len(block.data))
        out = []
        for i, lo, hi in zip(block.docs["id"].to_pylist(), block.starts.tolist(), block.ends.tolist(), strict=True):
            mask, whole = gone[lo:hi], block.data[lo:hi]
            removed = int(mask.sum())
            runs = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if removed else 0
            out.append((i, hi - lo, removed, runs, (whole[~mask] if removed else whole).tobytes()))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept (the bytes that stay).

    Removed is each byte of the UTF-8 text that lies in a 50-byte string which
    also starts in a document with a smaller id. Strings never run from one
    document into the next, and are judged on the input. A null text is empty.
    A null id is larger than all others; rows with the same id, null or not,
    don't take bytes from each other. An empty table gives no rows.

    Blocks hold about ``block_bytes`` of text, and there are two parts a block,
    whatever the shuffle setting: their number follows the size of the texts,
    which are read once more for it.
    """
    base = texts(docs, id_col, text_col)
    blocks = block_count(base, block_bytes)
    parts = 2 * blocks
    by_block = in_blocks(base, blocks).groupBy("block")
    hashes = by_block.applyInArrow(frugal(_send_hashes(parts)), PACKED)
    repeated = hashes.groupBy("part").applyInArrow(frugal(_find_repeated), PACKED)
    runs = by_block.cogroup(repeated.groupBy("block")).applyInArrow(frugal(_send_runs(parts)), PACKED)
    answers = runs.groupBy("part").applyInArrow(frugal(_merge_part), PACKED)
    back = repeated.unionByName(answers)
    return by_block.cogroup(back.groupBy("block")).applyInArrow(frugal(_remove(parts)), "id long, n_bytes long, n_removed long, n_spans long, kept binary")
