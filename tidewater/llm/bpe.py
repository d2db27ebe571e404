"""Byte-level BPE by a global shuffle of distinct words.

Documents are dealt into blocks. Each block sends its distinct pre-tokens,
sorted and packed by the part of the vocabulary they belong to; a part meets
them from all blocks and encodes every distinct one once; the ids go back to
the blocks in the order the words came, and each document is put together
again by position. A row per pre-token would be a multiple of the text in
shuffled bytes, so positions stay in their block as numbers of its words.

Decoding joins ids with the table of token bytes by position in each task; the
table has one row per id of the vocabulary file, whatever the corpus.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Iterator
from itertools import chain, count, pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import Column, DataFrame

from tidewater.llm.common import BLOCK_BYTES, block_count, frugal, in_blocks, texts, unpack


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids from a rank file: base64 and the id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


#: Bytes of a word up to which looking through all pairs is faster than keeping them in order.
SHORT = 64
NO_RANK = 1 << 62


def _encode_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same as ``encode_word`` by a list of the pairs' ranks."""
    get, cuts = ranks.get, list(range(len(word) + 1))
    pairs = [get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while pairs and (lowest := min(pairs)) != NO_RANK:
        i = pairs.index(lowest)
        del pairs[i], cuts[i + 1]
        if i < len(pairs):
            pairs[i] = get(word[cuts[i] : cuts[i + 2]], NO_RANK)
        if i:
            pairs[i - 1] = get(word[cuts[i - 1] : cuts[i + 1]], NO_RANK)
    return [ranks[word[a:b]] for a, b in pairwise(cuts)]


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged, the leftmost first, until none has a rank.

    Pairs of a long word wait in a heap, so it takes n log n steps.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= SHORT:
        return _encode_short(word, ranks)
    ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    gone = bytearray(n)
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank = ranks.get(word[i : ends[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ends[j]))

    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j >= n or ends[j] != end:
            continue  # one side has been merged since
        gone[j] = 1
        ends[i], after[i] = end, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : ends[i]]])
        i = after[i]
    return out


#: Documents decoded at a time, which go back to Spark together.
DOCS = 256
#: A space splits the text if no blank is before it: the pattern takes it as the start of what follows, whatever comes before.
GAP = re.compile(r"\s ")
SPLIT = re.compile(r"(?<!\s) ")


def _pieces(text: str) -> list[str]:
    """The text at the spaces that split it; all but the first piece have lost the space they start with."""
    return SPLIT.split(text) if text.startswith(" ") or GAP.search(text) else text.split(" ")


def _by_part(words: Iterable[str], parts: int) -> list[tuple[list[bytes], list[str]]]:
    """The words' bytes and the words, dealt by hash and sorted: the same order whenever the block is read.

    Plain strings are sorted, all at once, which takes a fraction of the time of pairs or bytes.
    """
    dealt: list[tuple[list[bytes], list[str]]] = [([], []) for _ in range(parts)]
    for w in sorted(words):
        raw = w.encode("utf-8", "surrogatepass")
        some, same = dealt[crc32(raw) % parts]
        some.append(raw)
        same.append(w)
    return dealt


def _block_words(pattern: str, parts: int) -> Callable[[pa.Table], pa.Table]:
    def run(block: pa.Table) -> pa.Table:
        find, pieces, seen = regex.compile(pattern).findall, set(), set()
        for t in unpack(block)["text"]:
            first, *rest = _pieces(t.as_py())
            seen.update(find(first))
            pieces.update(rest)
        seen.update(chain.from_iterable(map(find, map(" ".__add__, pieces))))
        shrink = zstandard.ZstdCompressor(level=3).compress
        number = block["block"][0].as_py()
        dealt = [(i, some) for i, (some, _) in enumerate(_by_part(seen, parts)) if some]
        return pa.table({
            "part": pa.array([i for i, _ in dealt], pa.int32()),
            "block": pa.array([number] * len(dealt), pa.int32()),
            "sizes": pa.array([shrink(np.array([len(w) for w in some], np.int32).tobytes()) for _, some in dealt], pa.binary()),
            "words": pa.array([shrink(b"".join(some)) for _, some in dealt], pa.binary()),
        })

    return run


def _encode_part(ranks: dict[bytes, int]) -> Callable[[pa.Table], pa.Table]:
    def run(sent: pa.Table) -> pa.Table:
        shrink, grow = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress
        sizes = [np.frombuffer(grow(s.as_py()), np.int32) for s in sent["sizes"]]
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]))
        raw = b"".join(grow(w.as_py()) for w in sent["words"])
        words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(raw)]).dictionary_encode()
        # Distinct words are found by Arrow and encoded once; the blocks get theirs by position.
        coded = [encode_word(w.as_py(), ranks) for w in words.dictionary]
        n = np.fromiter(map(len, coded), np.int64, len(coded))
        flat, starts, which = np.fromiter(chain.from_iterable(coded), np.int32, n.sum()), np.cumsum(n) - n, words.indices.to_numpy()
        counts, ids, at = [], [], 0
        for size in map(len, sizes):
            some = which[at : at + size]
            at += size
            counts.append(shrink(n[some].astype(np.int32).tobytes()))
            ids.append(shrink(flat[_ranges(starts[some], n[some])].tobytes()))
        return pa.table({"block": sent["block"], "part": sent["part"], "counts": pa.array(counts, pa.binary()), "ids": pa.array(ids, pa.binary())})

    return run


def _numbered() -> defaultdict[Hashable, int]:
    """A dictionary that numbers its keys in the order they are first asked for; one bound to itself would wait for the collector."""
    return defaultdict(count().__next__)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _reassemble(pattern: str, parts: int, carried: list[str], tokens: pa.BinaryArray | None = None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(block: pa.Table, sent: pa.Table) -> pa.Table:
        docs, grow = unpack(block), zstandard.ZstdDecompressor().decompress
        find, codes = regex.compile(pattern).findall, []
        firsts, pieces, numbers = [], _numbered(), _numbered()
        for t in docs["text"]:
            first, *rest = _pieces(t.as_py())
            firsts.append(first)
            codes.append(np.fromiter(map(pieces.__getitem__, rest), np.int32, len(rest)))
        place = numbers.__getitem__
        # The first pieces, which have lost no space, come after all others, one a text.
        codes = [np.concatenate([np.array([len(pieces) + i], np.int32), code]) for i, code in enumerate(codes)]
        found = [*map(find, map(" ".__add__, pieces)), *map(find, firsts)]
        n_words = np.fromiter(map(len, found), np.int64, len(found))
        word = np.fromiter(map(place, chain.from_iterable(found)), np.int64, n_words.sum())
        del firsts, pieces, found
        order = {p: i for i, p in enumerate(sent["part"].to_pylist())}
        counts, starts, flat, base = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64), [], 0
        for part, (_, of_part) in enumerate(_by_part(numbers, parts)):
            if not of_part:
                continue
            row, where = order[part], list(map(place, of_part))
            c = np.frombuffer(grow(sent["counts"][row].as_py()), np.int32).astype(np.int64)
            counts[where], starts[where] = c, base + np.cumsum(c) - c
            flat.append(np.frombuffer(grow(sent["ids"][row].as_py()), np.int32))
            base += len(flat[-1])
        ids = np.concatenate(flat) if flat else np.empty(0, np.int32)
        of_pieces = ids[_ranges(starts[word], counts[word])]
        upto = np.concatenate([[0], np.cumsum(counts[word])])[np.concatenate([[0], np.cumsum(n_words)])]
        starts, counts, sizes, values = upto[:-1], np.diff(upto), [], []
        for code in codes:
            values.append(of_pieces[_ranges(starts[code], counts[code])])
            sizes.append(len(values[-1]))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values) if values else ids))
        out = {**{c: docs[c] for c in carried}, "ids": lists}
        if tokens is not None:
            del codes, of_pieces, word, values, ids, flat
            out["decoded"] = pa.chunked_array([_decoded(tokens, lists.slice(i, DOCS)) for i in range(0, len(lists), DOCS)], pa.binary())
        return pa.table(out)

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, decoded: bool = False, **more: Column) -> DataFrame:
    """(id, ids, ...) for every row of ``docs``: the token ids of its whole text.

    Each match of ``pattern`` is encoded on its own, special tokens don't exist.
    A null or empty text has no ids. Rows with null or repeated ids are rows
    like any other. An empty table gives no rows. ``decoded`` adds the column
    that ``decode`` would, in the task that has the ids, which saves a second
    worker beside it.

    Blocks hold about ``block_bytes`` of text, and there is one part for three
    blocks, whatever the shuffle setting: their number follows the size of the
    texts, which are read once more for it.
    """
    base = texts(docs, id_col, text_col, **more)
    blocks = block_count(base, block_bytes)
    parts = -(-blocks // 3)
    placed = in_blocks(base, blocks)
    packed = "part int, block int, sizes binary, words binary"
    words = placed.groupBy("block").applyInArrow(frugal(_block_words(pattern, parts)), packed)
    coded = words.groupBy("part").applyInArrow(frugal(_encode_part(ranks)), "block int, part int, counts binary, ids binary")
    carried = [c for c in base.columns if c != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != "text"), "ids array<int>"])
    if decoded:
        schema += ", decoded binary"
    whole = _reassemble(pattern, parts, carried, _token_table(ranks) if decoded else None)
    return placed.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(frugal(whole), schema)


def _token_table(ranks: dict[bytes, int]) -> pa.BinaryArray:
    """The bytes of every id, null where there is no token."""
    table = np.full(max(ranks.values(), default=-1) + 1, None, dtype=object)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.binary())


def _decoded(tokens: pa.BinaryArray, lists: pa.ListArray) -> pa.BinaryArray:
    """The bytes of each list of ids."""
    raw = pc.take(tokens, lists.flatten())
    if raw.null_count:
        raise ValueError("an id without a token")
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    places = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1] if len(raw) else np.zeros(1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(places[ends].astype(np.int32).tobytes()), raw.buffers()[2] if len(raw) else pa.py_buffer(b"")])


def decode(coded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """``coded`` with a column ``decoded``, the bytes of its ids; null ids give no bytes. An id that isn't in the table fails."""
    tokens = _token_table(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = pc.fill_null(b.column(ids_col), pa.scalar([], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*b.columns, _decoded(tokens, lists)], [*b.schema.names, "decoded"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema if f.name != "decoded"), "decoded binary"])
    return coded.drop("decoded").mapInArrow(run, schema)
