"""Alignment of two tokenizers over the same texts: an identity map for equal tokens, a shuffle for the rest.

A text is cut where a single space precedes a letter or digit. Both vocabularies
start a token at such a place, so every distinct piece of a block of documents
is encoded and aligned once. A link joins the A and the B token that end at the
same byte. Most links are one A token against the one B token with the same
bytes; these are counted in a vector as long as A's vocabulary. Only pairs that
the map from A ids to B ids does not hold enter a shuffle, once per block.

Null, empty and undecodable texts have no tokens. Rows are taken as they are:
equal ids or texts each give their own row, other columns are left behind.
"""

from __future__ import annotations

import itertools
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import release, texts
from tidewater.session import work_dir

#: Text whose distinct pieces are encoded together.
BLOCK_BYTES = 4 << 20
#: Pieces encoded as one text, and such texts handed to an encoder at a time.
ROW = 64
CHUNK = 300
#: Documents of a block whose groups are spelled at a time.
DOCS = 128
#: Bytes of a packed block and numbers of its pairs that one row carries. Java takes a large row from the system
#: in one piece, and sooner than it gives back what is no longer used.
ROW_BYTES = 128 << 10
ROW_NUMBERS = 1 << 10
#: Rows that are read together are those of a row group.
_GROUPS = {"parquet.block.size": 2 << 20, "parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
_CUT = re.compile(r"(?<! ) (?=\w)")
_UNUSUAL = re.compile(r" (?!\w)")
_B_BITS = 20  # a pair is (A id << 20) | B id

_LAID = "block long, part int, packed binary, pairs array<long>, pair_n array<long>, ids array<int>, id_n array<long>"
RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


@dataclass(frozen=True)
class Pair:
    """Both encoders with the bytes of their tokens, and the B id of the same bytes per A id (-1: none)."""

    encode_a: Callable[[list[str]], list]
    encode_b: Callable[[list[str]], list]
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    same: np.ndarray
    size_a: np.ndarray
    size_b: np.ndarray


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: itself where printable in Latin-1, else the next code point from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def load_pair(a_json: str, b_model: bytes) -> Pair:
    """Byte-level BPE (A) and a piece model with byte fallback (B) from the contents of their files.

    Raises ValueError where pieces could cross a cut: a B piece with a space
    after another character, a normaliser, or an A pre-tokenizer other than the byte-level pattern.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_str(a_json)
    pre = a.pre_tokenizer
    if a.normalizer is not None or not isinstance(pre, tokenizers.pre_tokenizers.ByteLevel) or pre.add_prefix_space or not pre.use_regex:
        raise ValueError("A must be a byte-level BPE without normaliser and prefix space")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    pieces = [b.id_to_piece(i) for i in range(b.vocab_size())]
    if any(re.search("[^▁]▁", p) for p in pieces) or b.normalize("x  ﬁ ") != "▁x▁▁ﬁ▁":
        raise ValueError("B must keep texts as they are and start its pieces at spaces")
    alphabet = _byte_alphabet()
    plain = a.get_added_tokens_decoder()
    bytes_a = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        bytes_a[i] = token.encode() if i in plain else bytes(alphabet[c] for c in token)
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    by_bytes: dict[bytes, int] = {}
    for i in sorted(range(len(pieces)), key=b.is_byte):  # a byte's own piece before its fallback
        if not (b.is_control(i) or b.is_unknown(i)):
            by_bytes.setdefault(bytes_b[i], i)
    same = np.array([by_bytes.get(x, -1) for x in bytes_a], np.int64)
    return Pair(
        lambda keys: [e.ids for e in a.encode_batch_fast([" " + k for k in keys], add_special_tokens=False)],
        lambda keys: b.encode(keys, num_threads=1),
        bytes_a,
        bytes_b,
        same,
        np.fromiter(map(len, bytes_a), np.int64),
        np.fromiter(map(len, bytes_b), np.int64),
    )


def pieces_of(text: str) -> list[str]:
    """The pieces of space + text, each without the space it starts with."""
    if not _UNUSUAL.search(text) and text[:1].isalnum() and not text.endswith(" "):
        return text.split(" ")
    parts = _CUT.split(" " + text)
    return [parts[0][1:], *parts[1:]] if parts[0] else parts[1:]


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


@dataclass
class Aligned:
    """Pieces of a block, aligned. Links of all pieces follow each other; ``irregular`` marks those outside the map."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    a: np.ndarray
    b: np.ndarray
    irregular: np.ndarray
    text: pa.BinaryArray


@lru_cache(maxsize=2)
def _words(n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal A ids followed by a comma, by a bar, B ids by a comma, by a semicolon; and the length of each."""
    table = np.array([f"{i}{end}" for n, end in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)], "S8")
    return table, np.char.str_len(table).astype(np.int64)


def _encode_alone(keys: list[str], pair: Pair) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """Ids of both per piece, each encoded on its own; where the bytes differ there are none."""
    ids_a, ids_b, good = pair.encode_a(keys), pair.encode_b(keys), np.zeros(len(keys), bool)
    for i, k in enumerate(keys):
        raw = b" " + k.encode()
        good[i] = b"".join(map(pair.bytes_a.__getitem__, ids_a[i])) == raw and b"".join(map(pair.bytes_b.__getitem__, ids_b[i])) == raw
        if not good[i]:
            ids_a[i], ids_b[i] = [], []
    return ids_a, ids_b, good


def _encode(keys: list[str], pair: Pair) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A ids, their number per piece, B ids, their number per piece, and which pieces are good.

    Pieces that may stand after one another in a text are encoded in rows of
    ``ROW`` and told apart by their bytes; the rest, and rows with a fault, alone.
    """
    sizes = np.fromiter((len(k.encode()) + 1 for k in keys), np.int64, len(keys))
    plain = [i for i, k in enumerate(keys) if k[:1].isalnum() and k[-1] != " "]
    odd = np.ones(len(keys), bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(plain), ROW * CHUNK):
        rows = [plain[x : x + ROW] for x in range(at, min(at + ROW * CHUNK, len(plain)), ROW)]
        joined = [" ".join([keys[i] for i in row]) for row in rows]
        for row, text, x, y in zip(rows, joined, pair.encode_a(joined), pair.encode_b(joined), strict=True):
            raw = b" " + text.encode()
            if b"".join(map(pair.bytes_a.__getitem__, x)) == raw and b"".join(map(pair.bytes_b.__getitem__, y)) == raw:
                odd[row] = False
                found.append((np.array(row), np.array(x), np.array(y)))
    rest = np.nonzero(odd)[0].tolist()
    alone_a, alone_b, fine = _encode_alone([keys[i] for i in rest], pair)
    good = ~odd
    good[rest] = fine
    of = np.concatenate([*[f[0] for f in found], np.array(rest, np.int64)]).astype(np.int64)
    out = []
    for ids, alone, table in (([f[1] for f in found], alone_a, pair.size_a), ([f[2] for f in found], alone_b, pair.size_b)):
        ids = np.concatenate([*ids, *[np.array(x, np.int64) for x in alone]]) if ids or alone else np.zeros(0, np.int64)
        starts = np.concatenate([[0], np.cumsum(table[ids])])[:-1]
        ends = np.cumsum(np.where(good, sizes, 0)[of])
        place = np.searchsorted(ends, starts, side="right")  # in the order encoded; pieces without bytes get none
        number = np.bincount(place, minlength=len(of))
        # Back to the order of the keys.
        back = np.empty(len(of), np.int64)
        back[of] = np.arange(len(of))
        first = np.cumsum(number) - number
        n = number[back]
        take = np.repeat(first[back] - (np.cumsum(n) - n), n) + np.arange(len(ids))
        out += [ids[take], n]
    return out[0], out[1], out[2], out[3], good


def align_pieces(keys: list[str], pair: Pair) -> Aligned:
    """Tokens, groups and links of every piece. A piece whose tokens do not give its bytes back is not good and empty.

    Pieces do not depend on each other, so they are done a slice at a time: only results stay in memory.
    """
    parts = [_align_slice(keys[x : x + ROW * CHUNK], pair) for x in range(0, max(len(keys), 1), ROW * CHUNK)]
    arrays = [np.concatenate([getattr(p, name) for p in parts]) for name in ("good", "n_a", "n_b", "n_links", "a", "b", "irregular")]
    return Aligned(*arrays, pa.concat_arrays([p.text for p in parts]))


def _align_slice(keys: list[str], pair: Pair) -> Aligned:
    a, n_a, b, n_b, good = _encode(keys, pair)
    end_a, end_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    # Good pieces have as many bytes on either side, so both cumulated ends run in step.
    at = np.searchsorted(end_b, end_a)
    cut = np.nonzero(end_b[at] == end_a)[0] if len(a) else np.zeros(0, np.int64)
    cut_b = at[cut]
    of = np.searchsorted(np.cumsum(n_a), cut, side="right")
    n_links = np.bincount(of, minlength=len(keys))
    size_a, size_b = np.diff(cut, prepend=-1), np.diff(cut_b, prepend=-1)
    last_a, last_b = a[cut], b[cut_b]
    irregular = (size_a > 1) | (size_b > 1) | (pair.same[last_a] != last_b)
    # Group by group, A's ids and then B's, each as text with the sign that follows it.
    table, lengths = _words(len(pair.bytes_a), len(pair.bytes_b))
    code_a, code_b = a.copy(), b + 2 * len(pair.bytes_a)
    code_a[cut] += len(pair.bytes_a)
    code_b[cut_b] += len(pair.bytes_b)
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + np.repeat(cut_b + 1 - size_b, size_a)] = code_a
    codes[np.arange(len(b)) + np.repeat(cut + 1, size_b)] = code_b
    written = table[codes].tobytes().replace(b"\0", b"")
    ends = np.concatenate([[0], np.cumsum(_sums(lengths[codes], n_a + n_b))]).astype(np.int32)
    text = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(written)])
    return Aligned(good, n_a, n_b, n_links, last_a.astype(np.int32), last_b.astype(np.int32), irregular, text)


def _packed(columns: dict[str, pa.Array]) -> bytes:
    sink = pa.BufferOutputStream()
    row = pa.table({n: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for n, v in columns.items()})
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(row)
    return sink.getvalue().to_pybytes()


def _block(ids: list, docs: list[str], pair: Pair, vector: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A block packed, its irregular pairs in order and their numbers; regular links are added to ``vector``."""
    number: defaultdict[str, int] = defaultdict(itertools.count().__next__)  # bound to itself, it would wait for the collector
    seen = [np.fromiter(map(number.__getitem__, pieces_of(t)), np.int32) if t else np.zeros(0, np.int32) for t in docs]
    sizes = np.array([len(s) for s in seen], np.int64)
    order = np.concatenate([*seen, np.zeros(0, np.int32)])
    p = align_pieces(list(number), pair)
    del number, seen
    whole = (sizes > 0) & (_sums((~p.good[order]).astype(np.int64), sizes) == 0)
    order, sizes = order[np.repeat(whole, sizes)], np.where(whole, sizes, 0)
    times = np.repeat(np.bincount(order, minlength=len(p.good)), p.n_links)
    regular = ~p.irregular
    vector += np.bincount(p.a[regular], times[regular], minlength=len(vector)).astype(np.int64)
    code = (p.a.astype(np.int64) << _B_BITS) | p.b
    used = p.irregular & (times > 0)
    pairs, place = np.unique(code[used], return_inverse=True)
    pair_n = np.bincount(place, times[used], minlength=len(pairs)).astype(np.int64)
    link = p.a.astype(np.int32)  # an A id, or below zero the place of an irregular pair
    link[p.irregular] = -1
    link[used] = -1 - place.astype(np.int32)
    packed = _packed(
        {
            "id": pa.array(ids, pa.int64()),
            "size": pa.array(sizes),
            "order": pa.array(order.astype(np.int32)),
            "n_a": pa.array(p.n_a.astype(np.int32)),
            "n_b": pa.array(p.n_b.astype(np.int32)),
            "n_links": pa.array(p.n_links.astype(np.int32)),
            "link": pa.array(link),
            "text": p.text,
        }
    )
    return packed, pairs, pair_n


def _rows(block: int | None, packed: bytes, pairs: np.ndarray, pair_n: np.ndarray, ids: np.ndarray, id_n: np.ndarray) -> pa.RecordBatch:
    """A block, or a vector, in as many rows as it takes at ROW_BYTES and ROW_NUMBERS a row."""
    sizes = ((len(packed), ROW_BYTES), (len(pairs), ROW_NUMBERS), (len(ids), ROW_NUMBERS))
    n = max(-(-size // most) for size, most in sizes)
    columns = [pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([packed[i : i + ROW_BYTES] or None for i in range(0, n * ROW_BYTES, ROW_BYTES)], pa.binary())]
    ends = np.arange(n + 1) * ROW_NUMBERS
    for numbers, kind in ((pairs, pa.int64()), (pair_n, pa.int64()), (ids, pa.int32()), (id_n, pa.int64())):
        columns.append(pa.ListArray.from_arrays(pa.array(np.minimum(ends, len(numbers)), pa.int32()), pa.array(numbers, kind)))
    return pa.RecordBatch.from_arrays(columns, names=["block", "part", "packed", "pairs", "pair_n", "ids", "id_n"])


def _lay(a_json: str, b_model: bytes, block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load_pair(a_json, b_model)
        release()
        vector = np.zeros(len(pair.bytes_a), np.int64)
        task, number, none = TaskContext.get().partitionId(), itertools.count(), np.zeros(0, np.int64)
        ids, docs, size = [], [], 0

        def flush() -> pa.RecordBatch:
            packed, pairs, pair_n = _block(ids, docs, pair, vector)
            ids.clear()
            docs.clear()
            release()
            return _rows((task << 32) | next(number), packed, pairs, pair_n, none, none)

        for batch in batches:
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids.append(i)
                docs.append(t.as_py())
                size += len(docs[-1]) + 1
                if size >= block_bytes:
                    yield flush()
                    size = 0
        if ids:
            yield flush()
        release()  # the worker stays for later stages
        some = np.nonzero(vector)[0]
        yield _rows(None, b"", none, none, some, vector[some])

    return lay


def _spelled(text: pa.BinaryArray, order: np.ndarray, sizes: np.ndarray) -> pa.ChunkedArray:
    """The groups of each document from those of its pieces, ``DOCS`` to a chunk: a chunk is what goes back to Spark at a time."""
    ends, chunks = np.concatenate([[0], np.cumsum(sizes)]), []
    for x in range(0, len(sizes), DOCS):
        of = ends[x : x + DOCS + 1]
        lists = pa.ListArray.from_arrays(pa.array((of - of[0]).astype(np.int32)), text.take(pa.array(order[of[0] : of[-1]])))
        chunks.append(pc.binary_slice(pc.binary_join(lists, b""), 0, -1).cast(pa.string()))
    return pa.chunked_array(chunks, pa.string())


def _score(vector: np.ndarray, regular_best: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(blocks: pa.Table, found: pa.Table) -> pa.Table:
        load_pair.cache_clear()  # scoring needs no encoder, and the worker may have aligned before
        _words.cache_clear()
        release()
        out = []
        for packed in blocks["packed"]:
            row = pa.ipc.open_stream(packed.as_buffer()).read_all()
            arrays = {n: row[n].combine_chunks().flatten().to_numpy() for n in ("size", "order", "n_a", "n_b", "n_links", "link")}
            at = found["pos"].to_numpy()
            n, best = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
            n[at], best[at] = found["n"].to_numpy(), found["best"].to_numpy()
            link, order, sizes = arrays["link"], arrays["order"], arrays["size"]
            odd, a = -1 - np.minimum(link, -1), np.maximum(link, 0)
            per_link_n = np.where(link < 0, n[np.minimum(odd, len(at))], vector[a])
            per_link_best = np.where(link < 0, best[np.minimum(odd, len(at))], regular_best[a])
            links = arrays["n_links"].astype(np.int64)
            piece = {"n_a": arrays["n_a"], "n_b": arrays["n_b"], "n_groups": links, "n_links": links, "n_best": _sums(per_link_best, links), "count_sum": _sums(per_link_n, links)}
            columns = {"id": row["id"].combine_chunks().flatten()} | {c: pa.array(_sums(v.astype(np.int64)[order], sizes)) for c, v in piece.items()}
            out.append(pa.table(columns | {"groups": _spelled(row["text"].combine_chunks().flatten(), order, sizes)}))
        release()
        return pa.concat_tables(out) if out else pa.table({n: pa.array([], t) for n, t in _RESULT_TYPES.items()})

    return score


def _by_block(score: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``score`` for the rows of one block: parts of it, and the numbers of its pairs with their places as ``part``."""

    def one(rows: pa.Table) -> pa.Table:
        parts = rows.filter(pc.is_valid(rows["packed"])).sort_by("part")["packed"]
        found = rows.filter(pc.is_null(rows["packed"])).select(["part", "n", "best"]).rename_columns(["pos", "n", "best"])
        return score(pa.table({"packed": pa.array([b"".join(p.as_buffer() for p in parts)], pa.binary())}), found)

    return one


_RESULT_TYPES = {c.split()[0]: pa.string() if c.endswith("string") else pa.int64() for c in RESULT.split(", ")}


def align(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document its tokens, groups, links and how often the corpus holds its links; see RESULT.

    ``groups`` spells the groups as ``a1,a2|b1;a3|b2,b3``. ``n_best`` counts the
    links whose pair is the most frequent one of its B id (ties included),
    ``count_sum`` adds the corpus-wide numbers of the links' pairs.

    The blocks are written once below the shared scratch folder and read by
    three passes. What comes to the driver has one row per token id of A or B.
    """
    spark = docs.sparkSession
    pair = load_pair(a_json, b_model)
    path = work_dir(spark, "aligned")
    texts(docs, id_col, text_col).mapInArrow(_lay(a_json, b_model, block_bytes), _LAID).write.options(**_GROUPS).parquet(path)
    laid = spark.read.parquet(path)

    # Links through the identity map: one number per A id.
    totals = laid.select(F.explode(F.arrays_zip("ids", "id_n")).alias("x")).groupBy("x.ids").agg(F.sum("x.id_n").alias("n"))
    vector = np.zeros(len(pair.bytes_a), np.int64)
    for r in totals.collect():
        vector[r.ids] = r.n

    # The others: numbers per pair over all blocks, and the largest per B id.
    once = laid.where("block is not null").select("block", "part", F.posexplode(F.arrays_zip("pairs", "pair_n")).alias("pos", "x"))
    once = once.select("block", (F.col("part") * ROW_NUMBERS + F.col("pos")).alias("part"), F.col("x.pairs").alias("pair"), F.col("x.pair_n").alias("here"))
    counts = once.groupBy("pair").agg(F.sum("here").alias("n"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))
    best = np.zeros(len(pair.bytes_b), np.int64)
    for r in counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("n")).collect():
        best[r.b] = r.n
    mapped = np.nonzero(pair.same >= 0)[0]
    np.maximum.at(best, pair.same[mapped], vector[mapped])
    regular_best = np.where(pair.same >= 0, vector == best[pair.same], False).astype(np.int64)

    # Every block gets the numbers of its own pairs back.
    highest = spark.createDataFrame([(i, int(n)) for i, n in enumerate(best)], "b int, highest long")
    found = once.drop("here").join(counts, "pair").withColumn("b", b_id.cast("int")).join(F.broadcast(highest), "b")
    found = found.select("block", "part", F.lit(None).cast("binary").alias("packed"), "n", (F.col("n") == F.col("highest")).cast("long").alias("best"))
    none = F.lit(None).cast("long")
    whole = spark.read.parquet(path).where("block is not null and packed is not null")  # read anew: columns of its own
    rows = whole.select("block", "part", "packed", none.alias("n"), none.alias("best")).unionByName(found)
    return rows.groupBy("block").applyInArrow(_by_block(_score(vector, regular_best)), RESULT)
