"""Helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator
from contextlib import suppress
from inspect import signature

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Text that a block of documents should hold; one document is never cut.
BLOCK_BYTES = 4 << 20


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """(id, text, ...) of every row; a null text counts as empty, other columns are left behind."""
    return docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *[c.alias(n) for n, c in more.items()])


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    ascii_only = F.char_length(c) == F.octet_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(NOT_BLANK + "+")).cast("long")


def row_key(id_col: Column, text: Column) -> Column:
    """A text key, never null, that only rows with the same id and text share."""
    return F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("null")), F.md5(text))


def with_text(rows: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """The columns of the struct ``row`` with another text, and n_chars, where there is one, to match."""
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    changed = rows.select("row", *[new[c].alias(f"new_{c}") for c in ("text", "n_chars") if c in columns])
    return changed.select(*[F.col(f"new_{c}").alias(c) if c in new else F.col("row")[c].alias(c) for c in columns])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each block as one compressed Arrow stream per batch."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for b in batches:
        rows = pa.Table.from_batches([b]).sort_by("block")
        found = rows["block"].combine_chunks().value_counts()
        at, blocks, packed = 0, [], []
        for block, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                out.write_table(rows.slice(at, n))
            at += n
            blocks.append(block)
            packed.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int32()), "packed": pa.array(packed, pa.binary())})


def in_blocks(base: DataFrame, blocks: int) -> DataFrame:
    """(block, packed): the rows of ``base`` dealt into blocks by id and text, many to a row, so that the shuffle moves compressed text."""
    placed = base.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))
    return placed.mapInArrow(_pack, "block int, packed binary").repartition("block")


def block_count(base: DataFrame, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the texts make; reads them once, one number comes to the driver."""
    size = base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    return max(math.ceil((size or 0) / block_bytes), 1)


def unpack(block: pa.Table) -> pa.Table:
    """The rows of one block."""
    return pa.concat_tables(pa.ipc.open_stream(p.as_buffer()).read_all() for p in block["packed"])


def release() -> None:
    """Give freed memory back to the system: a worker serves many blocks and would keep what the largest one needed."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def frugal(f: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """A block function that releases memory before and after its work."""

    def one(a: pa.Table) -> pa.Table:
        release()
        try:
            return f(a)
        finally:
            release()

    def two(a: pa.Table, b: pa.Table) -> pa.Table:
        release()
        try:
            return f(a, b)
        finally:
            release()

    return two if len(signature(f).parameters) == 2 else one


def remove_path(df: DataFrame, path: str) -> None:
    """Delete a work folder in whatever store holds it."""
    jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
