"""WARC archives in Zstandard files: a writer, and a reader that checks all it reads.

A file starts with a skippable frame that holds the dictionary; each record is
one frame that needs it. Tasks make the frames and Spark's text writer puts
them down, so files go wherever Spark can write: a row is one frame, and the
line separator is an empty skippable frame, which every reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import remove_path
from tidewater.session import pin, work_dir

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = 0xFD2FB528
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0).decode()
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

DICTIONARY_BYTES = 32_768
#: Records that an archive's dictionary is made from: a bound on memory, all others are written with it.
SAMPLE = 256
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit has no payload, its headers say what the payload was."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    uri = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """The fields of a record; raises where headers, lengths or digests don't agree."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    pairs = [line.partition(":") for line in lines[1:]]
    if not all(colon for _, colon, _ in pairs):
        raise ValueError("a header without a colon")
    fields = {name.strip().lower(): value.strip() for name, _, value in pairs}
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing:
        raise ValueError(f"missing headers: {sorted(missing)}")
    size = int(fields["content-length"])
    block, tail = rest[:size], rest[size:]
    if len(block) != size or tail != b"\r\n\r\n":
        raise ValueError("the block is not as long as its header says")
    if fields.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ValueError("the block does not match its digest")
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    length = next((int(v) for k, _, v in (line.partition(b":") for line in http.split(b"\r\n")) if k.lower() == b"content-length"), None)
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind, refers = fields["warc-type"], fields.get("warc-refers-to")
    if kind == "response" and (length != len(payload) or said != digest(payload)):
        raise ValueError("the payload does not match its length or digest")
    if kind == "revisit" and (payload or refers is None or length is None):
        raise ValueError("a revisit with a payload, or without what it refers to")
    return _page(fields["warc-record-id"]), length, said, kind, None if refers is None else _page(refers), fields.get("warc-target-uri"), None if kind == "revisit" else payload


def make_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or plain content where the samples are too few or too small to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:].ljust(8, b" ")


def _archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frames of one archive: the dictionary's, then one per record."""
    packer, waiting = None, []

    def frames(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"frame": pa.array([packer.compress(r) for r in records], pa.binary())})

    def start() -> pa.RecordBatch:
        nonlocal packer
        raw = make_dictionary(waiting)
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True, write_content_size=True)
        return pa.RecordBatch.from_pydict({"frame": pa.array([struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw], pa.binary())})

    for batch in batches:
        for i in range(0, batch.num_rows, SAMPLE):
            c = batch.slice(i, SAMPLE).to_pydict()
            waiting += [record(p, u, h or b"", r, v) for p, u, h, r, v in zip(c["page_id"], c["url"], c["html"], c["refers_to"], c["revisit"], strict=True)]
            if packer is None and len(waiting) < SAMPLE:
                continue
            if packer is None:
                yield start()
            yield frames(waiting)
            waiting = []
    if waiting:
        if packer is None:
            yield start()
        yield frames(waiting)


def frame_size(data: memoryview) -> int:
    """Bytes of the Zstandard frame that ``data`` starts with."""
    params = zstandard.get_frame_parameters(bytes(data[:18]))
    at = zstandard.frame_header_size(bytes(data[:18]))
    while True:
        if at + 3 > len(data):
            raise ValueError("a frame is cut off")
        head = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    at += 4 * params.has_checksum
    if at > len(data):
        raise ValueError("a frame is cut off")
    return at


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of one archive, a frame at a time."""
    view, at, unpacker = memoryview(data), 0, None
    while at < len(view):
        if at + 8 > len(view):
            raise ValueError("a frame is cut off")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE_MAGICS:
            if at + 8 + size > len(view):
                raise ValueError("a frame is cut off")
            if at == 0 and magic == DICTIONARY_MAGIC:
                raw = bytes(view[8 : 8 + size])
                if raw[:4] == struct.pack("<I", ZSTD_MAGIC):
                    raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
            at += 8 + size
        elif magic == ZSTD_MAGIC:
            unpacker = unpacker or zstandard.ZstdDecompressor()
            size = frame_size(view[at:])
            yield unpacker.decompressobj().decompress(view[at : at + size])
            at += size
        else:
            raise ValueError("neither a record nor a skippable frame")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for got in batches:
        for content in got.column("content"):
            rows, held = [], 0
            for raw in read_archive(content.as_py()):
                rows.append(parse(raw))
                held += len(raw)
                if held > 1 << 23:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


def with_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to, revisit): of equal payloads of ``min_bytes`` or more the largest id is the response.

    A null payload is empty, a null id is below all others. Rows that share the
    largest id of their payload are all responses. The payload's SHA-256 and
    length stand for the payload, so large groups meet as one row per task.
    """
    base = pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), F.coalesce(pages[html], F.lit("")).cast("binary").alias("html"))
    marked = base.withColumn("of", F.sha2("html", 256))
    heads = marked.where(F.octet_length("html") >= min_bytes).groupBy("of").agg(F.max("page_id").alias("refers_to"))
    joined = marked.join(heads, "of", "left")
    revisit = F.coalesce(F.col("refers_to") != F.col("page_id"), F.col("page_id").isNull() & F.col("refers_to").isNotNull())
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records: DataFrame, path: str) -> None:
    """Write (page_id, url, html, refers_to, revisit), one archive per partition."""
    frames = records.select("page_id", "url", "html", "refers_to", "revisit").mapInArrow(_archive, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, checked; a faulty one fails the read. A file is one row, so keep archives well below 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("content").mapInArrow(_records, RECORD)


def round_trip(pages: DataFrame, **names: str) -> DataFrame:
    """Write ``pages`` to archives in the work folder, read them back, drop the files.

    One row per row of ``pages``, without the payload: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    write_archives(with_revisits(pages, **names), path)
    back = pin(read_archives(spark, path).drop("payload"))
    remove_path(pages, path)
    return back
