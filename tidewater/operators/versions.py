"""Replacing tables so that a crash leaves the old rows readable.

Every write goes into a folder of its own and never touches an older one. Which
folders count is said by numbered pointer files below ``_versions``: a pointer
is written beside and moved into place by one rename that fails where its
number is taken. A crash before that rename leaves the table as it was, a
reader resolves one pointer and so sees one state, and of two writers one is
refused. A write may carry a mark (who, number): repeating it is recognised.

A pointer names the folders per unit, which is a partition directory or, in a
table without partitions, the table. Replacing a unit swaps its folders,
appending adds one. The driver holds one short text per unit and write, so
partition by something counted in thousands (days, buckets), not by keys.
Plain Parquet readers see all folders of the table, so read it with ``read_table``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTERS = "_versions"
#: Name of the outermost directory level: one value per write.
WRITE = "tidewater_write"


class ConcurrentWrite(RuntimeError):
    """Another writer has replaced the table in the meantime; read it again and repeat."""


@dataclass(frozen=True)
class Version:
    """One state of a table: folders (write ids) per unit, columns, and the last mark of every writer."""

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    units: Mapping[str, tuple[str, ...]]
    marks: Mapping[str, int] = field(default_factory=dict)

    def folders(self, path: str, keep: Callable[[str], bool] = lambda unit: True) -> list[str]:
        return [f"{path}/{WRITE}={w}/{unit}".rstrip("/") for unit, writes in sorted(self.units.items()) if keep(unit) for w in writes]


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointer_names(spark: SparkSession, path: str) -> list[str]:
    folder, fs = _hadoop(spark, f"{path}/{POINTERS}")
    if not fs.exists(folder):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.endswith(".json"))


def _read_pointer(spark: SparkSession, path: str, name: str) -> Version:
    where, fs = _hadoop(spark, f"{path}/{POINTERS}/{name}")
    stream = fs.open(where)
    try:
        body = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    units = {u: tuple(w) for u, w in body["units"].items()}
    return Version(body["number"], T.StructType.fromJson(body["schema"]), tuple(body["partition_by"]), units, body["marks"])


def current(spark: SparkSession, path: str) -> Version | None:
    """The state readers see, or None where nothing has been published."""
    names = _pointer_names(spark, path)
    return _read_pointer(spark, path, names[-1]) if names else None


def _publish(spark: SparkSession, path: str, version: Version) -> None:
    """Put the pointer in place; the rename is what switches the table."""
    body = {"number": version.number, "schema": version.schema.jsonValue(), "partition_by": list(version.partition_by), "units": {u: list(w) for u, w in version.units.items()}, "marks": dict(version.marks)}
    draft, fs = _hadoop(spark, f"{path}/{POINTERS}/draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(body).encode()))
    finally:
        stream.close()
    target, _ = _hadoop(spark, f"{path}/{POINTERS}/{version.number:010d}.json")
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise ConcurrentWrite(f"{path}: version {version.number} exists") from error
        raise


def seen(version: Version | None, mark: tuple[str, int] | None) -> bool:
    """Whether the write that carries this mark has been published before."""
    return bool(version and mark and version.marks.get(mark[0], -1) >= mark[1])


def _written_units(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition directories of one write."""
    where, fs = _hadoop(spark, folder + "/*" * depth)
    root, _ = _hadoop(spark, folder)
    if not depth:
        return [""]
    found = fs.globStatus(where) if fs.exists(root) else []
    names = ["/".join(str(s.getPath().toString()).rstrip("/").split("/")[-depth:]) for s in found]
    return [n for n in names if all("=" in level for level in n.split("/"))]


def write_version(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    replaces: Callable[[str], bool] = lambda unit: False,
    emptied: Iterable[str] = (),
    keeps_others: bool = True,
    mark: tuple[str, int] | None = None,
    base: Version | None = None,
) -> Version:
    """Write ``df`` into a folder of its own and publish a state that counts it.

    A unit in ``df`` loses its older folders where ``replaces`` says so, else it
    is added to. Units in ``emptied`` lose theirs even if ``df`` has no row for
    them; without ``keeps_others`` all other units go. ``base`` is the state the
    rows were derived from: if another has been published since, nothing changes
    and ConcurrentWrite is raised.
    """
    spark, write = df.sparkSession, uuid.uuid4().hex[:16]
    folder = f"{path}/{WRITE}={write}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(folder)
    units = {} if base is None or not keeps_others else {u: w for u, w in base.units.items() if u not in set(emptied)}
    for unit in _written_units(spark, folder, len(partition_by)):
        before = () if replaces(unit) else units.get(unit, ())
        units[unit] = (*before, write)
    marks = dict(base.marks if base else {}) | (dict([mark]) if mark else {})
    named = {f.name: f for f in base.schema.fields if f.name not in partition_by} if base and keeps_others else {}
    named |= {f.name: f for f in df.schema.fields if f.name not in partition_by}  # older folders read as null in new columns
    schema = T.StructType([*named.values(), *(df.schema[c] for c in partition_by)])
    version = Version(base.number + 1 if base else 1, schema, tuple(partition_by), units, marks)
    _publish(spark, path, version)
    return version


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mark: tuple[str, int] | None = None) -> bool:
    """Replace all rows, columns and partitioning included. False where the mark shows that this has been done."""
    base = current(df.sparkSession, path)
    if seen(base, mark):
        return False
    write_version(df, path, partition_by, keeps_others=False, mark=mark, base=base)
    return True


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], mark: tuple[str, int] | None = None) -> bool:
    """Replace the partitions ``df`` has rows of and leave the others; running a day again changes nothing."""
    base = current(df.sparkSession, path)
    if seen(base, mark):
        return False
    if base and base.partition_by != tuple(partition_by):
        raise ValueError(f"{path} is partitioned by {', '.join(base.partition_by)}")
    write_version(df, path, partition_by, replaces=lambda unit: True, mark=mark, base=base)
    return True


def read_table(spark: SparkSession, path: str, version: Version | None = None, keep: Callable[[str], bool] = lambda unit: True) -> DataFrame:
    """Rows of the current state, or of ``version``; of units that ``keep`` accepts, others are not even listed."""
    version = version or current(spark, path)
    if version is None:
        raise FileNotFoundError(f"{path} has no published version")
    folders = version.folders(path, keep)
    schema = T.StructType([*version.schema.fields, T.StructField(WRITE, T.StringType())])
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*[f"`{c}`" for c in version.schema.names])


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than_seconds: int = 86_400) -> int:
    """Delete folders that none of the last ``keep`` states names, and their pointers; returns the number of folders.

    Young folders stay: they may belong to a write that has not been published yet.
    """
    names = _pointer_names(spark, path)
    kept = [_read_pointer(spark, path, n) for n in names[-keep:]]
    used = {w for v in kept for writes in v.units.values() for w in writes}
    before = spark._jvm.System.currentTimeMillis() - older_than_seconds * 1000
    for name in names[:-keep]:
        where, fs = _hadoop(spark, f"{path}/{POINTERS}/{name}")
        fs.delete(where, False)
    root, fs = _hadoop(spark, path)
    gone = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{WRITE}=") and name.split("=", 1)[1] not in used and status.getModificationTime() <= before:
            gone += bool(fs.delete(status.getPath(), True))
    return gone
