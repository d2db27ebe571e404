"""Landed files: CSV with a validation model, exchange rates and addresses as JSON."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.merge import overwrite_partitions, table_exists
from tidewater.operators.quality import Rule, between, not_null, tag_failures
from tidewater.sources.bronze import read_bronze

# Models of the landed CSV types. Every column is required.
CATALOG = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("available", T.BooleanType()),
    ]
)
LOGISTICS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("estimated_delivery", T.StringType()),
        T.StructField("weight_kg", T.DoubleType()),
    ]
)
CSV_MODELS: Mapping[str, tuple[T.StructType, tuple[Rule, ...]]] = {
    "catalog": (CATALOG, (between("price", low=0, strict_low=True),)),
    "logistics": (LOGISTICS, (between("weight_kg", low=0),)),
}
FILE = "source_file"


def model_rules(file_type: str) -> list[Rule]:
    """Every column filled after coercion, plus the value checks."""
    schema, checks = CSV_MODELS[file_type]
    return [not_null(f.name) for f in schema.fields] + list(checks)


def coerce(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Model columns by name, cast where possible; others are dropped, absent ones are null."""

    def value(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType)
        c = F.col(f.name)
        return (c if isinstance(f.dataType, T.StringType) else F.trim(c).try_cast(f.dataType)).alias(f.name)

    return df.select(*[value(f).alias(f.name) for f in schema.fields], *keep)


def landed_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header) of every CSV file of a folder that has a first line, rows below it or not."""
    lines = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").text(path)
    return (
        lines.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
        .where("start = 0")
        .groupBy("file")
        .agg(F.min_by("value", "line").alias("header"))
    )


def read_landing_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, headers: DataFrame | None = None) -> DataFrame:
    """All CSV files of a folder, columns matched by each file's own header.

    Without a schema every column of every header is kept, as text. Headers are
    read by one distributed job. What reaches the driver is one short row per
    file; files that share a header are read together. ``headers`` are those of
    ``landed_headers`` where the caller has them.
    """
    by_header: dict[str, list[str]] = {}
    for row in (landed_headers(spark, path) if headers is None else headers).collect():
        by_header.setdefault(row["header"], []).append(unquote(row["file"]))  # the column is a URI
    frames = []
    for header, files in sorted(by_header.items()):
        names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")]), [])]
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.schema(text).option("header", True).option("multiLine", True).option("escape", '"').csv(sorted(files))
        rows = rows.withColumn(FILE, F.col("_metadata.file_path"))
        frames.append(coerce(rows, schema, (FILE,)) if schema else rows)
    if not frames:
        fields = schema.fields if schema else []
        return spark.createDataFrame([], T.StructType([*fields, T.StructField(FILE, T.StringType())]))
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), frames)


def file_verdicts(rows: DataFrame, file_type: str, file_col: str = FILE) -> DataFrame:
    """(file, rows, bad_rows, accepted): a file with any failing row is rejected."""
    tagged = tag_failures(rows, model_rules(file_type))
    bad = F.count_if(F.size("failed_rules") > 0)
    return tagged.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows"), bad.alias("bad_rows")).withColumn(
        "accepted", F.col("bad_rows") == 0
    )


def land_csv(spark: SparkSession, landing: str, bronze: str, file_type: str, date: str) -> int:
    """Write accepted files into the day's partition and return how many there were.

    A file with a header and no rows has no failing row, so it is accepted. Files
    of a type without a model are loaded unchecked, as text, with ``checked``
    false; a column of theirs named ``checked`` or ``event_date`` becomes
    ``data_checked`` or ``data_event_date``. A missing or empty folder accepts nothing. Below the day a file has
    its own folder: landing it again replaces it and leaves the day's others.
    """
    folder = f"{landing}/{file_type}"
    if not table_exists(spark, folder):
        return 0
    modelled = file_type in CSV_MODELS
    headers = landed_headers(spark, folder).persist()
    rows = read_landing_csv(spark, folder, CSV_MODELS[file_type][0] if modelled else None, headers).persist()  # for verdicts and the write
    try:
        files, accepted = headers.select(F.col("file").alias(FILE)), rows
        if modelled:
            rejected = file_verdicts(rows, file_type).where("not accepted").select(FILE)
            files, accepted = (df.join(rejected, FILE, "left_anti") for df in (files, rows))
        accepted = accepted.withColumnsRenamed({c: f"data_{c}" for c in accepted.columns if c.lower() in ("checked", "event_date")})
        day = accepted.withColumns({"checked": F.lit(modelled), "event_date": F.lit(date).cast("date")})
        if len(day.columns) > 3:  # else not one file has a column
            overwrite_partitions(day, f"{bronze}/{file_type}", ["event_date", FILE])
        return files.count()
    finally:
        rows.unpersist()
        headers.unpersist()


def read_landed(spark: SparkSession, bronze: str, file_type: str, date: str) -> DataFrame:
    """One landed day of a type with a model; no rows where no file has been accepted yet."""
    ours = [T.StructField("checked", T.BooleanType()), T.StructField("event_date", T.DateType()), T.StructField(FILE, T.StringType())]
    schema = T.StructType([*CSV_MODELS[file_type][0].fields, *ours])
    folder = f"{bronze}/{file_type}"
    return read_bronze(spark, folder, date, schema) if table_exists(spark, folder) else spark.createDataFrame([], schema)


RATES = T.StructType(
    [
        T.StructField("result", T.StringType()),
        T.StructField("base_code", T.StringType()),
        T.StructField("rates", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def explode_rates(snapshots: DataFrame) -> DataFrame:
    """(base, currency, rate) rows of successful exchange-rate snapshots."""
    return snapshots.where(F.col("result") == "success").select(
        F.col("base_code").alias("base"), F.explode("rates").alias("currency", "rate")
    )


def load_rates(spark: SparkSession, path: str) -> DataFrame:
    return explode_rates(spark.read.schema(RATES).option("multiLine", True).json(path))


def postal_digits(c: Column | str) -> Column:
    return F.regexp_replace(c, "[-.]", "")


ADDRESS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("cep", "logradouro", "complemento", "bairro", "localidade", "uf")]
)


def load_addresses(spark: SparkSession, path: str) -> DataFrame:
    """Address rows of landed JSON arrays, postal code reduced to digits."""
    return spark.read.schema(ADDRESS).option("multiLine", True).json(path).withColumn("cep", postal_digits("cep"))
