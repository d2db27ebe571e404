"""From raw documents to token ids: quality, repeated lines, near-duplicates, mixing, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, line_dedup, mixing, quality, simhash
from tidewater.llm.common import with_text
from tidewater.session import work_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A classifier and drawn copies can't be said in SQL.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more; it learns from the labels of those given."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    rest = [docs[c] for c in docs.columns if c != "text"]
    scored = quality.score_quality(docs, model, keep_text=True, row=F.struct(*rest, docs["text"].isNull().alias("_no_text")))  # a task gets the text once
    text = F.when(~F.col("row._no_text"), F.col("text")).alias("text")
    return scored.where("predicted = 1").select(*[text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that one with a smaller id holds; a null text stays null."""
    done = line_dedup.drop_repeated_lines(docs)
    return with_text(done, docs.columns, F.when(F.col("row.text").isNotNull(), F.col("kept_text")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.taken_rows(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True, lang=docs["lang"], source=docs["source"])
    return coded.select(F.col("id").alias("doc_id"), "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
