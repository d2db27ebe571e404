"""Document fingerprints as threshold-scaled sketches, in DataFrame functions.

A sketch keeps every shingle hash in the lowest 1 / SCALE of all hash values,
so sketches of any documents can be merged by union, and the share of one that
another holds estimates containment however unequal the documents are. Where
no hash is that low the smallest one is kept, so no text with a word has an
empty sketch; merging keeps that rule: where any hash of the union is low,
the others go.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import BLANK, BLANKS, row_key, texts
from tidewater.session import pin

WORDS = 5
SCALE = 8
#: Hashes below this are kept: the lowest 1 / SCALE of signed 64-bit numbers.
BELOW = -(2**63) + 2**64 // SCALE


def with_sketch(df: DataFrame, text_col: str, name: str, words: int = WORDS) -> DataFrame:
    """``df`` with ``name``: the sorted distinct kept hashes of the text's shingles of ``words`` words.

    Fewer words are one shingle, none gives an empty sketch. Each step is a
    column that the next one names more than once, so that Spark computes it
    once and not again inside every lambda.
    """
    w, h, s, k = (f"__{name}_{x}" for x in "whsk")
    trimmed = F.btrim(F.lower(text_col), F.lit(BLANKS))
    df = df.withColumn(w, F.split(trimmed, BLANK + "+"))
    df = df.withColumn(h, F.when((F.size(w) == 1) & (F.col(w)[0] == ""), F.array().cast("array<bigint>")).otherwise(F.transform(w, lambda x: F.xxhash64(x))))

    def shingle(i: Column) -> Column:
        return F.xxhash64(*[F.col(h)[i + j] for j in range(words)])

    many = F.transform(F.sequence(F.lit(0), F.size(h) - words), shingle)
    df = df.withColumn(s, F.when(F.size(h) >= words, many).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.col(h)))
    df = df.withColumn(k, F.array_sort(F.array_distinct(F.filter(s, lambda x: x < F.lit(BELOW)))))
    kept = F.when((F.size(k) == 0) & (F.size(s) > 0), F.array(F.array_min(s))).otherwise(F.col(k))
    return df.withColumn(name, kept).drop(w, h, s, k)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts taken as one set of shingles."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda x: x < F.lit(BELOW))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of either text that are in both; two empty sketches are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; an empty sketch is contained in all."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def next_keys(rows: DataFrame) -> DataFrame:
    """(key, half, next_key) from (key, id, half): the key that follows by id, then key; after the last the first.

    Null ids come last. The rows are range-partitioned, so only what lies at
    the ends of partitions is looked at across them, one row per partition.
    """
    order = [F.asc_nulls_last("id"), F.asc("key")]
    ranged = pin(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(*order)
    by_part, everything = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = ranged.groupBy("part").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("head")).select("part", F.col("head.key").alias("head"))
    after = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(everything)).alias("after"))
    # one row per shuffle partition at most
    led = ranged.withColumn("led", F.lead("key").over(inside)).join(F.broadcast(after), "part")
    return led.select("key", "half", F.coalesce("led", "after").alias("next_key"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited, sketch, edited_sketch, next_sketch.

    ``edited`` is the text with its last floor(n_chars / 2) code points replaced
    by the first as many (or all) of the next document by id. A null text is
    empty. Null ids come last; rows with the same id follow each other by the
    digest of their text, and rows equal in both take one place in that order
    and are returned as often as they came. A single document is its own next.
    An empty table gives no rows.
    """
    base = texts(docs, id_col, text_col)
    keyed = base.select(row_key(F.col("id"), F.col("text")).alias("key"), "id", "text").repartition("key")
    places = base.groupBy(row_key(F.col("id"), F.col("text")).alias("key"), "id").agg(F.floor(F.max(F.char_length("text")) / 2).cast("int").alias("half"))
    follow = next_keys(places)
    # both sides of the second join read the one shuffle of the texts
    once = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("key", "id"))).where("nth = 1")
    given = once.join(follow.select(F.col("key").alias("of"), "half", "next_key"), F.col("key") == F.col("next_key"))
    given = given.select("of", F.col("text").alias("next_text"), F.expr("substring(text, 1, half)").alias("tail"))
    given = with_sketch(given, "next_text", "next_sketch").select("of", "tail", "next_sketch")
    met = keyed.join(given, F.col("key") == F.col("of")).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = met.withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"), F.col("tail"))).select("id", "n_chars", "text", "edited", "next_sketch")
    return reduce(lambda df, c: with_sketch(df, *c), [("text", "sketch"), ("edited", "edited_sketch")], edited).drop("text")
