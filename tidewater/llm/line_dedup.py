"""Lines that other documents hold already, by levelled sorted runs of line hashes.

Documents are taken in batches of rising id. A run holds the lines seen so far,
one row each: the line's hash and the smallest id that holds it, bucketed and
sorted by the hash. A batch is anti-joined with every run (a merge join: the
runs are neither shuffled nor written again), and what is new becomes a run of
its own. ``FANOUT`` runs of a level are compacted to one run of the next, so
there are few runs, and every line is rewritten once per level only. Since ids
rise from batch to batch, the id that a run holds for a line is final.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BLANKS, ascii_lower, remove_path, row_key, texts
from tidewater.session import pin, work_dir

BATCHES = 4
FANOUT = 4
MIN_CHARS = 10
#: Stands for a null id, so that it comes after all others.
LAST_ID = 2**63 - 1


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """The runs of one index, as bucketed tables below a work folder."""

    def __init__(self, like: DataFrame, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = like.sparkSession, buckets, fanout
        self.root, self.tag = work_dir(self.spark, "line-runs"), uuid.uuid4().hex[:12]
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def _write(self, lines: DataFrame) -> str:
        name = f"line_run_{self.tag}_{len(self.paths)}"
        self.paths[name] = f"{self.root}/{name}"
        spread = lines.repartition(self.buckets, "line")
        spread.write.bucketBy(self.buckets, "line").sortBy("line").option("path", self.paths[name]).saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def files(self) -> list[DataFrame]:
        """The runs without their buckets: a join then shuffles both sides, and may split a line that a third of all documents hold."""
        return [self.spark.read.schema("line binary, owner long").parquet(self.paths[name]) for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (line, owner); lines that a run holds already are left out."""
        firsts = lines.groupBy("line").agg(F.min("owner").alias("owner"))
        fresh = reduce(lambda new, run: new.join(run.select("line").hint("merge"), "line", "left_anti"), self.runs(), firsts)
        self.levels[0].append(self._write(fresh))
        for k in range(len(self.levels)):
            if len(self.levels[k]) < self.fanout:
                break
            full, self.levels[k] = self.levels[k], []
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(self._write(reduce(DataFrame.unionByName, map(self.spark.table, full))))
            self._forget(full)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self, like: DataFrame) -> None:
        self._forget([name for level in self.levels for name in level])
        remove_path(like, self.root)


def repeated_lines(base: DataFrame, batches: int, min_chars: int) -> DataFrame:
    """(key, drop): for each row key the places of the lines that a smaller id holds."""
    lined = base.select("key", "id", split_lines(F.col("text")).alias("lines"))
    keyed = lined.select("key", F.coalesce("id", F.lit(LAST_ID)).alias("id"), F.posexplode(F.transform("lines", line_key)).alias("at", "line"))
    hashed = keyed.where(F.char_length("line") >= min_chars).select("key", "id", "at", F.unhex(F.md5("line")).alias("line"))

    spark = base.sparkSession
    shares = [i / batches for i in range(1, batches)]
    cuts = (base.agg(F.percentile_approx("id", shares, 1000).alias("cuts")).first().cuts or []) if shares else []
    batch = reduce(lambda n, c: n + (F.col("id") > c).cast("int"), sorted(set(cuts)), F.lit(0))
    path = work_dir(spark, "lines")
    hashed.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    schema = "key string, id long, at int, line binary, batch int"
    stored = spark.read.schema(schema).parquet(path)

    index = LineRuns(base, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for b in range(len(set(cuts)) + 1):
        index.add(stored.where(F.col("batch") == b).select("line", F.col("id").alias("owner")))
    hits = [stored.join(run, "line").where("owner < id").select("key", "at") for run in index.files()]
    drops = pin(reduce(DataFrame.unionByName, hits).groupBy("key").agg(F.collect_set("at").alias("drop")))
    index.close(base)
    remove_path(base, path)
    return drops


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every row of ``docs`` as (row, kept_text, n_lines, n_dropped); ``row`` holds its columns.

    Texts are split at line feeds; a null or empty text is one empty line. A
    line's key is the line without blanks at both ends, A-Z in lower case. A
    key of ``min_chars`` code points or more loses its lines in all documents
    but the one with the smallest id that holds it, where every one of them
    stays. A null id comes after all other ids. Rows with the same id are one
    document and don't take lines from each other; identical rows are treated
    alike. An empty table gives no rows. Columns of any name are carried in
    ``row`` and can't clash.
    """
    packed = texts(docs, id_col, text_col, row=F.struct(*[docs[c] for c in docs.columns]))
    keyed = packed.withColumn("key", row_key(F.col("id"), F.col("text")))
    drops = repeated_lines(keyed.select("key", "id", "text"), batches, min_chars)
    joined = keyed.join(drops, "key", "left").select("row", split_lines(F.col("text")).alias("lines"), F.coalesce("drop", F.array().cast("array<int>")).alias("drop"))
    # the places that stay: a set difference, so linear in the number of lines
    placed = joined.select("row", "lines", F.size("lines").alias("n"), F.size("drop").alias("dropped"), F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop").alias("keep"))
    # lines is named twice, so that it isn't split anew for every place
    kept = F.when(F.size("lines") == F.size("keep"), F.col("lines")).otherwise(F.transform("keep", lambda i: F.col("lines")[i]))
    return placed.select("row", F.array_join(kept, "\n").alias("kept_text"), F.col("n").cast("long").alias("n_lines"), F.col("dropped").cast("long").alias("n_dropped"))
