"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken ``target / source size`` times. The
whole part is certain; the rest is a probability that is rounded dependently:
two documents trade words until one of them is taken or left for certain, and
the other goes on with what remains. Which of the two gains is drawn so that
every probability keeps its mean, and words are only moved, so a source keeps
its sum at every step. Documents meet in small blocks, the one that each block
leaves open goes on to a block of the next level, until one document per source
is left, which gives as many of its first words as its share says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import NOT_BLANK, row_key, texts, with_text, word_count
from tidewater.session import pin

#: Documents in a block of the reduction tree, on average.
BLOCK = 128
BUDGET, CAP, SEED = 1.5, 2.0, 20240131
#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
ITEM = "struct<key:string,size:double,p:double,u:double>"
DONE = "array<struct<key:string,p:double>>"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Targets share ``budget`` times all sizes by weight. A target above ``cap``
    times its source's size stops there and the excess is shared again; what
    that ends in is one level for all: target = min(cap * size, level * weight).
    The level follows from the sources in order of cap / weight. One row per
    source, so the windows have no partition.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = totals.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).alias("w")).withColumn("cap", cap * F.col("source_size"))
    up = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped_before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("w").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (budget * F.sum("source_size").over(everything) - capped_before) / open_weight
    # the first source whose own cap is not below the level sets the level for itself and all after it
    found = weighed.withColumn("level", level)
    fits = F.when(F.col("cap") >= F.col("level") * F.col("w"), F.struct((F.col("cap") / F.col("w")).alias("at"), "level"))
    return found.withColumn("at", F.min(fits).over(everything)).select(
        "source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least("cap", F.coalesce(F.col("at.level"), F.lit(float("inf"))) * F.col("w"))).alias("target")
    )


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2**53))


def _trade(state: Column, x: Column) -> Column:
    """One pivotal step: the open document of ``state`` and the next document trade words."""
    c = state["open"]
    gain = F.least((1 - c["p"]) * c["size"], x["p"] * x["size"])  # c up, x down
    loss = F.least(c["p"] * c["size"], (1 - x["p"]) * x["size"])  # c down, x up
    c_up = x["u"] * (gain + loss) < loss

    def settled(who: Column, p: float) -> Column:
        return F.struct(who["key"].alias("key"), F.lit(p).alias("p"))

    def still(who: Column, p: Column) -> Column:
        inside = F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
        return F.struct(who["key"].alias("key"), who["size"].alias("size"), inside.alias("p"), who["u"].alias("u"))

    def moved(first: Column, p_first: float, other: Column, p_other: Column) -> Column:
        return F.struct(F.concat(state["done"], F.array(settled(first, p_first))).alias("done"), still(other, p_other).alias("open"))

    up = F.when((1 - c["p"]) * c["size"] <= x["p"] * x["size"], moved(c, 1.0, x, x["p"] - gain / x["size"])).otherwise(moved(x, 0.0, c, c["p"] + gain / c["size"]))
    down = F.when(c["p"] * c["size"] <= (1 - x["p"]) * x["size"], moved(c, 0.0, x, x["p"] + loss / x["size"])).otherwise(moved(x, 1.0, c, c["p"] - loss / c["size"]))
    first = F.struct(state["done"].alias("done"), x.alias("open"))
    return F.when(c.isNull(), first).when(c_up, up).otherwise(down)


def pivotal(items: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(key, p) for every row of ``items`` (source, key, size > 0, 0 < p < 1): 0 or 1, but for one row per source."""
    level, settled, todo = 0, [], items
    while True:
        counted = todo.groupBy("source").agg(F.count("*").alias("n"))
        most = counted.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        blocks = counted.select(F.col("source").alias("of"), F.ceil(F.col("n") / block).alias("blocks"))
        item = F.struct("key", "size", "p", _uniform(F.lit(seed), F.lit(level), F.col("key")).alias("u"))
        placed = todo.join(blocks, F.col("source").eqNullSafe(F.col("of"))).select("source", F.pmod(F.xxhash64(F.lit(seed), F.lit(-level - 1), "key"), F.col("blocks")).alias("block"), F.xxhash64("key", F.lit(level)).alias("turn"), item.alias("item"))
        start = F.struct(F.array().cast(DONE).alias("done"), F.lit(None).cast(ITEM).alias("open"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", F.col("item")))), lambda t: t["item"])
        rounded = placed.groupBy("source", "block").agg(ordered.alias("items")).select("source", F.aggregate("items", start, _trade).alias("end"))
        rounded = pin(rounded)
        settled.append(rounded.select(F.inline("end.done")))
        left = rounded.select("source", "end.open.*").drop("u")
        certain = (F.col("p") <= 1e-12) | (F.col("p") >= 1 - 1e-12)
        settled.append(left.where(certain).select("key", F.round("p").alias("p")))
        todo, level = left.where(~certain), level + 1
    out = todo.select("key", "p")
    for part in settled:
        out = out.unionByName(part)
    return out


def mix_key(id_col: Column, text: Column, source: Column) -> Column:
    """What only rows share that are equal in id, text and source."""
    return F.concat_ws(":", row_key(id_col, text), F.md5(F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: key, nth, doc_id, source, size, source_size, target, copies, part, taken.

    ``copies`` is how often the whole document is taken and ``part`` the number
    of its first words taken beside that, not 0 for one document of a source
    at most; ``taken`` is the sum in words. ``key`` is what equal rows share, ``nth`` tells them apart.
    Sources add up to their targets within a word. A null text has size 0 and
    gives nothing, a null source is a source, null ids are ordinary. Equal rows
    (id, text, source) are told apart by number; which of them is taken more
    often is immaterial. Same input and seed, same result. An empty table gives
    no rows.
    """
    base = texts(docs, id_col, text_col, source=docs[source_col])
    sized = base.select("id", "source", mix_key(F.col("id"), F.col("text"), F.col("source")).alias("same"), word_count(F.col("text")).alias("size"))
    # equal rows are numbered, so that they round apart
    groups = pin(sized.groupBy("same", "id", "source", "size").agg(F.count("*").alias("rows")))
    each = groups.select("*", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("nth"))
    keyed = each.select("same", "nth", F.concat_ws(":", "same", F.col("nth").cast("string")).alias("key"), "id", "source", "size")
    targets = pin(source_targets(keyed, weights, budget, cap)).withColumnRenamed("source", "of")
    shared = keyed.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shared = shared.withColumn("times", times).withColumn("whole", F.floor(F.col("times") + 1e-12)).withColumn("p", F.greatest(F.col("times") - F.col("whole"), F.lit(0.0)))
    open_ = (F.col("p") > 1e-12) & (F.col("size") > 0)
    rounded = pivotal(shared.where(open_).select("source", "key", F.col("size").cast("double").alias("size"), "p"), seed).withColumnRenamed("p", "bit")
    done = shared.drop("p").join(rounded, "key", "left").withColumn("bit", F.coalesce("bit", F.lit(0.0)))
    full = F.col("bit") >= 1 - 1e-12
    copies = (F.col("whole") + F.when(full, 1).otherwise(0)).cast("int")
    part = F.when(full, 0).otherwise(F.round(F.col("bit") * F.col("size"))).cast("long")
    return done.select(F.col("same").alias("key"), "nth", F.col("id").alias("doc_id"), "source", "size", "source_size", "target", copies.alias("copies"), part.alias("part")).withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + NOT_BLANK + "+"), F.lit(0)), F.lit(1), n.cast("int")), "")


def taken_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them; one row per source at most with its first words only."""
    amounts = mix(docs, **options).groupBy("key").agg(F.sum("copies").cast("int").alias("copies"), F.sum("part").alias("part"))
    text = F.coalesce(docs["text"], F.lit(""))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), mix_key(docs["doc_id"].cast("long"), text, docs["source"]).alias("key"))
    # equal rows were added up, so one of them stands for all
    met = packed.join(amounts.where("copies > 0 OR part > 0"), "key").dropDuplicates(["key"])
    whole = F.array_repeat(F.lit(-1).cast("long"), F.col("copies"))
    each = met.select("row", F.explode(F.when(F.col("part") > 0, F.concat(whole, F.array("part"))).otherwise(whole)).alias("words"))
    cut = F.when(F.col("words") < 0, F.col("row.text")).otherwise(first_words(F.col("row.text"), F.col("words")))
    return with_text(each, docs.columns, cut)
