"""Allow or block addresses: written rules first, mined associations of address tokens for the rest.

What a written rule judges is a labelled address. FP-growth mines the token
combinations of the labelled ones; a combination becomes a rule where its
support and its confidence for one verdict are high enough and no part of it
says the same with at least that confidence. The mined rules are an inverted
index by their rarest token: an address meets only the rules whose rarest token
it has, and is held against the whole combination.

Every frequent token counts, yet few enter FP-growth. Tokens that the labelled
addresses have only together are one item, which an address has if it has any of
them: the rules with one of them differ in nothing else. A token that only
one verdict has is a rule by itself; with more tokens it would be no surer and
rarer. The verdicts are those of all combinations of all tokens.

Everything runs on distinct token sets with their numbers, so that an address or
a host with a third of all rows is one row before any shuffle by token.
Null addresses, and those without ``://``, have no host, path or tokens: no
rule fits and they are allowed. Repeated rows and ids give a row each. Without
labelled addresses nothing is mined and the rest is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower
from tidewater.session import pin

ALLOW, BLOCK = "allow", "block"
#: A combination must be in this share of the labelled addresses, and in this many.
MIN_SUPPORT = 0.005
MIN_COUNT = 5
#: Share of the addresses with the combination that have the verdict.
MIN_CONFIDENCE = 0.9
#: Tokens of a labelled address that enter combinations, those whose share of blocked
#: addresses is furthest from the overall one; None: every frequent token.
MAX_ITEMS = None
#: Token sets up to which their verdicts are broadcast; beyond, the join is a shuffle.
BROADCAST_SETS = 50_000
_COPIES = 10_000


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end, A-Z in lower case; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of an address, in order; runs of digits count as one zero.

    s: scheme, h1: h2: ... host labels from the right, h: the leftmost one,
    n: their number, w: words of the host, p1: p2: ... path segments,
    e: extension, q: names in the query, f: a fragment.
    """
    plain = F.regexp_replace(ascii_lower(url), "[0-9]+", "0")
    rest, host, path = _rest(plain), host_of(plain), path_of(plain)
    labels = F.split(host, r"\.", -1)
    segments = F.filter(F.split(path, "/", -1), lambda x: x != "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    extension = F.regexp_extract(path, r"\.([a-z0-9]+)$", 1)

    def named(prefix: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.concat(F.lit(prefix + ":"), x))

    def numbered(prefix: str, values: Column) -> Column:
        return F.transform(values, lambda x, i: F.concat(F.lit(prefix), (i + 1).cast("string"), F.lit(":"), x))

    none = F.array().cast("array<string>")
    found = F.concat(
        F.array(F.concat(F.lit("s:"), F.substring_index(plain, "://", 1)), F.concat(F.lit("h:"), labels[0]), F.concat(F.lit("n:"), F.size(labels).cast("string"))),
        numbered("h", F.reverse(labels)),
        named("w", F.filter(F.split(host, r"[.-]", -1), lambda x: x != "")),
        numbered("p", segments),
        named("e", F.when(extension != "", F.array(extension)).otherwise(none)),
        named("q", F.filter(F.transform(F.split(query, "&", -1), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")),
        F.when(F.contains(rest, F.lit("#")), F.array(F.lit("f:"))).otherwise(none),
    )
    return F.when(F.instr(plain, "://") > 0, F.array_sort(F.array_distinct(found))).otherwise(none)


def written_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits; the longer host goes first among equals.

    A rule fits its host and the subdomains of it where the path starts with the rule's.
    """
    out = None
    for verdict, at, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        value = F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def _items_of(held: DataFrame) -> DataFrame:
    """(token, item, all, bad) from ``held`` (items, verdict, n): tokens that are always found together are one item.

    Together means the same rows, by 128 bits of their hashes. all: addresses with the item, bad: blocked ones.
    """
    n, row = F.col("n"), [F.array_join("items", "\n"), F.col("verdict")]
    marks = held.select(F.explode("items").alias("token"), "verdict", "n", F.xxhash64(*row).alias("one"), F.xxhash64(F.lit("2"), *row).alias("two"))
    seen = marks.groupBy("token").agg(F.sum(n).alias("all"), F.sum(F.when(F.col("verdict") == BLOCK, n).otherwise(0)).alias("bad"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"))
    joint = seen.groupBy("one", "two", "all", "bad").agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"))
    return joint.select(F.explode("tokens").alias("token"), "item", "all", "bad")


def _as_items(sets: DataFrame, items: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` and the items of ``sets`` (by, items: tokens); without an item no row."""
    met = sets.select(*by, F.explode("items").alias("token")).join(items.select("token", "item"), "token")
    return met.groupBy(*by).agg(F.array_sort(F.collect_set("item")).alias("items"))


def mine(sets: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_items: int | None = MAX_ITEMS) -> tuple[DataFrame, DataFrame]:
    """Mined rules (items, verdict, confidence, support) from ``sets`` (items, verdict, n): n addresses with these tokens.

    The second frame has the item that stands for each token (token, item).
    """
    sets = pin(sets)
    total, blocked = sets.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("verdict") == BLOCK, F.col("n"))), F.lit(0))).first()
    spark = sets.sparkSession
    if total == 0:
        return spark.createDataFrame([], "items array<string>, verdict string, confidence double, support double"), spark.createDataFrame([], "token string, item string")
    least = min(max(min_support, MIN_COUNT / total), 1.0)
    single = sets.select(F.explode("items").alias("item"), "verdict", "n").groupBy("item")
    single = single.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("verdict") == BLOCK, F.col("n")).otherwise(0)).alias("bad"))
    # Telling: the share of blocked addresses against the overall share, as whole numbers over one denominator.
    telling = F.abs(F.col("bad") * F.lit(total).cast("double") - F.col("all") * F.lit(blocked).cast("double")) / F.col("all")
    single = single.where(F.col("all") >= F.lit(least * total)).select("item", telling.alias("telling"))
    per_set = sets.withColumn("key", F.array_join("items", "\n"))
    picked = per_set.select("key", F.explode("items").alias("item")).distinct().join(single, "item")
    picked = picked.groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("telling")).alias("t"), "item"))).alias("s"))
    picked = picked.select("key", (F.col("s") if max_items is None else F.slice("s", 1, max_items))["item"].alias("items"))
    held = per_set.drop("items").join(picked, "key", "left").select(F.coalesce("items", F.array().cast("array<string>")).alias("items"), "verdict", "n")
    held = pin(held.groupBy("items", "verdict").agg(F.sum("n").alias("n")))
    items = pin(_items_of(held))
    pure = (F.col("bad") == 0) | (F.col("bad") == F.col("all"))
    alone = items.where(pure & (F.col("token") == F.col("item")) & (F.col("all") >= F.lit(least * total)))
    alone = alone.select(F.array("item").alias("items"), F.when(F.col("bad") == 0, ALLOW).otherwise(BLOCK).alias("verdict"), F.lit(1.0).alias("confidence"), (F.col("all") / F.lit(total)).alias("support"))
    keyed = held.withColumn("key", F.array_join("items", "\n"))
    mixed = _as_items(keyed, items.where(~pure), ["key", "verdict"])
    trimmed = keyed.drop("items").join(mixed, ["key", "verdict"], "left").select(F.coalesce("items", F.array().cast("array<string>")).alias("items"), "verdict", "n")
    trimmed = trimmed.groupBy("items", "verdict").agg(F.sum("n").alias("n"))
    # One row per address again, dealt out in portions so that a frequent set is not one task.
    portion = F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(_COPIES))).alias("at")
    rows = trimmed.select("items", "verdict", "n", portion).repartition(sets.sparkSession.sparkContext.defaultParallelism)
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("n") - F.col("at"), F.lit(_COPIES)).cast("int")))
    rows = rows.select(F.concat("items", F.array(F.concat(F.lit("="), F.col("verdict")))).alias("items"), copies.alias("copy")).drop("copy")
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(rows)
    verdict = F.col("consequent")[0]
    rules = model.associationRules.where(verdict.startswith("="))
    rules = rules.select(F.array_sort("antecedent").alias("items"), F.substring(verdict, 2, 100).alias("verdict"), "confidence", "support")
    rules = pin(rules.unionByName(alone))
    # A rule is left out where it says what the rule of one item less says at least as surely.
    less = rules.select("verdict", "confidence", F.array_join("items", "\n").alias("part")).withColumnRenamed("confidence", "shorter")
    parts = rules.where(F.size("items") > 1).select("items", "verdict", "confidence", F.explode("items").alias("left"))
    parts = parts.withColumn("part", F.array_join(F.array_remove("items", F.col("left")), "\n"))
    idle = parts.join(less, ["part", "verdict"]).where(F.col("shorter") >= F.col("confidence")).select("items", "verdict").distinct()
    return pin(rules.join(idle, ["items", "verdict"], "left_anti").select("items", "verdict", "confidence", "support")), items.select("token", "item")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, verdict) of the ``sets`` (key, items) that a rule fits: the surest rule, then the most frequent, then the shortest."""
    items = rules.select(F.explode("items").alias("item"))
    rarity = items.groupBy("item").agg(F.count(F.lit(1)).alias("in_rules"))
    rarest = rules.select("items", F.explode("items").alias("item")).distinct().join(rarity, "item")
    rarest = rarest.groupBy("items").agg(F.min(F.struct("in_rules", "item")).alias("r")).select("items", F.col("r.item").alias("item"))
    index = rules.join(rarest, "items").select("item", F.col("items").alias("needs"), "verdict", "confidence", "support")
    met = sets.select("key", "items", F.explode("items").alias("item")).join(index, "item")
    met = met.where(F.size(F.array_except("needs", "items")) == 0)
    best = F.max(F.struct("confidence", "support", (-F.size("needs")).alias("short"), "verdict"))
    return met.groupBy("key").agg(best.alias("b")).select("key", F.col("b.verdict").alias("verdict"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", **options: float) -> DataFrame:
    """(id, host, path, rule, verdict) of every address: a written rule's verdict, else that of the mined rules, else allow."""
    url = pages[url_col]
    known = pages.select(pages[id_col].alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(F.coalesce(url, F.lit(""))).alias("items"))
    known = known.withColumn("w", written_rule(F.col("host"), F.col("path"), rules))
    grouped = pin(known.groupBy("items", F.col("w.verdict").alias("verdict")).agg(F.count(F.lit(1)).alias("n")))
    mined, items = mine(grouped.where("verdict is not null"), **options)
    key = F.array_join("items", "\n")
    open_sets = grouped.where("verdict is null").select(key.alias("key"), "items")
    found = pin(match(_as_items(open_sets, items, ["key"]), mined)).withColumnRenamed("verdict", "mined")
    if found.count() <= BROADCAST_SETS:
        found = F.broadcast(found)
    out = known.withColumn("key", F.when(F.col("w").isNull(), key)).join(found, "key", "left")
    return out.select("id", "host", "path", "w.rule", F.coalesce("w.verdict", "mined", F.lit(ALLOW)).alias("verdict"))
