"""Model metrics as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import guarded_ratio
from tidewater.operators.joins import in_parts
from tidewater.operators.ranking import exact_percentile, with_ntile, with_running_totals
from tidewater.session import pin


def ranking_metrics(recommended: DataFrame, relevant: DataFrame, k: int, parts: int | None = None) -> DataFrame:
    """Precision, recall, NDCG and MRR at k in one row.

    ``recommended`` is (user, item, rank from 1), ``relevant`` is (user, item).
    Users without relevant items count as zero in MRR and not at all elsewhere.
    Pairs are met in ``parts`` tasks where given.
    """
    recs = recommended.where(F.col("rank") <= k).select("user", "item", "rank", F.lit(None).cast("int").alias("rel"))
    wanted = relevant.select("user", "item", F.lit(None).cast(recs.schema["rank"].dataType).alias("rank"), F.lit(1).alias("rel"))
    idle = recommended.select("user", F.lit(None).cast(recs.schema["item"].dataType).alias("item"), F.lit(None).cast(recs.schema["rank"].dataType).alias("rank"), F.lit(None).cast("int").alias("rel")).distinct()
    pairs = in_parts(recs.unionByName(wanted).unionByName(idle), parts, "user", "item").groupBy("user", "item").agg(F.min("rank").alias("rank"), F.max("rel").alias("rel"))
    hit = F.col("rel").isNotNull() & F.col("rank").isNotNull()
    gain = F.lit(1.0) / F.log2(F.col("rank") + 1)
    users = pairs.groupBy("user").agg(
        F.count("rel").alias("n_rel"),
        F.count_if(hit).alias("hits"),
        F.coalesce(F.sum(F.when(hit, gain)), F.lit(0.0)).alias("dcg"),
        F.min(F.when(hit, F.col("rank"))).alias("first_hit"),
    )
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n_rel"), F.lit(k)).cast("int")),
        F.lit(0.0),
        lambda total, i: total + F.lit(1.0) / F.log2(i + 1),
    )
    judged = F.col("n_rel") > 0
    return users.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(judged).alias("judged_users"),
        F.coalesce(F.avg(F.when(judged, F.col("hits") / F.lit(k))), F.lit(0.0)).alias("precision_at_k"),
        F.coalesce(F.avg(F.when(judged, F.col("hits") / F.col("n_rel"))), F.lit(0.0)).alias("recall_at_k"),
        F.coalesce(F.avg(F.when(judged, F.col("dcg") / ideal)), F.lit(0.0)).alias("ndcg_at_k"),
        F.coalesce(F.avg(F.coalesce(F.lit(1.0) / F.col("first_hit"), F.lit(0.0))), F.lit(0.0)).alias("mrr_at_k"),
    )


def forecast_errors(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """WAPE and MAPE over non-zero actuals, MAE and RMSE over all rows."""
    a, p = F.col(actual), F.col(predicted)
    miss = F.abs(a - p)
    counted = a != 0
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.when(counted, miss)) / F.sum(F.when(counted, F.abs(a))), F.lit(0.0)).alias("wape"),
        F.avg(miss).alias("mae"),
        F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
        F.coalesce(F.avg(F.when(counted, miss / F.abs(a))), F.lit(0.0)).alias("mape"),
    )


def _score_steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = F.col(label).cast("int") == 1
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1 and ROC AUC in one row.

    AUC is the rank sum over distinct scores, ties counted half, and null unless
    both classes are present.
    """
    steps = with_running_totals(_score_steps(df, label, score), [F.col("score")], {"neg_upto": F.col("neg")})
    flagged = F.col("score") >= threshold
    total = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    won = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0)
    counts = steps.agg(
        total("pos", flagged).alias("tp"),
        total("neg", flagged).alias("fp"),
        total("neg", ~flagged).alias("tn"),
        total("pos", ~flagged).alias("fn"),
        F.sum(won).alias("_won"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    pairs = (tp + fn) * (fp + tn)
    return counts.select(
        "tp",
        "fp",
        "tn",
        "fn",
        guarded_ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        guarded_ratio(tp, tp + fp).alias("precision"),
        guarded_ratio(tp, tp + fn).alias("recall"),
        guarded_ratio(tp * 2.0, tp * 2 + fp + fn).alias("f1"),
        F.when(pairs > 0, F.col("_won") / pairs).alias("roc_auc"),
    )


def best_f1_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """Threshold with the best F1 over all distinct scores; the highest one on ties."""
    steps = pin(_score_steps(df, label, score))  # one row per distinct score, read twice
    positives = steps.agg(F.sum("pos")).scalar()
    swept = with_running_totals(steps, [F.col("score").desc()], {"tp": F.col("pos"), "flagged": F.col("pos") + F.col("neg")})
    f1 = (F.col("tp") * 2.0) / (F.col("flagged") + F.col("positives"))
    best = F.max(F.struct(F.round(f1, 12).alias("f1"), F.col("score").alias("threshold"), "tp", "flagged"))
    return swept.withColumn("positives", positives).agg(best.alias("b")).select("b.threshold", "b.f1", "b.tp", "b.flagged")


def precision_at_top(df: DataFrame, label: str, score: str, p: float = 0.99) -> DataFrame:
    """Precision among rows scoring at or above the given percentile."""
    cut = exact_percentile(df, score, p).scalar()
    flagged = df.withColumn("cut", cut).where(F.col(score) >= F.col("cut"))
    return flagged.agg(
        F.max("cut").alias("cut"),
        F.count(F.lit(1)).alias("flagged"),
        F.count_if(F.col(label).cast("int") == 1).alias("hits"),
    ).withColumn("precision", guarded_ratio("hits", "flagged"))


def gain_by_decile(df: DataFrame, label: str, score: str, key: str, tiles: int = 10) -> DataFrame:
    """Rows and positives per score decile, cumulative gain and the KS distance."""
    ranked = with_ntile(df.select(key, score, label), tiles, [F.col(score).desc(), F.col(key)], "decile")
    positive = F.col(label).cast("int") == 1
    deciles = ranked.groupBy("decile").agg(F.count(F.lit(1)).alias("rows"), F.count_if(positive).alias("positives"))
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    pos = F.sum("positives").over(upto) / F.sum("positives").over(everything)
    neg = F.sum(F.col("rows") - F.col("positives")).over(upto) / F.sum(F.col("rows") - F.col("positives")).over(everything)
    return deciles.select("decile", "rows", "positives", pos.alias("cum_gain"), F.abs(pos - neg).alias("ks"))


def drift_psi(reference: DataFrame, current: DataFrame, column: str, edges: Sequence[float], floor: float = 1e-6) -> DataFrame:
    """Share per bucket in both samples and each bucket's part of the PSI."""

    def bucket(c: Column) -> Column:
        return sum(((c > e).cast("int") for e in edges), F.lit(0))

    both = reference.select(bucket(F.col(column)).alias("bucket"), F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(
        current.select(bucket(F.col(column)).alias("bucket"), F.lit(0).alias("r"), F.lit(1).alias("c"))
    )
    counts = both.groupBy("bucket").agg(F.sum("r").alias("reference_rows"), F.sum("c").alias("current_rows"))
    everything = Window.partitionBy(F.lit(0))
    ref = F.greatest(F.col("reference_rows") / F.sum("reference_rows").over(everything), F.lit(floor))
    cur = F.greatest(F.col("current_rows") / F.sum("current_rows").over(everything), F.lit(floor))
    return counts.select(
        "bucket", "reference_rows", "current_rows", ((cur - ref) * F.log(cur / ref)).alias("psi")
    )
