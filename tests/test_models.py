import math

import pytest
from pyspark.sql import functions as F

from tidewater.operators import evaluation as EV
from tidewater.plans import models as ML


def lists(spark, recs, rel):
    a = [(u, i, r + 1) for u, items in recs.items() for r, i in enumerate(items)]
    b = [(u, i) for u, items in rel.items() for i in items]
    return spark.createDataFrame(a, "user string, item long, rank int"), spark.createDataFrame(b, "user string, item long")


def test_ranking_metrics_known_answers(spark):
    row = EV.ranking_metrics(*lists(spark, {"u": [1, 2, 3, 4, 5]}, {"u": [1, 2, 3]}), 3).first()
    assert row["precision_at_k"] == 1.0 and row["recall_at_k"] == 1.0
    row = EV.ranking_metrics(*lists(spark, {"u": [1, 2, 99, 100, 101]}, {"u": [1, 2, 3, 4, 5]}), 5).first()
    assert row["recall_at_k"] == pytest.approx(0.4)
    assert EV.ranking_metrics(*lists(spark, {"u": [5, 2, 3]}, {"u": [5]}), 5).first()["mrr_at_k"] == 1.0
    assert EV.ranking_metrics(*lists(spark, {"u": [1, 2]}, {"u": [1, 2, 3]}), 2).first()["ndcg_at_k"] == pytest.approx(1.0)


def test_users_without_relevant_items(spark):
    row = EV.ranking_metrics(*lists(spark, {"a": [1], "b": [7]}, {"a": [1]}), 5).first()
    assert (row["users"], row["judged_users"], row["mrr_at_k"], row["recall_at_k"]) == (2, 1, 0.5, 1.0)
    assert row["precision_at_k"] == pytest.approx(0.2)


def test_forecast_errors(spark):
    equal = spark.createDataFrame([(10.0, 10.0), (20.0, 20.0)], "a double, p double")
    zero = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "a double, p double")
    assert EV.forecast_errors(equal, "a", "p").first()["wape"] == 0.0
    row = EV.forecast_errors(zero, "a", "p").first()
    assert (row["wape"], row["mape"], row["mae"]) == (0.0, 0.0, 1.5)


def test_classification_by_hand(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    m = EV.classification_metrics(df, "y", "s").first()
    assert (m["tp"], m["fp"], m["tn"], m["fn"]) == (2, 1, 2, 1)
    pairs = [(1.0 if p > n else 0.5 if p == n else 0.0) for y, p in rows if y for z, n in rows if not z]
    assert m["roc_auc"] == pytest.approx(sum(pairs) / len(pairs))
    assert EV.classification_metrics(df.where("y = 1"), "y", "s").first()["roc_auc"] is None
    best = EV.best_f1_threshold(df, "y", "s").first()
    # At 0.2 five rows are flagged with all three positives: 2 * 3 / (5 + 3); at 0.8 it is 2 * 2 / (3 + 3).
    assert best["threshold"] == 0.2 and best["f1"] == pytest.approx(6 / 8)


def test_drift_of_equal_samples_is_zero(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    assert EV.drift_psi(df, df, "x", (25, 50, 75)).agg(F.sum("psi")).first()[0] == 0.0


def test_item_index_starts_at_one(spark):
    df = spark.createDataFrame([(i,) for i in (10, 20, 30, 20, 40)], "item long")
    assert sorted(map(tuple, ML.item_index(df, "item").collect())) == [(10, 1), (20, 2), (30, 3), (40, 4)]


def test_als_prefers_own_taste_and_falls_back(spark):
    taste = [(u, i) for u in range(1, 21) for i in range(1, 11) if (u % 2) == (i % 2) and (u * i) % 7]
    triples = spark.createDataFrame(taste, "u int, i int").withColumn("w", F.lit(2.0))
    model = ML.fit_als(triples, "u", "i", F.col("w"), rank=4, iterations=8)
    users = spark.createDataFrame([(1,), (2,), (99,)], "u int")
    recs = ML.recommend(model, users, "u", "i", 3)
    assert recs.where("u % 2 <> i % 2").count() == 0 and recs.groupBy("u").count().where("count = 3").count() == 2
    unseen = ML.recommend(model, users, "u", "i", 3, seen=triples)
    assert unseen.join(triples, ["u", "i"], "left_semi").count() == 0
    filled = ML.with_fallback(users, recs, ML.popular_items(triples, "i", "w", 3), "u", "i")
    assert filled.where("u = 99 and fallback").count() == 3 and filled.where("u = 1 and fallback").count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    x = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0
    noise = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 1000.0
    return spark.range(800).select("id", x.alias("x"), noise.alias("noise"), (x + noise * 0.2 > 0.85).cast("int").alias("y")).cache()


def test_boosted_trees(spark, labelled):
    model, out = ML.fit_boosted(labelled, ("x", "noise"), "y", "id", trees=10)
    test = EV.classification_metrics(out.where("is_test"), "y", "probability").first()
    assert test["roc_auc"] > 0.95
    assert out.select("risk").distinct().count() >= 2
    assert out.count() == 800 and 0.15 < out.where("is_test").count() / 800 < 0.35
    weight = labelled.withColumn("w", ML.class_weight(labelled, "y")).where("y = 1").first()["w"]
    positives = labelled.where("y = 1").count()
    assert weight == pytest.approx(max(1.0, (800 - positives) / positives))
    curve = ML.calibrate(out, "y").transform(out).select("calibrated").agg(F.min("calibrated"), F.max("calibrated")).first()
    assert 0.0 <= curve[0] <= curve[1] <= 1.0


def test_search(spark, labelled):
    found = ML.search(labelled, ("x",), "y", depths=(1, 2), rates=(0.1,), trees=3)
    assert len(found.validationMetrics) == 2 and all(not math.isnan(m) for m in found.validationMetrics)


def test_anomalies(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 3, 1000.0).otherwise(F.col("id") / 100.0).alias("a"), F.lit(1.0).alias("b"))
    flagged = ML.anomaly_scores(df, ("a", "b"), 0.03).where("is_anomaly").select("id").collect()
    assert sorted(r["id"] for r in flagged) == [0, 1, 2]


def test_isolation_forest(spark):
    from tidewater.plans.isolation import expected_path, forest, isolation_scores

    x = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1000)) / 1000.0
    y = F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1000)) / 1000.0
    df = spark.range(1000).select("id", F.when(F.col("id") < 10, x + 30).otherwise(x).alias("x"), F.when(F.col("id") < 10, y - 30).otherwise(y).alias("y"))
    nodes = forest(df, "id", ("x", "y"), trees=20, sample=64)
    per_tree = nodes.groupBy("tree").count().collect()
    assert len(per_tree) == 20 and max(r["count"] for r in per_tree) <= 2 * 120
    out = isolation_scores(df, "id", ("x", "y"), trees=40, sample=64, contamination=0.01)
    assert out.count() == 1000
    assert sorted(r["id"] for r in out.orderBy(F.col("anomaly_score").desc()).limit(10).collect()) == list(range(10))
    assert out.where("is_anomaly").count() <= 10
    assert expected_path(2) == 1.0 and expected_path(256) == pytest.approx(10.244770920119, rel=1e-9)


def test_recommendations_for_wide_and_text_keys(spark):
    pairs = [(3_000_000_000 + u, f"item-{i}", 5.0) for u in range(6) for i in range(4) if (u + i) % 3]
    triples = spark.createDataFrame(pairs, "u bigint, i string, w double")
    all_items = ML.recommend_by_key(triples, "u", "i", F.col("w"), 2, rank=4, iterations=5).collect()
    assert {(r["u"], r["rank"]) for r in all_items} == {(u, k) for u, _, _ in pairs for k in (1, 2)}
    unseen = ML.recommend_by_key(triples, "u", "i", F.col("w"), 2, unseen=True, rank=4, iterations=5).collect()
    assert unseen and not {(r["u"], r["i"]) for r in unseen} & {(u, i) for u, i, _ in pairs}


def test_boosting_groups_equal_rows(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(ML, "assemble", lambda df, features, plain=ML.assemble: fitted.append(df) or plain(df, features))
    rows = spark.range(4000).selectExpr("id", "cast(id % 7 as double) a", "if(id % 5 = 0, null, id % 50) b", "id * 1.0 c", "cast(id % 7 > 4 as int) y")
    _, out = ML.fit_boosted(rows, ["a", "b", "c"], "y", "id", trees=10, depth=2, subsample=1.0, test_share=0.2, positive_weight=3)
    got = out.select("id", "y", "probability", "is_test").collect()
    assert len(got) == 4000 and all((r.probability > 0.5) == bool(r.y) for r in got)
    assert sum(r.is_test for r in got) == 800
    grouped = next(df for df in fitted if "_w" in df.columns)
    rows_of = grouped.agg(F.sum("_n"), F.count(F.lit(1)), F.sum("_w"), F.max("c"), F.count_distinct("b")).first()
    positives = sum(r.y for r in got if not r.is_test)
    assert (rows_of[0], rows_of[2], rows_of[4]) == (3200, 3200 + 2 * positives, ML.BINS) and rows_of[3] == ML.BINS - 1


def test_tasks_of_order_lines_follow_their_number(spark, monkeypatch):
    from tidewater.operators import joins
    from tidewater.plans import features as FE
    from tidewater.queries import queries
    from tidewater.sources.commerce import Commerce

    base = "/root/testdata/sf0.001"
    plain = queries()["rank_metrics"](spark, base).collect()
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 500)
    c = Commerce(spark, base)
    parts = c.line_parts()
    assert parts == -(-c.table("lineitem").count() // 500) > 4
    assert FE.user_item_matrix(c.order_lines(parts), parts).rdd.getNumPartitions() == parts
    assert queries()["rank_metrics"](spark, base).collect() == plain
