import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from tidewater.operators import boosting
from tidewater.plans import models as ML


@pytest.fixture(scope="module")
def groups(spark):
    rows = spark.range(3000).selectExpr("double(id * 7919 % 23) a", "double(id * 104729 % 11) b", "double(id % 3) c", "int((id * 7919 % 23) + (id * 104729 % 11) + id % 7 > 20) y")
    return rows.groupBy("a", "b", "c", "y").agg(F.count(F.lit(1)).alias("n")).cache()


def test_trees_are_those_of_pyspark(spark, groups, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 4)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "TASK_ROWS", 200)
    features = ["a", "b", "c"]
    model = boosting.fit_trees(groups, features, "y", "n", 2.5, 11, 3, 0.1, 1.0, 1)
    got = {tuple(r[:4]): r.p for r in groups.select(*features, "y", model.probability().alias("p")).collect()}
    rows = ML.assemble(groups.withColumn("w", F.col("n") * F.when(F.col("y") == 1, 2.5).otherwise(1.0)), features).withColumn("label", F.col("y").cast("double"))
    plain = GBTClassifier(weightCol="w", maxIter=11, maxDepth=3, stepSize=0.1).fit(rows).transform(rows)
    want = {(r.a, r.b, r.c, r.y): float(r.probability[1]) for r in plain.collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-6


def test_draws_of_equal_rows_are_those_of_single_ones():
    n = np.array([1, 400, 1, 50_000] * 500)
    drawn = boosting._drawn(n, 0.9, 1, 2, 3)
    assert (drawn == boosting._drawn(n, 0.9, 1, 2, 3)).all() and (drawn != boosting._drawn(n, 0.9, 1, 3, 3)).any() and (drawn <= n).all()
    for size in (1, 400, 50_000):
        some = drawn[n == size]
        assert some.mean() == pytest.approx(0.9 * size, rel=0.03) and some.var() == pytest.approx(0.09 * size, rel=0.25)


def test_subsampled_fit_sees_groups(spark, monkeypatch):
    """Before, every single row went into the trees."""
    fitted = []
    monkeypatch.setattr(ML, "fit_trees", lambda g, *a, plain=ML.fit_trees: fitted.append(g) or plain(g, *a))
    rows = spark.range(4000).selectExpr("id", "id % 7 a", "if(id % 5 = 0, null, id % 6) b", "int(id % 7 > 4) y")
    _, out = ML.fit_boosted(rows, ["a", "b"], "y", "id", trees=12, depth=2, test_share=0.2)
    assert fitted[0].count() == 42 and fitted[0].agg(F.sum("_n")).first()[0] == 3200
    got = out.collect()
    assert len(got) == 4000 and all((r.probability > 0.5) == bool(r.y) for r in got)
    assert out.where("a <> id % 7 or b <> id % 6 or (b is null) <> (id % 5 = 0)").count() == 0
