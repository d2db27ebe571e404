"""Forecasts, recommendations, risk models and their metrics."""

from pyspark.sql import functions as F

from tidewater.functions import risk_band
from tidewater.operators import evaluation as EV
from tidewater.operators.ranking import top_per_group
from tidewater.operators.sessions import item_transitions
from tidewater.operators.topn import top_by_product
from tidewater.plans import features as FE
from tidewater.plans import forecasting as FO
from tidewater.plans import isolation
from tidewater.plans import marts as M
from tidewater.plans import models as ML
from tidewater.queries.features import paid, user_feature_table
from tidewater.queries.oracle import sessions_sql, sql
from tidewater.queries.registry import query, rounded
from tidewater.session import pin


def demand(c):
    return FE.daily_demand(c.order_lines())


_SEASON = (
    "fc AS (SELECT CAST(e + CAST(h AS INTEGER) AS DATE) AS ds, CAST(h AS INTEGER) AS horizon_day, "
    "(SELECT gmv FROM (SELECT gmv, row_number() OVER (ORDER BY ds DESC) AS back FROM demand) WHERE back = 7 - (h - 1) % 7) AS predicted "
    "FROM (SELECT max(ds) AS e FROM demand), generate_series(1, 14) g(h))"
)


@query(
    "forecast_seasonal_naive",
    sql("demand", "SELECT 'all' AS series, ds, horizon_day, round(predicted, 2) AS predicted FROM fc", _SEASON),
)
def forecast_seasonal_naive(c):
    return rounded(FO.seasonal_naive(demand(c), "gmv", 14), predicted=2)


@query(
    "forecast_with_history",
    sql(
        "demand",
        "SELECT ds, round(gmv, 2) AS value, 'history' AS kind FROM demand UNION ALL SELECT ds, round(predicted, 2), 'forecast' FROM fc",
        _SEASON,
    ),
)
def forecast_with_history(c):
    series = demand(c)
    return rounded(FO.with_history(series, FO.seasonal_naive(series, "gmv", 14), "ds", "gmv"), value=2)


_ERRORS = (
    "count(*) AS n, round(coalesce(sum(abs(a - p)) FILTER (a <> 0) / sum(abs(a)) FILTER (a <> 0), 0) + 1e-9, 6) AS wape, "
    "round(avg(abs(a - p)) + 1e-9, 4) AS mae, round(sqrt(avg((a - p) * (a - p))) + 1e-9, 4) AS rmse, "
    "round(coalesce(avg(abs(a - p) / abs(a)) FILTER (a <> 0), 0) + 1e-9, 6) AS mape"
)
_ERR = {"wape": 6, "mae": 4, "rmse": 4, "mape": 6}


@query(
    "forecast_errors",
    sql("demand", f"SELECT {_ERRORS} FROM (SELECT gmv AS a, lag(gmv, 7) OVER (ORDER BY ds) AS p FROM demand) WHERE p IS NOT NULL"),
)
def forecast_errors(c):
    return rounded(EV.forecast_errors(FO.naive_fit(demand(c), "gmv"), "gmv", "predicted"), **_ERR)


@query(
    "walk_forward_metrics",
    sql(
        "demand",
        f"SELECT CAST(fold AS INTEGER) AS fold, {_ERRORS} FROM (SELECT fold, t.gmv AS a, s.gmv AS p FROM bounds "
        "JOIN pos t ON t.i >= fin - 14 AND t.i < fin JOIN pos s ON s.i = fin - 21 + (t.i - (fin - 14)) % 7) GROUP BY fold",
        "pos AS (SELECT row_number() OVER (ORDER BY ds) - 1 AS i, gmv, count(*) OVER () AS n FROM demand), "
        "bounds AS (SELECT fold, least(fold * (n // 6) + n // 6 + 104, n) AS fin FROM (SELECT max(n) AS n FROM pos), generate_series(0, 4) g(fold))",
    ),
)
def walk_forward_metrics(c):
    return rounded(FO.walk_forward(demand(c), "gmv", folds=5, lookback=90, horizon=14), **_ERR)


@query("forecast_lag_regression")
def forecast_lag_regression(c):
    series = FE.category_demand_daily(c.order_lines(), c.products())
    return rounded(FO.lag_forecast(series, "category", "units", horizon=7), predicted=4)


@query(
    "popular_items",
    sql(
        "matrix",
        "SELECT product_id, CAST(sum(units + orders) AS DOUBLE) AS score FROM matrix GROUP BY 1 ORDER BY score DESC, product_id LIMIT 20",
    ),
)
def popular_items(c):
    triples = FE.user_item_matrix(c.order_lines()).withColumn("weight", F.col("units") + F.col("orders"))
    return ML.popular_items(triples, "product_id", "weight", 20)


@query(
    "top_popular_daily",
    sql(
        "live",
        "SELECT ds, product_id, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY n DESC, product_id) AS rank FROM "
        "(SELECT CAST(created_at AS DATE) AS ds, product_id, count(*) AS n FROM live GROUP BY ALL)) WHERE rank <= 5",
    ),
    ints="rank",
)
def top_popular_daily(c):
    counts = M.sold(c.order_lines(), M.LIVE).groupBy(F.to_date("created_at").alias("ds"), "product_id").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, ["ds"], [F.col("n").desc(), F.col("product_id")], 5)


@query(
    "next_item_transitions",
    sql(
        "ev",
        "SELECT item, next_item, transitions, rank FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY transitions DESC, next_item) AS rank FROM "
        "(SELECT product_id AS item, nxt AS next_item, count(*) AS transitions FROM (SELECT product_id, lead(product_id) OVER "
        "(PARTITION BY user_id, session_num ORDER BY event_ts, event_id) AS nxt FROM numbered WHERE product_id IS NOT NULL) WHERE nxt IS NOT NULL GROUP BY ALL)) WHERE rank <= 3",
        sessions_sql(720),
    ),
    ints="rank",
)
def next_item_transitions(c):
    return ML.next_item_table(item_transitions(c.events(), 720), 3)


@query("als_recommendations")
def als_recommendations(c):
    """Top 5 items per buyer, with popular items for buyers without orders."""
    triples = FE.user_item_matrix(c.order_lines()).withColumn("weight", F.col("units") + F.col("orders"))
    recs = ML.recommend_by_key(triples, "buyer_id", "product_id", F.col("weight"), 5)
    buyers = c.users().select(F.col("user_id").alias("buyer_id"))
    popular = ML.popular_items(triples, "product_id", "weight", 5)
    return ML.with_fallback(buyers, recs, popular, "buyer_id", "product_id")


@query(
    "fallback_recommendations",
    sql(
        "matrix users",
        """SELECT buyer_id, product_id, CAST(rank AS INTEGER) AS rank, false AS fallback FROM best UNION ALL
        SELECT user_id, product_id, CAST(rank AS INTEGER), true FROM users, popular WHERE user_id NOT IN (SELECT buyer_id FROM best)""",
        """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY buyer_id ORDER BY units DESC, product_id) AS rank FROM matrix) WHERE rank <= 5),
        popular AS (SELECT product_id, row_number() OVER (ORDER BY sum(units + orders) DESC, product_id) AS rank FROM matrix GROUP BY 1 QUALIFY rank <= 5)""",
    ),
)
def fallback_recommendations(c):
    """Each buyer's five products with the most units, and the popular five for buyers without any."""
    triples = FE.user_item_matrix(c.order_lines()).withColumn("weight", F.col("units") + F.col("orders"))
    recs = top_per_group(triples.select("buyer_id", "product_id", "units"), ["buyer_id"], [F.col("units").desc(), F.col("product_id")], 5)
    buyers = c.users().select(F.col("user_id").alias("buyer_id"))
    return ML.with_fallback(buyers, recs, ML.popular_items(triples, "product_id", "weight", 5), "buyer_id", "product_id")


@query(
    "top_inner_products",
    "SELECT id, rank, round(CAST(s AS DOUBLE) + 1e-9, 3) + 0.0 AS score FROM (SELECT q.vec_id AS id, list_inner_product(q.embedding, v.embedding) AS s, "
    "row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.embedding, v.embedding) DESC) AS rank "
    "FROM embeddings v, embeddings q WHERE q.vec_id % 100 = 0) WHERE rank <= 10",
    ints="rank",
)
def top_inner_products(c):
    """The ten largest inner products of every hundredth vector with all vectors, by the search behind the recommendations."""
    vectors = c.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"))
    lists = top_by_product(vectors.where("id % 100 = 0").withColumn("k", F.lit(10)), vectors)
    rows = lists.select("id", F.posexplode("scores").alias("rank", "score"))
    return rounded(rows.withColumn("rank", F.col("rank") + 1), score=3)


@query(
    "recs_with_attributes",
    sql(
        "matrix products",
        "SELECT buyer_id, rank, r.product_id, title, category, price FROM (SELECT *, row_number() OVER (PARTITION BY buyer_id ORDER BY units DESC, product_id) AS rank "
        "FROM matrix) r LEFT JOIN products p USING (product_id) WHERE rank <= 3",
    ),
    ints="rank",
)
def recs_with_attributes(c):
    best = top_per_group(
        FE.user_item_matrix(c.order_lines()).select("buyer_id", "product_id", "units"), ["buyer_id"], [F.col("units").desc(), F.col("product_id")], 3
    )
    return best.join(c.products().select("product_id", "title", "category", "price"), "product_id", "left").drop("units")


@query(
    "item_index",
    sql("ev", "SELECT product_id, CAST(row_number() OVER (ORDER BY product_id) AS INTEGER) AS index FROM (SELECT DISTINCT product_id FROM ev WHERE product_id IS NOT NULL)"),
)
def item_index(c):
    return ML.item_index(c.events(), "product_id")


_CUT = "2000-01-01"


@query(
    "rank_metrics",
    sql(
        "live",
        """SELECT count(*) AS users, count(*) FILTER (n_rel > 0) AS judged_users,
        round(coalesce(avg(hits / 20) FILTER (n_rel > 0), 0) + 1e-9, 6) AS precision_at_k, round(coalesce(avg(hits / n_rel) FILTER (n_rel > 0), 0) + 1e-9, 6) AS recall_at_k,
        round(coalesce(avg(dcg / ideal) FILTER (n_rel > 0), 0) + 1e-9, 6) AS ndcg_at_k, round(avg(coalesce(1.0 / first_hit, 0)) + 1e-9, 6) AS mrr_at_k FROM (
        SELECT u, coalesce(n_rel, 0) AS n_rel, coalesce(hits, 0) AS hits, coalesce(dcg, 0) AS dcg, first_hit,
               (SELECT sum(1.0 / log2(i + 1)) FROM generate_series(1, 20) g(i) WHERE i <= n_rel) AS ideal
        FROM (SELECT buyer_id AS u FROM recs UNION SELECT buyer_id FROM rel)
        LEFT JOIN (SELECT buyer_id AS u, count(*) AS n_rel FROM rel GROUP BY 1) USING (u)
        LEFT JOIN (SELECT buyer_id AS u, count(*) AS hits, sum(1.0 / log2(rank + 1)) AS dcg, min(rank) AS first_hit
                   FROM recs JOIN rel USING (buyer_id, product_id) GROUP BY 1) USING (u))""",
        f"""rel AS (SELECT DISTINCT buyer_id, product_id FROM live WHERE created_at >= TIMESTAMP '{_CUT}'),
        recs AS (SELECT buyer_id, product_id, rank FROM (SELECT buyer_id, product_id, row_number() OVER (PARTITION BY buyer_id ORDER BY sum(quantity) DESC, product_id) AS rank
                 FROM live WHERE created_at < TIMESTAMP '{_CUT}' GROUP BY buyer_id, product_id) WHERE rank <= 20)""",
    ),
)
def rank_metrics(c):
    parts = c.line_parts()
    lines = c.order_lines(parts)
    past = FE.user_item_matrix(lines.where(F.col("created_at") < F.lit(_CUT).cast("timestamp")), parts)
    best = top_per_group(past.select("buyer_id", "product_id", "units"), ["buyer_id"], [F.col("units").desc(), F.col("product_id")], 20)
    future = M.sold(lines, M.LIVE).where(F.col("created_at") >= F.lit(_CUT).cast("timestamp"))
    recs = best.select(F.col("buyer_id").alias("user"), F.col("product_id").alias("item"), "rank")
    relevant = future.select(F.col("buyer_id").alias("user"), F.col("product_id").alias("item"))
    out = EV.ranking_metrics(recs, relevant, 20, parts)
    return rounded(out, precision_at_k=6, recall_at_k=6, ndcg_at_k=6, mrr_at_k=6)


# Payments scored by the buyer's failure share before them.
_SCORED = """scored AS (SELECT payment_id, amount, CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END AS label,
    CASE WHEN buyer_id IS NULL OR count(*) OVER w = 0 THEN 0.0 ELSE CAST(count(*) FILTER (status = 'FAILED') OVER w AS DOUBLE) / count(*) OVER w END AS score
    FROM pays WINDOW w AS (PARTITION BY buyer_id ORDER BY created_at, payment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    steps AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)"""


def scored(c):
    return FE.payment_history_pit(paid(c)).select(
        "payment_id", "amount", F.col("failed_label").alias("label"), F.col("buyer_fail_rate_hist").alias("score")
    )


@query(
    "classification_metrics",
    sql(
        "pays",
        """SELECT tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn) + 1e-9, 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END + 1e-9, 6) AS precision,
        round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END + 1e-9, 6) AS recall, round(2.0 * tp / (2 * tp + fp + fn) + 1e-9, 6) AS f1,
        round(won / ((tp + fn) * (fp + tn)) + 1e-9, 6) AS roc_auc FROM (
        SELECT CAST(sum(pos) FILTER (score >= 0.5) AS BIGINT) AS tp, CAST(sum(neg) FILTER (score >= 0.5) AS BIGINT) AS fp, CAST(sum(neg) FILTER (score < 0.5) AS BIGINT) AS tn,
        CAST(sum(pos) FILTER (score < 0.5) AS BIGINT) AS fn, sum(pos * (below + neg / 2)) AS won
        FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM steps))""",
        _SCORED,
    ),
)
def classification_metrics(c):
    out = EV.classification_metrics(scored(c), "label", "score")
    return rounded(out, accuracy=6, precision=6, recall=6, f1=6, roc_auc=6)


@query(
    "best_f1_threshold",
    sql(
        "pays",
        """SELECT round(score + 1e-9, 6) AS threshold, round(f1 + 1e-9, 6) AS f1, CAST(tp AS BIGINT) AS tp, CAST(flagged AS BIGINT) AS flagged FROM (
        SELECT score, tp, flagged, 2.0 * tp / (flagged + total) AS f1 FROM (SELECT score, sum(pos) OVER w AS tp, sum(pos + neg) OVER w AS flagged, sum(pos) OVER () AS total
        FROM steps WINDOW w AS (ORDER BY score DESC))) ORDER BY round(f1, 12) DESC, score DESC LIMIT 1""",
        _SCORED,
    ),
)
def best_f1_threshold(c):
    return rounded(EV.best_f1_threshold(scored(c), "label", "score"), threshold=6, f1=6)


@query(
    "precision_top1pct",
    sql(
        "pays",
        "SELECT round(cut, 4) AS cut, count(*) AS flagged, count(*) FILTER (status = 'FAILED') AS hits, "
        "round(count(*) FILTER (status = 'FAILED') / count(*) + 1e-9, 6) AS precision FROM pays, (SELECT quantile_cont(amount, 0.99) AS cut FROM pays) WHERE amount >= cut GROUP BY cut",
    ),
)
def precision_top1pct(c):
    rows = c.payments().select("amount", F.when(F.col("status") == "FAILED", 1).otherwise(0).alias("label"))
    return rounded(EV.precision_at_top(rows, "label", "amount"), cut=4, precision=6)


@query(
    "gain_by_decile",
    sql(
        "pays",
        """SELECT CAST(decile AS INTEGER) AS decile, n AS rows, CAST(pos AS BIGINT) AS positives, round(sum(pos) OVER w / sum(pos) OVER () + 1e-9, 6) AS cum_gain,
        round(abs(sum(pos) OVER w / sum(pos) OVER () - sum(n - pos) OVER w / sum(n - pos) OVER ()) + 1e-9, 6) AS ks
        FROM (SELECT decile, count(*) AS n, sum(label) AS pos FROM (SELECT *, ntile(10) OVER (ORDER BY score DESC, payment_id) AS decile FROM scored) GROUP BY 1)
        WINDOW w AS (ORDER BY decile)""",
        _SCORED,
    ),
)
def gain_by_decile(c):
    return rounded(EV.gain_by_decile(scored(c), "label", "score", "payment_id"), cum_gain=6, ks=6)


@query(
    "feature_drift",
    sql(
        "pays",
        """SELECT bucket, CAST(r AS BIGINT) AS reference_rows, CAST(k AS BIGINT) AS current_rows, round((k / sk - r / sr) * ln((k / sk) / (r / sr)) + 1e-9, 6) AS psi FROM (
        SELECT *, sum(r) OVER () AS sr, sum(k) OVER () AS sk FROM (SELECT CAST(amount > 100000 AS INTEGER) + CAST(amount > 200000 AS INTEGER) + CAST(amount > 300000 AS INTEGER) AS bucket,
        count(*) FILTER (created_at < TIMESTAMP '2000-01-01') AS r, count(*) FILTER (created_at >= TIMESTAMP '2000-01-01') AS k FROM pays GROUP BY 1))""",
    ),
)
def feature_drift(c):
    cut = F.lit("2000-01-01").cast("timestamp")
    rows = c.payments()
    out = EV.drift_psi(rows.where(F.col("created_at") < cut), rows.where(F.col("created_at") >= cut), "amount", (100_000, 200_000, 300_000))
    return rounded(out, psi=6)


@query(
    "risk_bands",
    sql(
        "pays",
        "SELECT risk, count(*) AS payments, CAST(min(p) AS DOUBLE) AS lowest FROM (SELECT CASE WHEN p >= 0.7 THEN 'high' WHEN p >= 0.4 THEN 'medium' ELSE 'low' END AS risk, p "
        "FROM (SELECT CASE WHEN amount >= 100000 THEN 0.9 ELSE 0.05 END AS p FROM pays UNION ALL SELECT 0.5 FROM pays WHERE buyer_id IS NULL)) GROUP BY 1",
    ),
)
def risk_bands(c):
    """Rule probabilities while no model is trained, and the band of each."""
    rows = paid(c)
    by_rule = rows.select(ML.rule_probability("amount").alias("p"))
    untrained = rows.where("buyer_id is null").select(F.lit(ML.UNTRAINED_CHURN_PROBABILITY).alias("p"))
    return by_rule.unionByName(untrained).groupBy(risk_band("p").alias("risk")).agg(
        F.count(F.lit(1)).alias("payments"), F.min("p").alias("lowest")
    )


@query(
    "anomaly_scores",
    sql(
        "heads users",
        """SELECT order_id, s AS anomaly_score, s > quantile_cont(s, 0.95) OVER () AS is_anomaly FROM (SELECT order_id, round((
        abs(total_amount - avg(total_amount) OVER ()) / stddev_pop(total_amount) OVER () + abs(items_count - avg(items_count) OVER ()) / stddev_pop(items_count) OVER () +
        abs(age - avg(age) OVER ()) / stddev_pop(age) OVER ()) / 3, 6) AS s FROM (
        SELECT order_id, total_amount, items_count, date_diff('day', CAST(u.created_at AS DATE), CAST(h.created_at AS DATE)) AS age
        FROM heads h JOIN users u USING (user_id)))""",
    ),
)
def anomaly_scores(c):
    rows = pin(FE.fraud_features(c.orders(), c.users()))
    out = ML.anomaly_scores(rows, ("total_amount", "items_count", "days_since_account_creation"))
    return out.select("order_id", "anomaly_score", "is_anomaly")


@query("isolation_scores")
def isolation_scores(c):
    rows = pin(FE.fraud_features(c.orders(), c.users()))
    out = isolation.isolation_scores(rows, "order_id", ML.FRAUD_FEATURES)
    return out.select("order_id", "anomaly_score", "is_anomaly")


@query("fraud_scored")
def fraud_scored(c):
    """Boosted trees over the fraud features and the anomaly score; failed payments stand in for labels."""
    rows = isolation.isolation_scores(pin(FE.fraud_features(c.orders(), c.users())), "order_id", ML.FRAUD_FEATURES)
    labels = c.payments().select(F.col("payment_id").alias("order_id"), F.when(F.col("status") == "FAILED", 1).otherwise(0).alias("is_fraud"))
    data = pin(rows.drop("is_anomaly").join(labels, "order_id"))
    features = (*ML.FRAUD_FEATURES, "anomaly_score")
    _, out = ML.fit_boosted(data, features, "is_fraud", "order_id", trees=300, depth=5, rate=0.05, subsample=1.0, test_share=0.2, positive_weight=19)
    return rounded(out.select("order_id", "is_fraud", "probability", "risk", "is_test"), probability=4)


@query("als_event_recommendations")
def als_event_recommendations(c):
    """Factors from behaviour events, top 10 unseen items per user."""
    triples = FE.event_interactions(c.events())
    weight = F.col("interaction_count")
    return ML.recommend_by_key(triples, "user_id", "product_id", weight, 10, unseen=True, rank=128, iterations=50, reg=0.01, alpha=40.0)


@query(
    "stratified_split",
    sql(
        "pays",
        """SELECT payment_id, failed_label, is_test, round(CASE WHEN NOT is_test THEN CASE WHEN failed_label = 1 THEN w ELSE 1.0 END END + 1e-9, 6) AS weight
        FROM marked, (SELECT greatest(1.0, count(*) FILTER (failed_label = 0) / count(*) FILTER (failed_label = 1)) AS w FROM marked WHERE NOT is_test)""",
        """marked AS (SELECT payment_id, failed_label, row_number() OVER (PARTITION BY failed_label ORDER BY h)
            <= floor(count(*) OVER (PARTITION BY failed_label) * 0.25 + 0.5) AS is_test
        FROM (SELECT payment_id, CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END AS failed_label,
              CAST('0x' || substr(md5(payment_id || ':42'), 1, 15) AS BIGINT) AS h FROM pays))""",
    ),
    ints="failed_label",
)
def stratified_split(c):
    """Payments dealt into training and test rows per class, with the class weights of the training rows."""
    rows = c.payments().select("payment_id", F.when(F.col("status") == "FAILED", 1).otherwise(0).alias("failed_label"))
    marked = ML.stratified_split(rows, "payment_id", "failed_label", 0.25)
    train = marked.where(~F.col("is_test"))
    weight = F.when(~F.col("is_test"), ML.class_weight(train, "failed_label"))
    return rounded(marked.withColumn("weight", weight), weight=6)


CHURN_SEEN = ("recency_days", "frequency_30d", "frequency_90d", "monetary_30d", "monetary_90d", "avg_order_value", "days_since_account_creation", "return_rate", "recency_ratio")


@query("churn_scored")
def churn_scored(c):
    """Features up to a day, label from the 60 days after it: what the label looks at is no feature."""
    day = F.lit("1999-06-01").cast("timestamp")
    data = pin(M.churn_features_documented(c.orders(), c.users(), day, returned=("pending",)))
    _, out = ML.fit_boosted(data, CHURN_SEEN, "churn_label", "user_id")
    return rounded(out.select("user_id", "churn_label", "probability", "risk", "is_test"), probability=4)


@query("payment_risk_scored")
def payment_risk_scored(c):
    data, features = ML.payment_features(pin(FE.payment_history_pit(paid(c))))
    _, out = ML.fit_boosted(data, features, "failed_label", "payment_id", trees=200, rate=0.08)
    return rounded(out.select("payment_id", "failed_label", "probability", "risk", "is_test"), probability=4)
