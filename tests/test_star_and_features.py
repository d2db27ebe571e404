from conftest import day, ts
from pyspark.sql import functions as F

from tidewater import functions as X
from tidewater.operators import cleaning as CL
from tidewater.plans import features as FE
from tidewater.plans import forecasting as FO
from tidewater.plans import marts as M
from tidewater.plans import star as S
from tidewater.plans.schemas import EVENT_SCHEMAS, SILVER_USER


def test_calendar(spark):
    dates = S.dim_date(spark)
    assert dates.count() == 4017
    assert dates.agg(F.max("full_date")).first()[0] == day("2030-12-30")
    fridays = {r["full_date"]: r["is_black_friday"] for r in dates.where("full_date in ('2029-11-23', '2029-11-30')").collect()}
    assert fridays == {day("2029-11-23"): True, day("2029-11-30"): False}
    christmas = dates.where("full_date = '2024-12-25'").first()
    assert (christmas["is_national_holiday"], christmas["holiday_name"], christmas["date_sk"], christmas["day_name"]) == (True, "Natal", 20241225, "Wednesday")
    assert dates.where("is_national_holiday").count() == 8 * 11 - 0
    sunday = dates.where("full_date = '2024-06-02'").first()
    assert sunday["day_of_week"] == 1 and sunday["is_weekend"]


def test_dim_users_age_and_fallbacks(spark):
    users = spark.createDataFrame([("u1", "F", "2000-02-29"), ("u2", None, "x")], "user_id string, gender string, birth_date string")
    rows = {r["user_id"]: r for r in S.dim_users(users, F.lit("2024-02-28").cast("timestamp")).collect()}
    assert (rows["u1"]["gender"], rows["u1"]["age"]) == ("Feminino", 23)
    assert (rows["u2"]["gender"], rows["u2"]["age"]) == ("Não informado", None)


def test_union_by_name_and_missing_columns(spark):
    clicks = spark.createDataFrame([("1", "u", "p", ts("2024-01-01 00:00:00"))], "event_id string, user_id string, product_id string, ts timestamp")
    search = clicks.drop("product_id").withColumn("event_id", F.lit("2"))
    out = {r["event_id"]: r["product_id"] for r in CL.union_events({"clicks": clicks, "search": search}).collect()}
    assert out == {"1": "p", "2": None}


def test_mandatory_event_fields():
    required = {t: [f.name for f in s.fields if not f.nullable] for t, s in EVENT_SCHEMAS.items()}
    assert set(required) == {"events.clicks", "events.cart", "events.search", "events.purchase"}
    assert required["events.purchase"] == ["event_id", "user_id", "order_id", "total_amount", "ts"]
    assert all({"event_id", "ts"} <= set(v) for v in required.values())
    assert len(SILVER_USER.fields) == 11


def test_session_sample(spark):
    row = spark.range(1).select(X.session_sample(F.array(*map(F.lit, (1, 2, 3, 4, 5))), 10).alias("s")).first()["s"]
    assert (row["input"], row["target"], row["length"]) == ([1, 2, 3, 4, 0, 0, 0, 0, 0, 0], 5, 4)


def test_guarded_division_and_bands(spark):
    row = spark.range(1).select(
        X.guarded_ratio(F.lit(3), F.lit(0)).alias("z"),
        X.risk_band(F.lit(0.7)).alias("h"),
        X.risk_band(F.lit(0.4)).alias("m"),
        X.risk_band(F.lit(0.39)).alias("l"),
        X.bucketize(F.lit(8), (7, 30), ("a", "b", "c")).alias("b"),
    ).first()
    assert tuple(row) == (0.0, "high", "medium", "low", "b")


def test_windows_over_a_series(spark):
    series = spark.range(100).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("ds"), F.col("id").cast("double").alias("v"))
    windows = FE.demand_windows(series, "v", 10, 5)
    assert windows.count() == 86
    first = windows.orderBy("window_end").first()
    assert first["inputs"] == [float(i) for i in range(10)] and first["targets"] == [10.0, 11.0, 12.0, 13.0, 14.0]
    short = FE.last_window(series.where("v < 3"), 5).orderBy("position").collect()
    assert [r["v"] for r in short] == [2.0, 2.0, 0.0, 1.0, 2.0]
    flat = FE.scaled(series.withColumn("v", F.lit(4.0)), ["v"]).first()
    assert flat["v_z"] == 0.0


def test_seasonal_and_lag_forecasts(spark):
    series = spark.range(28).select(
        F.lit("a").alias("s"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("ds"), (F.col("id") % 7 * 10.0).alias("v")
    )
    ahead = FO.seasonal_naive(series, "v", 9, series=["s"]).orderBy("ds").collect()
    assert [r["predicted"] for r in ahead] == [0.0, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 0.0, 10.0]
    assert ahead[0]["ds"] == day("2024-01-29")
    rolled = FO.lag_forecast(series, "s", "v", horizon=7).orderBy("ds").collect()
    assert [round(r["predicted"], 3) for r in rolled] == [0.0, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0]
    assert FO.walk_forward(series, "v", folds=2, lookback=7, horizon=7).where("wape <> 0").count() == 0


def test_rfm_ties_are_decided_by_the_key(spark):
    raw = spark.range(10).select(F.col("id").alias("user_id"), F.lit(3).alias("recency_days"), F.lit(1).alias("frequency"), F.lit(9.99).alias("monetary"))
    out = M.customer_rfm(raw).orderBy("user_id").collect()
    assert [r["m_score"] for r in out] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert out[9]["rfm_cell"] == "555" and out[9]["rfm_segment"] == "Champions"


def test_history_does_not_see_the_scored_row(spark):
    paid = spark.createDataFrame(
        [(1, "b", 10.0, "pix", "FAILED", ts("2024-01-01 00:00:00")), (2, "b", 20.0, "pix", "CONFIRMED", ts("2024-01-02 00:00:00")), (3, None, 5.0, "pix", "FAILED", ts("2024-01-02 00:00:00"))],
        "payment_id long, buyer_id string, amount double, method string, status string, created_at timestamp",
    )
    rows = {r["payment_id"]: (r["buyer_pay_count"], r["buyer_avg_amount"], r["buyer_fail_rate_hist"]) for r in FE.payment_history_pit(paid).collect()}
    assert rows == {1: (0, 0.0, 0.0), 2: (1, 10.0, 1.0), 3: (0, 0.0, 0.0)}
    leaky = {r["payment_id"]: r["buyer_fail_rate_hist"] for r in FE.payment_dataset(paid).collect()}
    assert leaky == {1: 0.5, 2: 0.5, 3: 0.0}


def test_feature_view_checks_its_source(spark):
    import pytest

    with pytest.raises(ValueError, match="fid"):
        FE.FeatureView("v", "e", "t", 60, ("fid",)).check(spark.createDataFrame([], "e string, t timestamp"))
    assert FE.USER_CHURN_VIEW.ttl_seconds == 7 * 86_400 and FE.SESSION_VIEW.ttl_seconds == 7_200
