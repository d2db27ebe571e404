"""Streams over the sample tables, run until their input is used up."""

from pyspark.sql import functions as F

from tidewater.operators.keyed import read_history
from tidewater.operators.versions import read_table
from tidewater.plans.schemas import CLICK
from tidewater.queries.cdc import STATUS_HISTORY, click_messages, status_changes
from tidewater.queries.registry import query
from tidewater.session import work_dir
from tidewater.sources.bronze import replay_topic
from tidewater.streaming import bronze as B
from tidewater.streaming import stateful as ST


def recorded(c, messages, name):
    """A reader that replays messages recorded as files, whatever the topic."""
    path = work_dir(c.spark, name)
    messages.write.parquet(path)
    return lambda topic: replay_topic(c.spark, path)


def event_stream(c):
    """The events file as a stream of instants."""
    schema = c.table("events").schema
    rows = c.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(c.base)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def written_events(c):
    """The same rows as the bronze table holds them."""
    return c.table("events").withColumn("ts", F.col("ts").cast("timestamp"))


def run(c, df, name, partition_by=("event_date",)):
    path = work_dir(c.spark, name)
    B.write_bronze_stream(df, path, work_dir(c.spark, f"{name}-checkpoint"), partition_by=partition_by).awaitTermination()
    return c.spark.read.parquet(path)


@query(
    "stream_bronze_rows",
    """SELECT coalesce(op, 'unreadable') AS cdc_op, event_date, count(*) AS rows FROM (
    SELECT CASE WHEN o_orderkey % 97 <> 0 THEN 'c' END AS op, CAST(o_orderdate AS DATE) AS event_date FROM orders
    UNION ALL SELECT 'u', CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT 'd', CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 10 = 0) GROUP BY ALL""",
)
def stream_bronze_rows(c):
    """Change messages streamed into the bronze table, counted per day and operation.

    The sink is partitioned by month here: the sample spreads a few rows over
    thousands of days.
    """
    read = recorded(c, c.cdc_orders(), "topic-orders")
    parsed = B.parse_envelope(read("orders")).withColumn("month", F.date_format("event_date", "yyyy-MM"))
    bronze = run(c, parsed, "bronze-cdc", ("month",))
    return bronze.groupBy(F.coalesce("cdc_op", F.lit("unreadable")).alias("cdc_op"), "event_date").agg(F.count(F.lit(1)).alias("rows"))


# The topic that stands for each kind of sample event.
TOPICS = {"click": "events.clicks", "view": "events.cart", "signup": "events.search", "purchase": "events.purchase"}


def typed_messages(c):
    """Kafka-shaped messages for all typed topics, with every field their schemas ask for; every 50th is malformed."""
    key, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    body = F.to_json(
        F.struct(
            key.cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.get_json_object("props", "$.k").alias("product_id"),
            key.cast("string").alias("order_id"),
            F.col("value").alias("total_amount"),
            (key % 9).alias("position"),
            (key % 5).alias("quantity"),
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
        )
    )
    kinds = F.create_map(*[F.lit(x) for pair in TOPICS.items() for x in pair])
    return c.table("events").where(F.col("event_type").isin(*TOPICS)).select(
        key.cast("string").cast("binary").alias("key"),
        F.when(key % 50 == 0, F.lit("{bad")).otherwise(body).cast("binary").alias("value"),
        kinds[F.col("event_type")].alias("topic"),
        (key % 4).cast("int").alias("partition"),
        key.alias("offset"),
        ts.alias("timestamp"),
    )


@query(
    "stream_typed_events",
    "SELECT CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'cart' WHEN 'signup' THEN 'search' ELSE 'purchase' END AS topic, "
    "CAST(ts AS DATE) AS event_date, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids FROM events "
    "WHERE event_type IN ('click', 'view', 'signup', 'purchase') AND event_id % 50 <> 0 GROUP BY ALL",
)
def stream_typed_events(c):
    """All four registered topics, each its own stream, started together and awaited."""
    source, root, marks = work_dir(c.spark, "topics"), work_dir(c.spark, "bronze"), work_dir(c.spark, "marks")
    typed_messages(c).write.partitionBy("topic").parquet(source)
    streams = B.stream_typed_topics(lambda topic: replay_topic(c.spark, f"{source}/topic={topic}"), root, marks, trigger_seconds=None)
    B.await_all(c.spark, streams)
    out = None
    for topic in TOPICS.values():
        name = topic.split(".")[-1]
        rows = c.spark.read.parquet(f"{root}/events/{name}").where("event_id is not null and ts is not null")
        day = rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("event_id").cast("long")).alias("ids"))
        day = day.select(F.lit(name).alias("topic"), "event_date", "rows", "ids")
        out = day if out is None else out.unionByName(day)
    return out


@query(
    "stream_dead_letter",
    "SELECT CASE WHEN event_id % 50 = 0 OR event_id % 51 = 0 OR event_id % 53 = 0 THEN 'dead_letter' ELSE 'good' END AS route, "
    "CAST(ts AS DATE) AS event_date, count(*) AS messages FROM events GROUP BY ALL",
)
def stream_dead_letter(c):
    read = recorded(c, click_messages(c), "topic-clicks")
    out = run(c, B.route_events(read("clicks"), CLICK), "routed", ("route", "event_date"))
    return out.groupBy("route", "event_date").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "stream_dedup",
    "SELECT event_type, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1",
)
def stream_dedup(c):
    """Every third event arrives twice."""
    stream = event_stream(c)
    twice = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    once = ST.dedup(stream.withColumn("copy", F.explode(twice)), delay="1 hour").drop("copy")
    out = run(c, once.withColumn("event_date", F.to_date("ts")), "deduped")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("id_sum"))


@query("events_per_minute", "SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def events_per_minute(c):
    """Closed minutes from the stream, settled with the written rows: the open minutes and late rows are in."""
    rates = ST.rate_per_minute(event_stream(c), by=("event_type",))
    out = run(c, rates.withColumn("event_date", F.to_date("minute")), "rates")
    return ST.settle_rates(out, written_events(c), by=("event_type",)).drop("state")


@query(
    "session_window_counts",
    """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS event_count FROM (
    SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS s
    FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)) GROUP BY user_id, s""",
)
def session_window_counts(c):
    sessions = ST.session_windows(event_stream(c))
    out = run(c, sessions.withColumn("event_date", F.to_date("session_start")), "sessions")
    return ST.settle_sessions(out.drop("event_date"), written_events(c)).drop("state")


@query(
    "stream_merge",
    "SELECT event_id, event_type || '!' AS event_type, ts + INTERVAL 1 SECOND AS ts, CAST(ts AS DATE) AS event_date FROM events",
)
def stream_merge(c):
    """Events streamed into silver twice, the second time with later versions of every row."""
    path = work_dir(c.spark, "silver-events")
    rows = event_stream(c).select("event_id", "event_type", "ts", F.to_date("ts").alias("event_date"))
    later = rows.withColumns({"ts": F.col("ts") + F.expr("interval 1 second"), "event_type": F.concat("event_type", F.lit("!"))})
    for n, df in enumerate((rows, later)):
        ST.stream_merge(df, path, work_dir(c.spark, f"silver-{n}"), "event_id", "ts", "event_date").awaitTermination()
    return read_table(c.spark, path)


@query("stream_scd2", STATUS_HISTORY)
def stream_scd2(c):
    """Customer status changes streamed in four batches that are no cut in time, so that most of them come late."""
    source, path = work_dir(c.spark, "changes"), work_dir(c.spark, "silver-history")
    changes, files = status_changes(c), c.spark.sparkContext.defaultParallelism  # files a batch, so that its tasks share it
    changes.repartition(4 * files, F.xxhash64("user_id", "at")).write.parquet(source)
    stream = c.spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", files).parquet(source)
    ST.stream_scd2(stream, path, work_dir(c.spark, "history-marks"), "user_id", ["status"], "at", buckets=8, cell_seconds=30 * 86400).awaitTermination()
    return read_history(c.spark, path).drop("at")
