"""Structured Streaming jobs; each result is checked against its batch counterpart."""

from pyspark.sql import functions as F

from catalog.etl import MIGRATED, PARSED, TIMELINE
from catalog.registry import query
from foliospark.functions.dates import activity_text
from foliospark.operators.quality import split_events
from foliospark.session import work_folder
from foliospark.sources import adapters, tables
from foliospark.streaming import events, ledger, logs, sinks, windows

_VALID = "event_type IN ('click', 'view', 'like', 'add_to_list')"
_STREAMED = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, TRY_CAST(book_id AS BIGINT) ORDER BY
    CASE event_type WHEN 'like' THEN 3 WHEN 'add_to_list' THEN 2 WHEN 'click' THEN 1 ELSE 0 END DESC, event_timestamp DESC, event_id DESC) AS rn
  FROM fx_events WHERE event_type <> 'view' AND {_VALID}) WHERE rn = 1)"""


def _events(spark, sf_dir):
    return adapters.events_of(adapters.event_stream(spark, sf_dir))


@query("t3_event_stream_etl", MIGRATED + _STREAMED)
def event_etl(spark, sf_dir):
    root = work_folder(spark)
    events.ingest(_events(spark, sf_dir), f"{root}/events", f"{root}/work")
    return events.current(spark, f"{root}/events")


@query("x1_event_stream_upsert", f"SELECT interaction_type, count(*) AS row_count, count(DISTINCT user_id) AS users FROM (SELECT user_id, event_type AS interaction_type FROM {_STREAMED}) GROUP BY 1")
def stream_upsert(spark, sf_dir):
    """The stream runs twice; the second delivery of every event changes nothing."""
    root = work_folder(spark)
    for run in ("first", "second"):
        events.ingest(_events(spark, sf_dir), f"{root}/events/{run}", f"{root}/{run}")
    both = events.compact(spark, [f"{root}/events/first", f"{root}/events/second"], f"{root}/interactions")
    return both.groupBy("interaction_type").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("user_id").alias("users"))


# Stored interactions: reads are moved thirty years on, past the events; the others lie before them. The user's number is that of an event user.
_STORED = """(SELECT * FROM (SELECT concat('u', o_custkey) AS user_id, l_partkey % 100 AS book_id, concat(l_orderkey, '-', l_linenumber) AS review_id,
    CASE WHEN l_returnflag = 'R' THEN l_shipdate + INTERVAL 30 YEAR ELSE l_shipdate END AS t, l_returnflag = 'R' AS is_read, CAST(l_linenumber % 6 AS BIGINT) AS rating,
    CASE WHEN l_returnflag = 'R' THEN 'read' ELSE 'like' END AS interaction_type FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  QUALIFY row_number() OVER (PARTITION BY user_id, book_id ORDER BY t DESC, review_id DESC) = 1)"""


@query("x1_event_stream_merge", f"""
SELECT coalesce(s.user_id, e.user_id) AS user_id, coalesce(s.book_id, e.book_id) AS book_id,
  CASE WHEN s.user_id IS NULL OR e.event_timestamp > s.t THEN '' ELSE s.review_id END AS review_id,
  CASE WHEN s.user_id IS NULL OR e.event_timestamp > s.t THEN e.event_type ELSE s.interaction_type END AS interaction_type,
  CASE WHEN s.user_id IS NULL OR e.event_timestamp > s.t THEN FALSE ELSE s.is_read END AS is_read,
  CASE WHEN s.user_id IS NULL OR e.event_timestamp > s.t THEN 0 ELSE s.rating END::BIGINT AS rating
FROM {_STORED} s FULL JOIN (SELECT user_id, TRY_CAST(book_id AS BIGINT) AS book_id, event_type, event_timestamp FROM {_STREAMED}) e
  ON s.user_id = e.user_id AND s.book_id = e.book_id""")
def stream_merge(spark, sf_dir):
    """Several micro-batches, some events delivered again and late, into a table that already has rows."""
    root = work_folder(spark)
    raw = adapters.table(spark, sf_dir, "events")
    again = raw.where(F.col("event_id") % 10 == 0)
    raw.unionByName(again).repartition(4, "event_id").write.parquet(f"{root}/incoming")
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/incoming")
    events.ingest(adapters.events_of(stream), f"{root}/events", f"{root}/work")
    lines, orders = adapters.table(spark, sf_dir, "lineitem"), adapters.table(spark, sf_dir, "orders")
    read = F.col("l_returnflag") == "R"
    moved = F.when(read, F.add_months("l_shipdate", 360).cast("timestamp")).otherwise(F.col("l_shipdate").cast("timestamp"))
    stored = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("u"), "o_custkey").alias("user_id"), (F.col("l_partkey") % 100).alias("book_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        activity_text(moved).alias("date_added"), activity_text(moved).alias("date_updated"), F.lit("").alias("read_at"), F.lit("").alias("started_at"), read.alias("is_read"),
        (F.col("l_linenumber") % 6).cast("bigint").alias("rating"), F.lit("").alias("review_text_incomplete"), F.when(read, "read").otherwise("like").alias("interaction_type"))
    return events.current(spark, f"{root}/events", stored).select("user_id", "book_id", "review_id", "interaction_type", "is_read", "rating")


@query("i6_validated_events", f"SELECT event_type, count(*) AS events FROM fx_events WHERE {_VALID} GROUP BY 1")
def validated_events(spark, sf_dir):
    """Streaming append of valid events to the event table; the others go to quarantine."""
    root = work_folder(spark)
    good, bad = sinks.batch_folder(f"{root}/events"), sinks.batch_folder(f"{root}/quarantine")

    def write(batch, batch_id):
        valid, rejected = split_events(batch)
        good(valid, batch_id)
        bad(rejected, batch_id)

    sinks.run(_events(spark, sf_dir), f"{root}/checkpoint", write)
    return tables.read(spark, f"{root}/events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query("i13_consume_once", "SELECT count(*) AS rows_stored, count(DISTINCT event_id) AS events FROM fx_events")
def consume_once(spark, sf_dir):
    """The checkpoint marks what is consumed: a second run over the same source finds nothing new."""
    root = work_folder(spark)
    for _ in range(2):
        sinks.run(_events(spark, sf_dir), f"{root}/checkpoint", sinks.batch_folder(f"{root}/events"))
    return tables.read(spark, f"{root}/events").agg(F.count(F.lit(1)).alias("rows_stored"), F.count_distinct("event_id").alias("events"))


@query("x2_sliding_click_through", """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_end, r4(avg(CASE WHEN v > 0 THEN c / v END)) AS avg_ctr, count(*) AS distinct_users_counted,
  CASE WHEN avg(CASE WHEN v > 0 THEN c / v END) IS NULL THEN 'no_data' WHEN avg(CASE WHEN v > 0 THEN c / v END) < 0.2 THEN 'decay' ELSE 'healthy' END AS status
FROM (SELECT date_trunc('hour', event_timestamp) + to_hours(CAST(k + 1 AS BIGINT)) AS w, user_id, count(*) FILTER (WHERE event_type = 'view') AS v, count(*) FILTER (WHERE event_type = 'click') AS c
  FROM fx_events CROSS JOIN range(24) r(k) GROUP BY 1, 2) WHERE c > 0 GROUP BY w""")
def sliding_click_through(spark, sf_dir):
    root = work_folder(spark)
    sinks.run(windows.hourly_clicks(_events(spark, sf_dir)), f"{root}/checkpoint", sinks.batch_folder(f"{root}/clicks"), mode="update")
    hourly = sinks.newest_updates(spark, f"{root}/clicks", ["hour", "user_id"])
    return windows.window_verdicts(windows.sliding_clicks(hourly))


@query("x3_minute_timeline_stream", TIMELINE + " GROUP BY 1")
def minute_timeline(spark, sf_dir):
    root = work_folder(spark)
    stream = adapters.requests_of(adapters.event_stream(spark, sf_dir))
    sinks.run(windows.minute_timeline(stream), f"{root}/checkpoint", sinks.batch_folder(f"{root}/minutes"), mode="update")
    rows = sinks.newest_updates(spark, f"{root}/minutes", ["minute"])
    return rows.select(F.date_format("minute", "yyyy-MM-dd'T'HH:mm").alias("time"), "requests", "errors", "avg_latency")


@query("x4_log_stream", f"SELECT shape, level, count(*) AS log_rows, count(DISTINCT date) AS days FROM ({PARSED}) GROUP BY 1, 2")
def log_stream(spark, sf_dir):
    root = work_folder(spark)
    logs.ingest(adapters.log_lines_of(adapters.event_stream(spark, sf_dir)), f"{root}/logs", f"{root}/work")
    known = tables.read(spark, f"{root}/logs/parsed").select("shape", "level", "date")
    unknown = tables.read(spark, f"{root}/logs/quarantine").select("shape", "level", F.lit(None).cast("date").alias("date"))
    return known.unionByName(unknown).groupBy("shape", "level").agg(F.count(F.lit(1)).alias("log_rows"), F.count_distinct("date").alias("days"))


@query("x5_unique_events", "SELECT count(*) AS rows_stored, count(DISTINCT event_id) AS events FROM fx_events")
def unique_events(spark, sf_dir):
    """Every event is delivered three times and kept once."""
    root = work_folder(spark)
    thrice = _events(spark, sf_dir).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("_copy")
    sinks.run(events.unique_events(thrice), f"{root}/checkpoint", sinks.batch_folder(f"{root}/events"))
    return tables.read(spark, f"{root}/events").agg(F.count(F.lit(1)).alias("rows_stored"), F.count_distinct("event_id").alias("events"))


@query("x5_unique_events_ledger", "SELECT count(*) AS rows_stored, count(DISTINCT event_id) AS events FROM fx_events")
def unique_events_ledger(spark, sf_dir):
    """Eight micro-batches; the last four deliver every event again, long after any watermark delay. The whole stream then runs once more from its start over the same ledger."""
    root = work_folder(spark)
    raw = adapters.table(spark, sf_dir, "events")
    for _ in range(2):
        raw.repartition(4).write.mode("append").parquet(f"{root}/incoming")
    stream = adapters.events_of(spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/incoming"))
    for run in ("first", "replay"):
        sinks.run(stream, f"{root}/checkpoint-{run}", ledger.unique_sink(f"{root}/ledger", buckets=16))
    return tables.read(spark, f"{root}/ledger/rows").agg(F.count(F.lit(1)).alias("rows_stored"), F.count_distinct("event_id").alias("events"))
