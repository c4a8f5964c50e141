"""Event ETL, request logs and log parsing."""

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import on_tables, query
from foliospark.functions.text import masked_path
from foliospark.operators import etl, logs, monitoring, requests, sketches
from foliospark.session import work_folder
from foliospark.sources import adapters

_PRIORITY = "CASE event_type WHEN 'like' THEN 3 WHEN 'add_to_list' THEN 2 WHEN 'click' THEN 1 ELSE 0 END"
_STRONGEST = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, book_id ORDER BY {_PRIORITY} DESC, event_timestamp DESC, event_id DESC) AS rn
  FROM fx_events WHERE event_type <> 'view') WHERE rn = 1)"""
MIGRATED = f"""
SELECT user_id, TRY_CAST(book_id AS BIGINT) AS book_id, '' AS review_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') || '+00' AS date_added,
  strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') || '+00' AS date_updated, '' AS read_at, '' AS started_at, FALSE AS is_read, CAST(0 AS BIGINT) AS rating,
  '' AS review_text_incomplete, event_type AS interaction_type FROM """


@query("t1_migrate_events", MIGRATED + _STRONGEST)
def migrate(spark, sf_dir):
    return etl.migrate_events(adapters.events(spark, sf_dir))


@query("t1a_event_priority", f"SELECT event_type, CAST({_PRIORITY} AS BIGINT) AS priority, count(*) AS events FROM fx_events GROUP BY 1, 2")
def priority(spark, sf_dir):
    return adapters.events(spark, sf_dir).groupBy("event_type", etl.priority(F.col("event_type")).alias("priority")).agg(F.count(F.lit(1)).alias("events"))


@query("t1b_dedup_by_raw_id", f"SELECT event_id, user_id, book_id, event_type FROM {_STRONGEST}")
def dedup_raw(spark, sf_dir):
    return etl.strongest_events(adapters.events(spark, sf_dir)).select("event_id", "user_id", "book_id", "event_type")


@on_tables("t2_backfill_type", """
SELECT user_id, book_id, coalesce(interaction_type, CASE WHEN is_read THEN 'read' WHEN rating > 0 THEN 'like' ELSE 'add_to_list' END) AS interaction_type FROM fx_interactions""")
def backfill(d):
    return etl.backfill_type(d.raw.interactions).select("user_id", "book_id", "interaction_type")


_CTR = """(SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS v, count(*) FILTER (WHERE event_type = 'click') AS c
  FROM fx_events WHERE event_timestamp >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY 1)"""


@query("t4_click_through", f"""
SELECT r4(avg_ctr) AS avg_ctr, n AS distinct_users_counted, CASE WHEN avg_ctr IS NULL OR avg_ctr = 0 THEN 'no_data' WHEN avg_ctr < 0.2 THEN 'decay' ELSE 'healthy' END AS status
FROM (SELECT avg(CASE WHEN v > 0 THEN c / v END) AS avg_ctr, count(*) AS n FROM {_CTR} WHERE c > 0)""")
def click_through(spark, sf_dir):
    return monitoring.click_through(adapters.events(spark, sf_dir), adapters.EVENTS_AS_OF)


_ENDPOINTS = """
SELECT endpoint, count(*) AS request_count, count(*) FILTER (WHERE status_code >= 400) AS error_count, r4(100.0 * count(*) FILTER (WHERE status_code >= 400) / count(*)) AS error_rate,
  r4(avg(latency_ms)) AS avg_latency_ms, r4(min(latency_ms)) AS min_latency_ms, r4(max(latency_ms)) AS max_latency_ms,
  r4(quantile_cont(latency_ms, 0.5)) AS p50_latency_ms, r4(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms, r4(quantile_cont(latency_ms, 0.99)) AS p99_latency_ms,
  count(*) FILTER (WHERE latency_ms > 250) AS slow_requests, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_request_time,
  min(status_code) || ':' || count(*) AS status_codes FROM fx_requests GROUP BY 1"""


@query("t5_endpoint_stats", _ENDPOINTS)
def endpoint_stats(spark, sf_dir):
    return requests.endpoint_stats(adapters.requests(spark, sf_dir), slow_ms=250.0)


@query("t6_request_summary", """
SELECT count(*) AS total_requests, count(*) FILTER (WHERE status_code >= 400) AS total_errors, r4(100.0 * count(*) FILTER (WHERE status_code >= 400) / count(*)) AS error_rate,
  r4(count(*) / (date_diff('microsecond', min(ts), max(ts)) / 60e6)) AS requests_per_minute, r4(avg(latency_ms)) AS avg_latency_ms,
  r4(quantile_cont(latency_ms, 0.95)) AS p95_latency_ms, r4(quantile_cont(latency_ms, 0.99)) AS p99_latency_ms FROM fx_requests""")
def request_summary(spark, sf_dir):
    return requests.request_summary(adapters.requests(spark, sf_dir))


MARKS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _stored_sketches(spark, sf_dir):
    """Day sketches of latencies and paths per endpoint, and the rows they were made from."""
    rows = requests.with_endpoint(adapters.requests(spark, sf_dir))
    path = f"{work_folder(spark)}/latency_sketches"
    sketches.add_days(sketches.of_days(rows, ["endpoint"], F.col("latency_ms"), F.col("path"), F.to_date("ts")), path)
    return rows, path


@query("t5_endpoint_sketches", """
SELECT endpoint, count(*) AS request_count, r4(min(latency_ms)) AS min_latency_ms, r4(max(latency_ms)) AS max_latency_ms, TRUE AS p50_within, TRUE AS p95_within, TRUE AS p99_within, TRUE AS paths_within
FROM fx_requests GROUP BY 1""")
def endpoint_sketches(spark, sf_dir):
    """Latency quantiles per endpoint from merged day sketches, held against the ranks in the rows."""
    rows, path = _stored_sketches(spark, sf_dir)
    found = sketches.merged(spark.read.parquet(path), ["endpoint"], MARKS)
    true = rows.groupBy("endpoint").agg(F.count_distinct("path").alias("_paths"))
    checks = sketches.within_rank(rows, ["endpoint"], F.col("latency_ms"), found.select("endpoint", *MARKS), MARKS)
    return found.join(checks, "endpoint").join(true, "endpoint").select(
        "endpoint", F.col("n").alias("request_count"), F.col("low").alias("min_latency_ms"), F.col("high").alias("max_latency_ms"), *[f"{m}_within" for m in MARKS],
        (F.abs(F.col("members") - F.col("_paths")) <= 0.1 * F.col("_paths")).alias("paths_within"))


@query("t6_summary_from_sketches", """
SELECT count(*) AS total_requests, r4(avg(latency_ms)) AS avg_latency_ms, TRUE AS p50_within, TRUE AS p95_within, TRUE AS p99_within FROM fx_requests
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""")
def summary_from_sketches(spark, sf_dir):
    """Eleven days out of the stored sketches."""
    rows, path = _stored_sketches(spark, sf_dir)
    first, last = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
    found = sketches.merged(sketches.read_range(spark, path, first, last), [], MARKS)
    some = rows.where(F.to_date("ts").between(F.lit(first), F.lit(last)))
    checks = sketches.within_rank(some, [], F.col("latency_ms"), found.select(*MARKS), MARKS)
    return found.select(F.col("n").alias("total_requests"), F.col("mean").alias("avg_latency_ms")).crossJoin(F.broadcast(checks))


@query("t6_endpoints_by_traffic", "SELECT endpoint, count(*) AS request_count FROM fx_requests GROUP BY 1 ORDER BY 2 DESC, 1")
def by_traffic(spark, sf_dir):
    return requests.endpoints_by_traffic(requests.endpoint_stats(adapters.requests(spark, sf_dir))).select("endpoint", "request_count")


TIMELINE = """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M') AS time, count(*) AS requests, count(*) FILTER (WHERE status_code >= 400) AS errors, r4(avg(latency_ms)) AS avg_latency
FROM fx_requests"""


@query("t7_minute_timeline", TIMELINE + " GROUP BY 1")
def timeline(spark, sf_dir):
    return requests.timeline(adapters.requests(spark, sf_dir))


@query("t7_recent_timeline", TIMELINE + " WHERE ts > TIMESTAMP '2024-01-30 18:00:00' GROUP BY 1")
def recent_timeline(spark, sf_dir):
    return requests.timeline(adapters.requests(spark, sf_dir), adapters.EVENTS_AS_OF, minutes=360)


@query("t8_masked_paths", """
SELECT path, '/' || array_to_string(list_transform(string_split(trim(path, '/'), '/'), lambda p: CASE WHEN regexp_full_match(p, '[0-9]+') OR length(p) > 20 THEN '{id}' ELSE p END), '/') AS masked, count(*) AS hits
FROM (SELECT concat('/', event_type, '/', user_id, CASE WHEN event_id % 3 = 0 THEN '/details/' WHEN event_id % 3 = 1 THEN concat('/', md5(event_type)) ELSE '' END) AS path FROM events) GROUP BY 1, 2""")
def masked(spark, sf_dir):
    n = F.col("event_id") % 3
    tail = F.when(n == 0, "/details/").when(n == 1, F.concat(F.lit("/"), F.md5("event_type"))).otherwise("")
    paths = adapters.table(spark, sf_dir, "events").select(F.concat(F.lit("/"), "event_type", F.lit("/"), "user_id", tail).alias("path"))
    return paths.groupBy("path", masked_path(F.col("path")).alias("masked")).agg(F.count(F.lit(1)).alias("hits"))


@query("t9_recent_errors", """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, endpoint, CAST(status_code AS BIGINT) AS status_code, r4(latency_ms) AS latency_ms, error_message FROM (
  SELECT * FROM fx_requests WHERE status_code >= 400 ORDER BY ts DESC, endpoint, latency_ms LIMIT 10)""")
def recent_errors(spark, sf_dir):
    return requests.recent_errors(adapters.requests(spark, sf_dir))


@query("t10_frontend_metrics", """
SELECT (SELECT count(DISTINCT user_id) FROM events) AS sessions, CAST(sum(CASE WHEN event_type = 'signup' THEN 0 ELSE 2 END) AS BIGINT) AS total_api_calls,
  count(*) FILTER (WHERE event_type = 'error') AS total_errors, r4(sum(CASE WHEN event_type = 'signup' THEN 0 ELSE 3 * value END) / sum(CASE WHEN event_type = 'signup' THEN 0 ELSE 2 END)) AS avg_latency_ms,
  r4(avg(nullif(event_id % 3 * value, 0))) AS lcp_avg, r4(avg(CASE WHEN event_type = 'click' THEN nullif(value, 0) END)) AS inp_avg, r4(avg(event_id % 2)) AS cls_avg,
  r4(avg(nullif(value, 0))) AS fcp_avg, CAST(NULL AS DOUBLE) AS ttfb_avg FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 100)""")
def frontend(spark, sf_dir):
    return requests.frontend_metrics(adapters.frontend_payloads(spark, sf_dir))


PARSED = """
SELECT CASE event_type WHEN 'click' THEN 'json' WHEN 'view' THEN 'task' WHEN 'error' THEN 'plain' ELSE 'text' END AS shape,
  CASE WHEN event_type IN ('click', 'view') THEN 'INFO' WHEN event_type = 'error' THEN 'ERROR' END AS level, 'user ' || user_id || ' did ' || event_type AS log_message,
  CASE WHEN event_type = 'view' THEN 'flow.py' END AS source_file, CASE WHEN event_type = 'view' THEN 'load' END AS task,
  CASE WHEN event_type = 'click' THEN 'api' END AS logger, CASE WHEN event_type = 'click' THEN 'events' END AS module, CASE WHEN event_type = 'click' THEN 'record' END AS function,
  CASE WHEN event_type = 'click' THEN CAST(event_id % 90 AS VARCHAR) END AS line,
  CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.123000' WHEN 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000000' END AS event_time,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN strftime(ts, '%Y-%m-%d') END AS date FROM events"""


@query("t11_parse_logs", PARSED)
def parse_logs(spark, sf_dir):
    return logs.parse(adapters.log_lines(spark, sf_dir)).withColumn("line", F.col("line").cast("string"))


@query("t12_log_records", """
SELECT level, logger, module, function, count(*) AS records FROM (
  SELECT 'INFO' AS level, 'api' AS logger, 'events' AS module, 'record' AS function FROM events WHERE event_type = 'click') GROUP BY ALL""")
def log_records(spark, sf_dir):
    records = adapters.log_lines(spark, sf_dir).select(F.from_json("message", logs.RECORD).alias("r")).where(F.col("r.timestamp").isNotNull())
    return records.groupBy("r.level", "r.logger", "r.module", "r.function").agg(F.count(F.lit(1)).alias("records"))
