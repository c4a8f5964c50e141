"""Request-log statistics and browser metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import masked_path
from foliospark.operators.ordered import exact_percentiles
from foliospark.settings import SLOW_REQUEST_MS



def with_endpoint(requests: DataFrame) -> DataFrame:
    return requests.withColumn("endpoint", F.concat_ws(" ", "method", masked_path(F.col("path"))))


def _is_error() -> Column:
    return F.col("status_code") >= 400


def endpoint_stats(requests: DataFrame, slow_ms: float = SLOW_REQUEST_MS) -> DataFrame:
    """Counts, latencies with exact percentiles, status histogram and last request per endpoint."""
    rows = with_endpoint(requests)
    latency = F.col("latency_ms")
    # Per (endpoint, status) first: the histogram is then built from a handful of rows per endpoint.
    by_status = rows.groupBy("endpoint", "status_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum(latency).alias("s"), F.min(latency).alias("lo"), F.max(latency).alias("hi"),
        F.count_if(latency > slow_ms).alias("slow"), F.max("ts").alias("last"))
    stats = by_status.groupBy("endpoint").agg(
        F.sum("n").alias("request_count"), F.sum(F.when(_is_error(), F.col("n")).otherwise(0)).alias("error_count"),
        (F.sum("s") / F.sum("n")).alias("avg_latency_ms"), F.min("lo").alias("min_latency_ms"), F.max("hi").alias("max_latency_ms"),
        F.sum("slow").alias("slow_requests"), F.max("last").alias("last_request_time"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("status_code", "n"))),
                                 lambda x: F.concat_ws(":", x["status_code"], x["n"])), ",").alias("status_codes"))
    marks = exact_percentiles(rows, ["endpoint"], latency, {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99})
    return stats.join(marks, "endpoint").withColumn("error_rate", F.col("error_count") / F.col("request_count") * 100)


def request_summary(requests: DataFrame) -> DataFrame:
    """Totals over all requests; the rate runs over the span of the log."""
    rows = requests.agg(
        F.count(F.lit(1)).alias("total_requests"), F.count_if(_is_error()).alias("total_errors"), F.avg("latency_ms").alias("avg_latency_ms"),
        F.max(F.unix_micros("ts")).alias("_last"), F.min(F.unix_micros("ts")).alias("_first"))
    marks = exact_percentiles(requests, [], F.col("latency_ms"), {"p95_latency_ms": 0.95, "p99_latency_ms": 0.99})
    minutes = (F.col("_last") - F.col("_first")) / 60e6
    return rows.crossJoin(F.broadcast(marks)).withColumns({
        "error_rate": F.coalesce(F.try_divide(F.col("total_errors") * 100.0, F.col("total_requests")), F.lit(0.0)),
        "requests_per_minute": F.coalesce(F.try_divide(F.col("total_requests").cast("double"), minutes), F.lit(0.0)),
    }).drop("_first", "_last")


def endpoints_by_traffic(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.desc("request_count"), "endpoint")


def timeline(requests: DataFrame, now: dt.datetime | None = None, minutes: int = 5) -> DataFrame:
    """Requests, errors and mean latency per minute; with ``now``, of the last minutes only. Batch and streaming."""
    rows = requests if now is None else requests.where(F.col("ts") > F.lit(now - dt.timedelta(minutes=minutes)))
    return rows.groupBy(F.window("ts", "1 minute").alias("_w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(_is_error()).alias("errors"), F.avg("latency_ms").alias("avg_latency"),
    ).select(F.date_format("_w.start", "yyyy-MM-dd'T'HH:mm").alias("time"), "requests", "errors", "avg_latency")


def recent_errors(requests: DataFrame, kept: int = 100, shown: int = 10) -> DataFrame:
    """The last errors: a bounded list of ``kept``, of which the newest ``shown`` are reported."""
    rows = with_endpoint(requests).where(_is_error())
    newest = rows.orderBy(F.desc("ts"), "endpoint", "latency_ms").limit(min(kept, shown))
    return newest.select("ts", "endpoint", "status_code", "latency_ms", "error_message")


PAYLOAD = ("sessionId string, metrics struct<apiCalls: array<struct<latency: double>>, errors: array<string>, "
           "webVitals: struct<lcp: double, inp: double, cls: double, fcp: double, ttfb: double>>")


def frontend_metrics(payloads: DataFrame, last: int = 100) -> DataFrame:
    """Distinct sessions over all payloads; call, error and web-vital figures over the last ones.

    A vital of zero means "not measured", except for layout shift.
    """
    parsed = payloads.select("event_id", "received_at", F.from_json("payload", PAYLOAD).alias("p"))
    sessions = parsed.agg(F.count_distinct("p.sessionId").alias("sessions"))
    recent = parsed.orderBy(F.desc("received_at"), F.desc("event_id")).limit(last).select("p.metrics.*")
    calls = F.coalesce("apiCalls", F.array().cast("array<struct<latency:double>>"))
    known = F.filter(F.transform(calls, lambda c: c["latency"]), lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda s, x: s + x)

    def vital(name: str) -> Column:
        v = F.col(f"webVitals.{name}")
        return F.avg(v if name == "cls" else F.nullif(v, F.lit(0.0))).alias(f"{name}_avg")

    sums = recent.agg(
        F.sum(F.size(calls)).alias("total_api_calls"), F.sum(F.size(F.coalesce("errors", F.array().cast("array<string>")))).alias("total_errors"),
        F.coalesce(F.try_divide(F.sum(total), F.sum(F.size(known))), F.lit(0.0)).alias("avg_latency_ms"),
        *[vital(v) for v in ("lcp", "inp", "cls", "fcp", "ttfb")])
    return sessions.crossJoin(F.broadcast(sums))
