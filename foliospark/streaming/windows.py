"""Windowed aggregates over event and request streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators.monitoring import ctr_verdict


def hourly_clicks(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Views and clicks per user and hour; closed hours leave the state after the delay.

    Sliding windows are put together from these rows afterwards: each event is counted in one state row, not in
    one per window that covers it.
    """
    kind = F.col("event_type")
    return events.withWatermark("event_timestamp", delay).groupBy(F.window("event_timestamp", "1 hour").alias("_w"), "user_id").agg(
        F.count_if(kind == "view").alias("user_views"), F.count_if(kind == "click").alias("user_clicks"),
    ).select(F.col("_w.start").alias("hour"), "user_id", "user_views", "user_clicks")


def sliding_clicks(hourly: DataFrame, hours: int = 24) -> DataFrame:
    """Counts per user in every window of ``hours`` that ends on a full hour."""
    ends = F.transform(F.sequence(F.lit(1), F.lit(hours)), lambda k: F.col("hour") + F.make_dt_interval(hours=k))
    spread = hourly.select("user_id", "user_views", "user_clicks", F.explode(ends).alias("window_end"))
    return spread.groupBy("window_end", "user_id").agg(F.sum("user_views").alias("user_views"), F.sum("user_clicks").alias("user_clicks"))


def window_verdicts(per_user: DataFrame) -> DataFrame:
    return ctr_verdict(per_user, by=["window_end"])


def minute_timeline(requests: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Requests, errors and mean latency per minute."""
    return requests.withWatermark("ts", delay).groupBy(F.window("ts", "1 minute").alias("_w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status_code") >= 400).alias("errors"),
        F.avg("latency_ms").alias("avg_latency"),
    ).select(F.col("_w.start").alias("minute"), "requests", "errors", "avg_latency")
