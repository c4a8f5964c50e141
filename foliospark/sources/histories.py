"""Schemas and set-up of the event table and the monitoring histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.sources import tables

EVENTS = ("event_id string not null, user_id string not null, book_id bigint not null, book_title string, "
          "event_type string not null, event_timestamp timestamp not null")
METRICS = ("timestamp timestamp, model_name string, model_version string, metric_name string, "
           "metric_value double, predictions_count bigint, evaluation_dataset string")
DRIFT = ("timestamp timestamp, feature_name string, baseline_mean double, baseline_std double, "
         "current_mean double, current_std double, ks_statistic double, ks_pvalue double, "
         "psi_score double, drift_detected boolean")


def set_up(spark: SparkSession, root: str) -> DataFrame:
    """Create the event table and both histories, each partitioned by day, when they are missing."""
    wanted = {"user_events": EVENTS, "model_metrics_history": METRICS, "data_drift_history": DRIFT}
    rows = [(name, tables.create_if_missing(spark, f"{root}/{name}", f"{schema}, date date", ["date"]))
            for name, schema in wanted.items()]
    return spark.createDataFrame(rows, "table_name string, created boolean")


def append_dated(df: DataFrame, path: str, time_column: str) -> DataFrame:
    """Append rows to a day-partitioned table."""
    return tables.append(df.withColumn("date", F.to_date(time_column)), path, ["date"])


def read_since(spark: SparkSession, path: str, time_column: str, since) -> DataFrame:
    """Rows at or after an instant; the day filter prunes partitions, the time filter cuts the first day."""
    df = tables.read(spark, path)
    return df.where((F.col("date") >= F.to_date(F.lit(since))) & (F.col(time_column) >= F.lit(since)))
