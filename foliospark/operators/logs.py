"""Parsing of service log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The JSON log record that services write.
RECORD = ("timestamp string, level string, logger string, message string, module string, "
          "`function` string, line bigint, exception string")
_TIME = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:[.,]\d+)?(?:Z|[+-]\d{2}:?\d{2})?"
_LEVEL = r"[A-Z]+"
_TASK_LINE = rf"^\[({_TIME})\] \{{([^:}}]*):([^}}]*)\}} ({_LEVEL}) - (.*)$"
_PLAIN_LINE = rf"^\[({_TIME})\] ({_LEVEL}) - (.*)$"


def log_time(text: Column) -> Column:
    """ISO 8601, or the two plain forms with and without milliseconds."""
    return F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss,SSS")),
                      F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def parse(lines: DataFrame) -> DataFrame:
    """Turn the ``message`` text into columns. A line in no known shape keeps its text and has no time."""
    m = F.col("message")
    is_json = m.rlike(r"^\{.*\}$")
    parsed = lines.select(m, F.when(is_json, F.from_json(m, RECORD)).alias("j"), m.rlike(_TASK_LINE).alias("t"), m.rlike(_PLAIN_LINE).alias("p"))

    def pick(json_field: str | None, task_group: int | None, plain_group: int | None) -> Column:
        out = F.when(F.col("j").isNotNull(), F.col(f"j.{json_field}") if json_field else F.lit(None).cast("string"))
        if task_group:
            out = out.when(F.col("t"), F.regexp_extract(m, _TASK_LINE, task_group))
        if plain_group:
            out = out.when(F.col("p"), F.regexp_extract(m, _PLAIN_LINE, plain_group))
        return out

    shape = F.when(F.col("j").isNotNull(), "json").when(F.col("t"), "task").when(F.col("p"), "plain").otherwise("text")
    out = parsed.select(
        shape.alias("shape"), pick("timestamp", 1, 1).alias("_time"), pick("level", 4, 2).alias("level"),
        F.coalesce(pick("message", 5, 3), m).alias("log_message"), pick(None, 2, None).alias("source_file"), pick(None, 3, None).alias("task"),
        F.col("j.logger").alias("logger"), F.col("j.module").alias("module"), F.col("j.function").alias("function"), F.col("j.line").alias("line"))
    return out.withColumn("event_time", log_time(F.col("_time"))).withColumn("date", F.to_date("event_time")).drop("_time")
