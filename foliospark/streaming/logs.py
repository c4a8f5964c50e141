"""Streaming log parsing with a quarantine for lines in no known shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators.logs import parse
from foliospark.streaming import sinks


def ingest(lines: DataFrame, path: str, work: str) -> None:
    """Parsed lines go to ``path/parsed``, one day per partition; the others to ``path/quarantine``."""
    known = sinks.batch_folder(f"{path}/parsed", ("date",))
    unknown = sinks.batch_folder(f"{path}/quarantine")

    def write(batch: DataFrame, batch_id: int) -> None:
        known(batch.where(F.col("event_time").isNotNull()), batch_id)
        unknown(batch.where(F.col("event_time").isNull()).drop("date"), batch_id)

    sinks.run(parse(lines), f"{work}/checkpoint", write)
