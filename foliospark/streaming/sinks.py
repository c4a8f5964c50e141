"""Sinks that survive a replayed micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.sources import tables


def run(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything available now, then stop."""
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(on_batch).start())
    query.awaitTermination()


def batch_folder(path: str, partition_by: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    """Each micro-batch owns one folder and overwrites it, so a replay writes the same rows once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        tables.writer(batch, "overwrite", partition_by).parquet(f"{path}/batch={batch_id}")

    return write


def newest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Final rows of an update-mode aggregate written by ``batch_folder``: the last batch that touched a key."""
    rows = tables.read(spark, path)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
