"""Deduplication that outlasts a watermark: a ledger of the ids already stored, in folders by a prefix of their hash.

A micro-batch looks only into the folders of its own ids, as earlier batches left them, so what it stores does not depend on how often it is run: its rows and its ids lie in folders of
the batch, which a replay overwrites. State is on disk and not in the stream's memory, and a duplicate is found however late it comes.

Of equal ids within a batch the smallest row stays. Rows without an id cannot be told apart and all stay. An empty batch stores nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.sources import tables

BUCKETS = 256


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(key), 32), F.lit(buckets)).cast("int")


def known_ids(spark: SparkSession, path: str, key: str, touched: list[int], before: int) -> DataFrame | None:
    """The ids that batches before this one left in the touched folders."""
    if not tables.exists(spark, f"{path}/ids"):
        return None
    ids = spark.read.option("basePath", f"{path}/ids").schema(f"{key} string, batch bigint, bucket int").parquet(f"{path}/ids")
    return ids.where((F.col("batch") < before) & F.col("bucket").isin(touched)).select(key)


def unique_sink(path: str, key: str = "event_id", buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: rows with new ids go to ``rows``, their ids to ``ids``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c != key]
        one = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
        rows = one.withColumn("_bucket", bucket_of(key, buckets)).persist(StorageLevel.DISK_ONLY)  # read for the folders and for the rows
        touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets``
        known = known_ids(batch.sparkSession, path, key, touched, batch_id)
        fresh = rows if known is None else rows.join(known.withColumnRenamed(key, "_known"), F.col(key).cast("string") == F.col("_known"), "left_anti")
        fresh = fresh.drop("_bucket").unionByName(batch.where(F.col(key).isNull()))
        stored = tables.replace(fresh.select(*batch.columns), f"{path}/rows/batch={batch_id}")
        ids = stored.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key), bucket_of(key, buckets).alias("bucket"))
        tables.writer(ids, "overwrite", ("bucket",)).parquet(f"{path}/ids/batch={batch_id}")
        rows.unpersist()

    return write
