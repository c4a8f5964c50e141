"""Tables in folders by a hash of their key, changed by rewriting only the folders that a change touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.sources.tables import stage, writer

BUCKETS = 256
FOLDER = "key_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def lay_out(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write a table in folders by its key; rows with a null key share one."""
    writer(df.withColumn(FOLDER, _bucket(key, buckets)), "overwrite", (FOLDER,)).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(FOLDER)


def change(path: str, source: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], key: str, buckets: int = BUCKETS) -> int:
    """Replace the folders that hold keys of ``source`` by ``merge(rows there, source)``; returns how many. The other folders are neither read nor written.

    ``merge`` must keep rows of the same key together in what it returns: it gives rows of the touched keys and of no others than were there. The result is written aside first, so a failed merge
    leaves the table as it was. Hot keys are no concern here: a folder is rewritten by as many tasks as its size asks for.
    """
    spark = source.sparkSession
    source = stage(source, "source")
    touched = sorted(r[0] for r in source.select(_bucket(key, buckets).alias("b")).distinct().collect())  # at most ``buckets``
    if not touched:
        return 0
    target = spark.read.parquet(path).where(F.col(FOLDER).isin(touched)).drop(FOLDER)
    merged = stage(merge(target, source).withColumn(FOLDER, _bucket(key, buckets)), "merged")
    writer(merged, "overwrite", (FOLDER,)).option("partitionOverwriteMode", "dynamic").parquet(path)
    spark.catalog.refreshByPath(path)
    return len(touched)
