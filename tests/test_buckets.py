"""Changes of a table in folders touch only the folders of the changed keys."""

import os

from pyspark.sql import functions as F

from foliospark.operators.etl import INTERACTION_COLUMNS, upsert_reads
from foliospark.session import work_folder
from foliospark.sources import buckets

MARKS = "user_id string, book_id bigint, rating bigint, read_time timestamp"


def world(spark):
    path = f"{work_folder(spark)}/interactions"
    rows = spark.range(300).select(F.concat(F.lit("u"), F.col("id") % 60).alias("user_id"), (F.col("id") % 7).alias("book_id"), F.lit("r").alias("review_id"), F.lit("").alias("date_added"),
                                   F.lit("").alias("date_updated"), F.lit("").alias("read_at"), F.lit("").alias("started_at"), F.lit(False).alias("is_read"), F.lit(1).cast("bigint").alias("rating"),
                                   F.lit("").alias("review_text_incomplete"), F.lit("like").alias("interaction_type")).select(*INTERACTION_COLUMNS)
    buckets.lay_out(rows, path, "user_id", 8)
    return path, rows


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_only_touched_folders_change(spark):
    path, rows = world(spark)
    before = files(path)
    marks = spark.createDataFrame([("u3", 3, 5, None), ("u3", 99, 4, None)], MARKS).withColumn("read_time", F.lit("2024-01-05").cast("timestamp"))
    assert buckets.change(path, marks, upsert_reads, "user_id", 8) == 1
    after = files(path)
    changed = {f.split("/")[-2] for f in before.keys() ^ after.keys()}
    assert len(changed) == 1 and len({f.split("/")[-2] for f in before}) > 4
    got, want = buckets.read(spark, path).select(*INTERACTION_COLUMNS), upsert_reads(rows, marks).select(*INTERACTION_COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_nothing_to_change(spark):
    path, rows = world(spark)
    before = files(path)
    assert buckets.change(path, spark.createDataFrame([], MARKS), upsert_reads, "user_id", 8) == 0 and files(path) == before
