"""The id ledger: late duplicates, replays, and the folders it reads."""

from pyspark.sql import functions as F

from foliospark.session import work_folder
from foliospark.sources import tables
from foliospark.streaming import ledger

SCHEMA = "event_id string, user_id string, value int"


def stored(spark, path):
    return sorted((r["event_id"] or "", r["value"]) for r in tables.read(spark, f"{path}/rows").collect())


def test_late_duplicates_and_replay(spark):
    path = f"{work_folder(spark)}/ledger"
    sink = ledger.unique_sink(path, buckets=8)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first, second = frame([("a", "u", 1), ("a", "u", 0), ("b", "u", 2), (None, "u", 3), (None, "u", 3)]), frame([("b", "u", 9), ("c", "u", 4)])
    third = frame([("a", "u", 5), ("c", "u", 5), ("d", "u", 6)])
    for number, batch in enumerate((first, second, third)):
        sink(batch, number)
    want = [("", 3), ("", 3), ("a", 0), ("b", 2), ("c", 4), ("d", 6)]
    assert stored(spark, path) == want
    for number, batch in ((1, second), (2, third), (0, first)):  # a batch run again finds what lay there before it
        sink(batch, number)
    assert stored(spark, path) == want
    sink(first.limit(0), 3)
    assert stored(spark, path) == want


def test_untouched_folders_are_not_read(spark):
    path = f"{work_folder(spark)}/ledger"
    ids = spark.range(400).select(F.concat(F.lit("e"), "id").alias("event_id"), F.lit("u").alias("user_id"), F.lit(1).alias("value"))
    ledger.unique_sink(path, buckets=16)(ids, 0)
    plan = ledger.known_ids(spark, path, "event_id", [3, 5], 1)
    scan = next(line for line in plan._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line)
    assert "bucket" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    here = ids.where(ledger.bucket_of("event_id", 16).isin(3, 5)).count()
    assert 0 < here < 100 and plan.count() == here
