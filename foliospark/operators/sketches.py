"""Mergeable day sketches: quantiles and distinct counts of any range of days from one small row per day and key.

A day's rows become a KLL sketch of a value and an HLL sketch of members, with the exact count, sum, minimum and maximum. Days are stored apart; adding a day reads and
writes that day only, and adding it again replaces it. A range merges its days' rows and never the events. A quantile's rank is off by at most ``RANK_ERROR`` (99 of
100 times by less than 0.0133 for k = 200), a distinct count by about 1.6 % (one standard deviation at 2^12 registers); small sets are counted exactly or nearly so.

Null values and members are left out of their sketch and counted in ``n`` all the same; a key whose values are all null has null quantiles. An empty day is stored as no rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KLL_K, HLL_LOG_K = 200, 12
RANK_ERROR = 0.02


def of_days(rows: DataFrame, keys: Sequence[str], value: Column, member: Column, day: Column) -> DataFrame:
    """A row per day and key: ``date``, keys, n, total, low, high, ``value_sketch``, ``member_sketch``."""
    some = rows.select(day.alias("date"), *keys, value.cast("double").alias("_v"), member.cast("string").alias("_m"))
    return some.groupBy("date", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_v").alias("total"), F.min("_v").alias("low"), F.max("_v").alias("high"),
        F.kll_sketch_agg_double("_v", F.lit(KLL_K)).alias("value_sketch"), F.hll_sketch_agg("_m", F.lit(HLL_LOG_K)).alias("member_sketch"))


def add_days(sketches: DataFrame, path: str) -> None:
    """Store the days of ``sketches``, each in place of what is stored of that day; other days keep their files."""
    sketches.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def read_range(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> DataFrame:
    return spark.read.parquet(path).where(F.col("date").between(F.lit(first), F.lit(last)))


def merged(sketches: DataFrame, keys: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """Per key over all days given: n, mean, low, high, distinct members and the quantiles by name."""
    values = F.col("n_values") > 0
    out = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("_total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("value_sketch").alias("_q"), F.hll_sketch_estimate(F.hll_union_agg("member_sketch")).alias("members"))
    out = out.withColumn("n_values", F.kll_sketch_get_n_double("_q"))
    marks = {name: F.when(values, F.kll_sketch_get_quantile_double("_q", F.lit(p))) for name, p in quantiles.items()}
    return out.select(*keys, "n", "n_values", F.when(values, F.col("_total") / F.col("n_values")).alias("mean"), "low", "high", "members", *[c.alias(n) for n, c in marks.items()])


def within_rank(rows: DataFrame, keys: Sequence[str], value: Column, found: DataFrame, quantiles: dict[str, float], error: float = RANK_ERROR) -> DataFrame:
    """Per key ``<name>_within``: whether the share of rows below and up to a found quantile spans its probability, give or take ``error``."""
    counts = []
    for name in quantiles:
        counts += [F.count_if(value.cast("double") < F.col(name)).alias(f"_lt_{name}"), F.count_if(value.cast("double") <= F.col(name)).alias(f"_le_{name}")]
    joined = rows.join(F.broadcast(found), list(keys)) if keys else rows.crossJoin(F.broadcast(found))
    shares = joined.groupBy(*keys).agg(F.count(value).alias("_n"), *counts)
    return shares.select(*keys, *[((F.col(f"_lt_{name}") / F.col("_n") <= p + error) & (F.col(f"_le_{name}") / F.col("_n") >= p - error)).alias(f"{name}_within") for name, p in quantiles.items()])
