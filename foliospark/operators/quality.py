"""Data-quality rules, gates, statistics and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.operators.ordered import exact_percentiles
from foliospark.settings import EVENT_TYPES, MAX_PAGES, MAX_YEAR, MIN_PAGES, MIN_YEAR

Rule = tuple[str, Column]


class QualityError(ValueError):
    """A quality gate failed."""


def _outside(name: str, low: int, high: int) -> Column:
    c = F.col(name)
    return c.isNull() | (c < low) | (c > high)


def source_book_rules() -> list[Rule]:
    return [("null book_id", F.col("book_id").isNull()), ("null title", F.col("title").isNull())]


def cleaned_book_rules() -> list[Rule]:
    return [("null title", F.col("title_clean").isNull()),
            ("publication_year range", _outside("publication_year", MIN_YEAR, MAX_YEAR)),
            ("num_pages range", _outside("num_pages", MIN_PAGES, MAX_PAGES))]


def source_interaction_rules() -> list[Rule]:
    return [(f"null {c}", F.col(c).isNull()) for c in ("user_id", "book_id", "interaction_type")]


def cleaned_interaction_rules() -> list[Rule]:
    kind = F.col("interaction_type_clean")
    return [("null user_id", F.col("user_id_clean").isNull()), ("null book_id", F.col("book_id").isNull()),
            ("rating range", (F.col("rating") < 0) | (F.col("rating") > 5)),
            ("null or view interaction_type", kind.isNull() | (kind == "view"))]


def non_empty(df: DataFrame, dataset: str) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("row_count")).select(F.lit(dataset).alias("dataset"), "row_count",
                                               (F.col("row_count") > 0).alias("passed"))


def rule_report(df: DataFrame, dataset: str, rules: Sequence[Rule], max_allowed: int = 0) -> DataFrame:
    """Violations of every rule, plus the non-empty check, counted in one pass over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(bad).alias(f"_r{i}") for i, (_, bad) in enumerate(rules)])
    entries = [F.struct(F.lit("table is not empty").alias("rule"), F.when(F.col("_rows") == 0, 1).otherwise(0).cast("bigint").alias("violations"))]
    entries += [F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("violations")) for i, (name, _) in enumerate(rules)]
    return counts.select(F.inline(F.array(*entries))).select(
        F.lit(dataset).alias("dataset"), "rule", "violations", (F.col("violations") <= max_allowed).alias("passed"))


def gate(report: DataFrame) -> DataFrame:
    """Raise when any rule failed; the report has one row per rule, so only those few rows are read."""
    failed = [f"{r['dataset']}: {r['rule']} ({r['violations']})" for r in report.where(~F.col("passed")).collect()]
    if failed:
        raise QualityError("; ".join(failed))
    return report


def feature_stats(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("user_id_clean").alias("unique_users"),
        F.count_distinct("book_id").alias("unique_books"),
        F.round(F.avg("num_books_read"), 2).alias("avg_books_per_user"),
        F.round(F.avg("avg_book_reading_time_days"), 2).alias("avg_reading_time_days"),
        F.round(F.avg("num_pages"), 0).alias("avg_pages"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
    )


def stat_alarms(stats: DataFrame) -> DataFrame:
    return stats.select(
        (F.col("total_rows") == 0).alias("no_rows"),
        F.coalesce((F.col("avg_rating") < 1.0) | (F.col("avg_rating") > 5.0), F.lit(False)).alias("rating_out_of_range"),
        (F.col("unique_users") < 1).alias("no_users"),
    )


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, missing share, distinct count and numeric description of each column, one row per column.

    Missing counts and moments come from one pass. Distinct counts read the table as (column, value) pairs, so any
    number of columns needs one shuffle; ``exact=False`` uses a sketch inside the first pass instead.
    Array and struct columns report no distinct count.
    """
    fields = df.schema.fields
    aggregates = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        col = F.col(f.name)
        aggregates.append(F.count_if(col.isNull()).alias(f"_null{i}"))
        if isinstance(f.dataType, T.NumericType):
            x = col.cast("double")
            aggregates += [F.avg(x).alias(f"_avg{i}"), F.stddev_samp(x).alias(f"_std{i}"),
                           F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}")]
        if not exact and isinstance(f.dataType, T.AtomicType):
            aggregates.append(F.approx_count_distinct(col).alias(f"_d{i}"))
    none = F.lit(None).cast("double")
    entries = []
    for i, f in enumerate(fields):
        numeric = isinstance(f.dataType, T.NumericType)
        stats = [(F.col(f"_{s}{i}") if numeric else none).alias(a)
                 for s, a in (("avg", "mean_value"), ("std", "std_value"), ("min", "min_value"), ("max", "max_value"))]
        sketch = F.col(f"_d{i}") if not exact and isinstance(f.dataType, T.AtomicType) else F.lit(None).cast("bigint")
        entries.append(F.struct(
            F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            (F.try_divide(F.col(f"_null{i}") * 100.0, F.col("_n"))).alias("missing_pct"), sketch.alias("_sketch"), *stats))
    profile = df.agg(*aggregates).select(F.inline(F.array(*entries)))
    if not exact:
        return profile.withColumnRenamed("_sketch", "distinct_count")
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).cast("string").alias("_value"))
        for f in fields if isinstance(f.dataType, T.AtomicType)])))
    distinct = pairs.where(F.col("_value").isNotNull()).distinct().groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_count"))
    return profile.drop("_sketch").join(distinct, "column_name", "left")


def histogram(df: DataFrame, value: Column, bins: int, name: str) -> DataFrame:
    """Equal-width bins over the value range; the last bin is closed on the right. Empty bins are not listed."""
    values = df.select(value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    bounds = values.agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    v, low, high = F.col("_v"), F.col("_min"), F.col("_max")
    index = F.when(low == high, F.lit(1)).otherwise(F.least(F.floor((v - low) / (high - low) * bins) + 1, F.lit(bins)))
    return (values.crossJoin(F.broadcast(bounds)).select(index.cast("bigint").alias("bin"), low.alias("_min"), high.alias("_max"))
            .groupBy("bin", "_min", "_max").agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("measure"), "bin", (low + (high - low) / bins * (F.col("bin") - 1)).alias("bin_start"), "row_count"))


def training_stats(train: DataFrame) -> DataFrame:
    """Size, moments and exact quartiles of the ratings."""
    rated = train.where(F.col("rating").isNotNull())
    rating = F.col("rating").cast("double")
    stats = rated.agg(
        F.count_distinct("user_id_clean").alias("num_users"), F.count_distinct("book_id").alias("num_books"),
        F.count(F.lit(1)).alias("num_interactions"), F.avg(rating).alias("avg_rating"),
        F.stddev_samp(rating).alias("std_rating"), F.min(rating).alias("min_rating"), F.max(rating).alias("max_rating"))
    quartiles = exact_percentiles(rated, [], rating, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, method="discrete")
    return stats.crossJoin(F.broadcast(quartiles))


def cold_start(train: DataFrame, few: int = 5) -> DataFrame:
    per_user = train.groupBy("user_id_clean").agg(F.count(F.lit(1)).alias("cnt"))
    return per_user.agg(
        F.count_if(F.col("cnt") < few).alias("users_with_few_ratings"), F.count(F.lit(1)).alias("total_users"),
    ).withColumn("cold_start_ratio", F.try_divide(F.col("users_with_few_ratings").cast("double"), F.col("total_users")))


def valid_event() -> Column:
    required = [F.col(c).isNotNull() for c in ("event_id", "user_id", "book_id", "event_timestamp")]
    ok = F.col("event_type").isin(*EVENT_TYPES)
    for r in required:
        ok = ok & r
    return F.coalesce(ok, F.lit(False))


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) events."""
    return events.where(valid_event()), events.where(~valid_event())


def event_validity(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", valid_event().alias("is_valid")).agg(F.count(F.lit(1)).alias("event_count"))


def scoring_ready(test: DataFrame) -> DataFrame:
    """Does the test split hold rated rows?"""
    return test.agg(F.count_if(F.col("rating").isNotNull()).alias("rated_rows")).withColumn("ready", F.col("rated_rows") > 0)
