"""Shrinkage, reweighting and group offsets, and how much they help."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import stage
from foliospark.functions.labels import feature_slices
from foliospark.functions.numbers import percent_change
from foliospark.functions.text import slug
from foliospark.operators.bias import _melt_cube

GAP = "user_avg_rating_vs_book"


def group_metrics(features: DataFrame, group: Column, value: str = GAP) -> DataFrame:
    """Count, mean and sample deviation of the rating gap per group."""
    return features.select(group.cast("string").alias("slice_group"), F.col(value).alias("_v")).where(
        F.col("slice_group").isNotNull()).groupBy("slice_group").agg(
        F.count(F.lit(1)).alias("count"), F.avg("_v").alias("mean_rating"),
        F.coalesce(F.stddev_samp("_v"), F.lit(0.0)).alias("std_rating"))


def bounded(groups: DataFrame, most: int = 100_000) -> DataFrame:
    """A table with a row per group, staged and counted: sent to all tasks when small, as the fact table has few groups and a shuffle would
    gather each in one task. A larger one is left to the optimizer.
    """
    groups = stage(groups, "groups")
    return F.broadcast(groups) if groups.limit(most + 1).count() <= most else groups


def shrink(features: DataFrame, dimension: str, group: Column, strength: float = 0.5) -> DataFrame:
    """Pull each group's mean rating gap towards the global mean; rows without a group drop out."""
    label = f"{slug(dimension)}_group"
    base = features.withColumn(label, group)
    means = base.groupBy(label).agg(F.avg(GAP).alias("group_mean"))
    overall = base.agg(F.avg(GAP).alias("global_mean"))
    pull = strength * (F.col("group_mean") - F.col("global_mean"))
    return base.join(bounded(means), label).crossJoin(F.broadcast(overall)).withColumns({
        "rating_debiased": F.col(GAP) - pull, "rating_debiased_predicted": F.col("rating") - pull,
    }).select(*features.columns, "group_mean", "global_mean", "rating_debiased", "rating_debiased_predicted", label)


def reweight(training: DataFrame, dimension: str, group: Column, strategy: str = "inverse_propensity") -> DataFrame:
    """Give each row the weight of its group: inverse share, or equal total weight per group."""
    if strategy not in ("inverse_propensity", "balanced"):
        raise ValueError(f"unknown strategy {strategy}")
    label = f"{slug(dimension)}_group"
    base = training.withColumn(label, group)
    counts = base.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.sum("_n").alias("_all"), F.count(label).alias("_groups"))
    n, total = F.col("_n").cast("double"), F.col("_all").cast("double")
    weight = 1.0 / (n / total) if strategy == "inverse_propensity" else (total / F.col("_groups")) / n
    return base.join(bounded(counts), label).crossJoin(F.broadcast(totals)).select(*training.columns, label, weight.alias("sample_weight"))


def weight_stats(weighted: DataFrame) -> DataFrame:
    w = "sample_weight"
    return weighted.agg(F.min(w).alias("min_weight"), F.max(w).alias("max_weight"), F.avg(w).alias("mean_weight"),
                        F.stddev_samp(w).alias("std_weight"))


def group_offsets(predictions: DataFrame, group: Column) -> DataFrame:
    """Mean error per group: the shift that centres the group's predictions."""
    a, p = F.col("actual_rating"), F.col("predicted_rating")
    return predictions.select(group.cast("string").alias("slice_group"), (a - p).alias("_e")).where(
        F.col("slice_group").isNotNull() & F.col("_e").isNotNull()).groupBy("slice_group").agg(F.avg("_e").alias("offset"))


def apply_offsets(predictions: DataFrame, dimension: str, group: Column, offsets: DataFrame | None = None) -> DataFrame:
    """Shift predictions by their group's offset; rows of other groups stay as they are."""
    offsets = group_offsets(predictions, group) if offsets is None else offsets
    label = f"{slug(dimension)}_group"
    based = predictions.withColumn(label, group.cast("string"))
    joined = based.join(bounded(offsets.withColumnRenamed("slice_group", label)), label, "left")
    rest = [c for c in predictions.columns if c != "predicted_rating"]
    return joined.select(*rest, label, F.col("predicted_rating").alias("original_predicted_rating"),
                         (F.col("predicted_rating") + F.coalesce("offset", F.lit(0.0))).alias("predicted_rating"))


def shrink_predictions(predictions: DataFrame, group: str = "book_era", strength: float = 0.3, by: Sequence[str] = ()) -> DataFrame:
    """Shrink predictions towards the global mean by group and recompute the errors; rows without a group keep theirs."""
    group_keys = [*by, group]
    means = predictions.where(F.col(group).isNotNull()).groupBy(*group_keys).agg(F.avg("predicted_rating").alias("_group_mean"))
    overall = predictions.groupBy(*by).agg(F.avg("predicted_rating").alias("_global_mean"))
    rated = predictions.where(F.col("actual_rating").isNotNull()).join(bounded(means), group_keys, "left")
    rated = rated.join(bounded(overall), list(by)) if by else rated.crossJoin(F.broadcast(overall))
    shifted = F.col("predicted_rating") - F.coalesce(strength * (F.col("_group_mean") - F.col("_global_mean")), F.lit(0.0))
    rest = [c for c in predictions.columns if c not in ("predicted_rating", "absolute_error", "error")]
    return rated.withColumn("_new", shifted).select(
        *rest, F.col("predicted_rating").alias("original_predicted_rating"), F.col("_new").alias("predicted_rating"),
        F.abs(F.col("actual_rating") - F.col("_new")).alias("absolute_error"), (F.col("actual_rating") - F.col("_new")).alias("error"))


def variance_reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """Percent drop of the variance of the group means."""
    b = before.agg(F.var_pop("mean_rating").alias("variance_before"))
    a = after.agg(F.var_pop("mean_rating").alias("variance_after"))
    return b.crossJoin(F.broadcast(a)).withColumn(
        "variance_reduction_pct", percent_change(F.col("variance_before"), F.col("variance_after")))


def error_improvement(before: DataFrame, after: DataFrame) -> DataFrame:
    """Percent drop of MAE and RMSE between two one-row metric tables."""
    b = before.select(F.col("mae").alias("mae_before"), F.col("rmse").alias("rmse_before"))
    a = after.select(F.col("mae").alias("mae_after"), F.col("rmse").alias("rmse_after"))
    return b.crossJoin(F.broadcast(a)).withColumns({
        "mae_improvement_pct": percent_change(F.col("mae_before"), F.col("mae_after")),
        "rmse_improvement_pct": percent_change(F.col("rmse_before"), F.col("rmse_after"))})


def grouped_means(features: DataFrame, slices: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """Mean rating gap and share read of every group of every dimension, in one pass over the features.

    A row without a group still counts towards the global mean, which comes along as a column.
    """
    slices = feature_slices() if slices is None else slices
    cube = features.groupBy(*[expr.alias(f"_s{i}") for i, (_, expr) in enumerate(slices)]).agg(
        F.count(GAP).alias("n"), F.sum(GAP).alias("gap_sum"), F.count(F.lit(1)).alias("rows"), F.count_if("is_read").alias("reads"))
    melted = _melt_cube(cube, [], slices, ["n", "gap_sum", "rows", "reads"])
    return melted.select("slice_dimension", "slice_value", (F.col("gap_sum") / F.col("n")).alias("avg_rating"),
                         (F.col("reads") / F.col("rows")).alias("pct_read"), F.col("rows").alias("row_count"), "n", "gap_sum")


def debiased_means(groups: DataFrame, strength: float = 0.5) -> DataFrame:
    """Group means after shrinkage towards each dimension's own mean.

    Shrinkage shifts a whole group by one constant, so the mean of the shifted rows is the shifted mean.
    """
    overall = groups.groupBy("slice_dimension").agg((F.sum("gap_sum") / F.sum("n")).alias("global_mean"))
    return groups.join(overall, "slice_dimension").withColumn(
        "avg_rating_after", F.col("avg_rating") - strength * (F.col("avg_rating") - F.col("global_mean")))


def equity(groups: DataFrame) -> DataFrame:
    """Fairness figures per dimension from the group means before and after."""
    eps = 1e-9
    stats = groups.groupBy("slice_dimension").agg(
        F.var_pop("avg_rating").alias("variance_before"), F.var_pop("avg_rating_after").alias("variance_after"),
        F.avg("avg_rating").alias("mean_before"), F.avg("avg_rating_after").alias("mean_after"))
    change = (F.col("mean_after") - F.col("mean_before")) / (F.abs("mean_before") + eps)
    ratio = F.col("variance_after") / (F.col("variance_before") + eps)
    mean_penalty = F.least(F.lit(1.0), F.abs("relative_mean_change"))
    variance_penalty = F.when(F.col("variance_ratio") <= 0, 1.0).otherwise(
        1.0 - 1.0 / (1.0 + F.abs(F.ln(F.col("variance_ratio") + eps))))
    return stats.withColumns({"relative_mean_change": change, "variance_ratio": ratio}).withColumn(
        "equity_index", F.greatest(F.lit(0.0), 1.0 - 0.5 * mean_penalty - 0.5 * variance_penalty))
