"""Sliced error metrics, disparities, findings and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.labels import audit_slices, dimension_rank
from foliospark.settings import CV_ADVICE, CV_HIGH, CV_MEDIUM, HIGH_RISK_FACTOR, MAE_RANGE_LIMIT, SEVERITY_PENALTY


def _melt_cube(cube: DataFrame, by: Sequence[str], slices: Sequence[tuple[str, Column]], measures: Sequence[str]) -> DataFrame:
    entries = [F.struct(F.lit(name).alias("slice_dimension"), F.col(f"_s{i}").cast("string").alias("slice_value"))
               for i, (name, _) in enumerate(slices)]
    melted = cube.select(*by, *measures, F.inline(F.array(*entries))).where(F.col("slice_value").isNotNull())
    return melted.groupBy(*by, "slice_dimension", "slice_value").agg(*[F.sum(m).alias(m) for m in measures])


def slice_metrics(predictions: DataFrame, slices: Sequence[tuple[str, Column]] | None = None,
                  by: Sequence[str] = ()) -> DataFrame:
    """Error metrics of every slice of every dimension, in one pass over the predictions.

    The rows are first summed over the combinations of slice values, which number a few thousand at most;
    only those sums are spread over the dimensions. ``by`` audits several models at once.
    """
    slices = audit_slices() if slices is None else slices
    a, p = F.col("actual_rating"), F.col("predicted_rating")
    rows = predictions.where(a.isNotNull() & p.isNotNull()).select(
        *by, *[expr.alias(f"_s{i}") for i, (_, expr) in enumerate(slices)], a.alias("_a"), p.alias("_p"), (a - p).alias("_e"))
    cube = rows.groupBy(*by, *[f"_s{i}" for i in range(len(slices))]).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs("_e")).alias("abs_sum"), F.sum("_e").alias("err_sum"),
        F.sum(F.col("_e") * F.col("_e")).alias("sq_sum"), F.sum("_p").alias("pred_sum"), F.sum("_a").alias("actual_sum"))
    m = _melt_cube(cube, by, slices, ["n", "abs_sum", "err_sum", "sq_sum", "pred_sum", "actual_sum"])
    n = F.col("n")
    spread = F.greatest(F.col("sq_sum") - F.col("err_sum") * F.col("err_sum") / n, F.lit(0.0))
    return m.select(
        *by, F.concat_ws("=", "slice_dimension", "slice_value").alias("slice_name"), "slice_dimension", "slice_value",
        n.alias("count"), (F.col("abs_sum") / n).alias("mae"), F.sqrt(F.col("sq_sum") / n).alias("rmse"),
        (F.col("pred_sum") / n).alias("mean_predicted"), (F.col("actual_sum") / n).alias("mean_actual"),
        (F.col("err_sum") / n).alias("mean_error"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).otherwise(F.lit(0.0)).alias("std_error"))


def labelled_metrics(metrics: DataFrame, model_name: str, dataset: str, analysed_at: Column) -> DataFrame:
    """Slice metrics in the stored 13-column layout."""
    return metrics.select(
        "slice_name", "slice_dimension", "slice_value", "count", "mae", "rmse", "mean_predicted", "mean_actual", "mean_error",
        "std_error", F.lit(model_name).alias("model_name"), F.lit(dataset).alias("dataset"), analysed_at.alias("analysis_timestamp"))


def _cv(name: str) -> Column:
    mean = F.avg(name)
    return F.when(mean > 0, F.stddev_pop(name) / mean).otherwise(F.lit(0.0))


def disparities(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Spread of the errors within each dimension that has at least two slices. Ties fall to the smaller slice value."""
    worst = F.min_by("slice_value", F.struct((-F.col("mae")).alias("m"), "slice_value"))
    best = F.min_by("slice_value", F.struct(F.col("mae").alias("m"), "slice_value"))
    return metrics.groupBy(*by, "slice_dimension").agg(
        (F.max("mae") - F.min("mae")).alias("mae_range"), (F.max("rmse") - F.min("rmse")).alias("rmse_range"),
        _cv("mae").alias("mae_cv"), _cv("rmse").alias("rmse_cv"), F.count(F.lit(1)).alias("num_slices"),
        worst.alias("max_mae_slice"), best.alias("min_mae_slice"),
    ).where(F.col("num_slices") >= 2)


def flagged(summary: DataFrame) -> DataFrame:
    """Dimensions whose disparity is too large, with severity."""
    hit = summary.where((F.col("mae_cv") > CV_MEDIUM) | (F.col("mae_range") > MAE_RANGE_LIMIT))
    return hit.withColumns({
        "severity": F.when(F.col("mae_cv") > CV_HIGH, "high").otherwise("medium"),
        "recommendation": F.concat("slice_dimension", F.lit(": the errors of its slices differ by more than the limit")),
    }).drop("rmse_cv", "rmse_range", "num_slices", "max_mae_slice", "min_mae_slice")


def high_risk(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Slices whose MAE is well above their dimension's mean. Works on the few slice rows."""
    whole = Window.partitionBy(*by, "slice_dimension")
    scored = metrics.withColumns({"_mean": F.avg("mae").over(whole), "_slices": F.count(F.lit(1)).over(whole)})
    return scored.where((F.col("_slices") >= 2) & (F.col("mae") > F.col("_mean") * HIGH_RISK_FACTOR)).select(
        *by, F.col("slice_name").alias("slice"), "slice_dimension", "slice_value", "mae",
        ((F.col("mae") - F.col("_mean")) / F.col("_mean") * 100).alias("mae_deviation_pct"), "count")


def top_risks(risks: DataFrame, k: int = 3) -> DataFrame:
    return risks.orderBy(F.desc("mae_deviation_pct"), "slice").limit(k)


def _joined(items: Column, sep: str = ", ") -> Column:
    """Texts of an array of (order, text) structs, in order."""
    return F.array_join(F.transform(F.sort_array(items), lambda x: x["text"]), sep)


def recommendations(summary: DataFrame, flags: DataFrame, risks: DataFrame) -> DataFrame:
    """Advice lines in order of urgency; all inputs are report-sized."""
    def severity_line(level: str, order: int, wording: str) -> DataFrame:
        names = F.collect_list(F.struct(dimension_rank(F.col("slice_dimension")).alias("o"), F.col("slice_dimension").alias("text")))
        found = flags.where(F.col("severity") == level).agg(F.count(F.lit(1)).alias("n"), _joined(names).alias("names"))
        text = F.concat(F.lit(f"{level.upper()} PRIORITY: "), F.col("n").cast("string"), F.lit(f" of the dimensions are {wording}: "), "names")
        return found.where(F.col("n") > 0).select(F.lit(order).alias("position"), F.lit("").alias("detail"), text.alias("recommendation"))

    worst = top_risks(risks).agg(F.count(F.lit(1)).alias("n"), _joined(F.collect_list(F.struct(
        (-F.col("mae_deviation_pct")).alias("o"), "slice", F.format_string("%s (MAE: %.3f)", "slice", "mae").alias("text")))).alias("names"))
    target = worst.where(F.col("n") > 0).select(
        F.lit(3).alias("position"), F.lit("").alias("detail"),
        F.concat(F.lit("Target these high-error slices: "), "names").alias("recommendation"))
    advice = summary.where(F.col("mae_cv") > CV_ADVICE).select(
        (F.lit(10) + dimension_rank(F.col("slice_dimension"))).cast("int").alias("position"), F.col("slice_dimension").alias("detail"),
        F.concat("slice_dimension", F.lit(": even out the weights of its "), F.col("num_slices").cast("string"), F.lit(" slices in training")).alias("recommendation"))
    lines = (severity_line("high", 1, "far over the limit")
             .unionByName(severity_line("medium", 2, "over the limit")).unionByName(target).unionByName(advice))
    count = lines.agg(F.count(F.lit(1)).alias("n"))
    nothing = count.where(F.col("n") == 0).select(
        F.lit(99).alias("position"), F.lit("").alias("detail"),
        F.lit("No significant bias detected across analyzed dimensions.").alias("recommendation"))
    return lines.unionByName(nothing).select("position", "recommendation")


def fairness_score(flags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """100 less a penalty per flagged dimension, not below 0. Models without flags have no row here."""
    high, medium = F.count_if(F.col("severity") == "high"), F.count_if(F.col("severity") == "medium")
    return flags.groupBy(*by).agg(
        F.greatest(F.lit(0), 100 - high * SEVERITY_PENALTY["high"] - medium * SEVERITY_PENALTY["medium"]).alias("fairness_score"),
        F.count(F.lit(1)).alias("disparities_count"), high.alias("high_severity_count"))


def heatmap(summary: DataFrame) -> DataFrame:
    return summary.select("slice_dimension", "mae_range", "mae_cv", "rmse_range", "rmse_cv", "num_slices")


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """MAE of each slice before and after mitigation; slices pair up by name."""
    a = after.select("slice_dimension", "slice_value", F.col("mae").alias("mae_after"))
    joined = before.select("slice_dimension", "slice_value", F.col("mae").alias("mae_before")).join(a, ["slice_dimension", "slice_value"])
    change = F.when(F.col("mae_before") > 0, (F.col("mae_before") - F.col("mae_after")) / F.col("mae_before") * 100).otherwise(F.lit(0.0))
    return joined.withColumn("improvement_pct", change)


def scorecard(summary: DataFrame, flags: DataFrame, risks: DataFrame, advice: DataFrame) -> DataFrame:
    """Rows of the fairness scorecard: the score, six dimensions, six risky slices, five recommendations."""
    cv = F.col("mae_cv")
    none = F.lit(None).cast("double")
    score = fairness_score(flags).select(
        F.lit("score").alias("section"), F.lit(1).alias("position"), F.lit("Fairness Score").alias("label"),
        F.col("fairness_score").cast("double").alias("value"), F.lit("").alias("band"))
    dims = summary.orderBy(dimension_rank(F.col("slice_dimension"))).limit(6).select(
        F.lit("dimension").alias("section"), dimension_rank(F.col("slice_dimension")).cast("int").alias("position"),
        F.col("slice_dimension").alias("label"), cv.alias("value"),
        F.when(cv > CV_HIGH, "red").when(cv > CV_MEDIUM, "orange").otherwise("green").alias("band"))
    rank = dimension_rank(F.col("slice_dimension"))
    risky = risks.orderBy(rank, "slice_value").limit(6).select(
        F.lit("high_risk").alias("section"), rank.cast("int").alias("position"), F.col("slice_value").alias("label"),
        F.col("mae").alias("value"), F.lit("red").alias("band"))
    lines = advice.orderBy("position").limit(5).select(
        F.lit("recommendation").alias("section"), F.col("position").cast("int").alias("position"), F.col("recommendation").alias("label"),
        none.alias("value"), F.lit("").alias("band"))
    return score.unionByName(dims).unionByName(risky).unionByName(lines)
