"""Metric history, decay, drift and alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.numbers import share, steady_avg
from foliospark.operators.ordered import running_totals
from foliospark.settings import (
    CTR_THRESHOLD, DECAY_R2_DROP, DECAY_RMSE_PCT, DRIFT_KS_P, DRIFT_MEAN_SHIFT, DRIFT_PSI, PSI_BINS,
    PSI_EMPTY_SHARE, STD_FLOOR,
)

METRIC_NAMES = ["mae", "rmse", "r_squared", "correlation", "accuracy_within_0_5", "accuracy_within_1_0"]


def metric_rows(metrics: DataFrame, logged_at: Column, version: str, dataset: str) -> DataFrame:
    """Wide metric rows (with ``model_name``) to history rows, one per metric; the count repeats on each."""
    return metrics.unpivot(["model_name", "num_predictions"], METRIC_NAMES, "metric_name", "metric_value").select(
        logged_at.alias("timestamp"), "model_name", F.lit(version).alias("model_version"), "metric_name", "metric_value",
        F.col("num_predictions").alias("predictions_count"), F.lit(dataset).alias("evaluation_dataset"))


def metric_history(history: DataFrame, now: dt.datetime, days: int = 30, limit: int = 500) -> DataFrame:
    """Daily average, minimum and maximum per model and metric, most recent day first."""
    recent = history.where(F.col("timestamp") >= F.lit(now - dt.timedelta(days=days)))
    v = "metric_value"
    return recent.groupBy(F.to_date("timestamp").alias("date"), "model_name", "metric_name").agg(
        steady_avg(F.col(v)).alias("avg_value"), F.min(v).alias("min_value"), F.max(v).alias("max_value"),
    ).orderBy(F.desc("date"), "model_name", "metric_name").limit(limit)


def latest_metrics(history: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    recent = history.where(F.col("timestamp") >= F.lit(now - dt.timedelta(days=days)))
    return recent.groupBy("model_name", "metric_name").agg(F.max(F.struct("timestamp", "metric_value")).alias("_m")).select(
        "model_name", "metric_name", F.round("_m.metric_value", 4).alias("metric_value"), F.col("_m.timestamp").alias("timestamp"))


def drift_history(history: DataFrame, now: dt.datetime, days: int = 7, limit: int = 500) -> DataFrame:
    return history.where(F.col("timestamp") >= F.lit(now - dt.timedelta(days=days))).select(
        "timestamp", "feature_name", "baseline_mean", "current_mean", "ks_pvalue", "psi_score", "drift_detected",
    ).orderBy(F.desc("timestamp"), "feature_name").limit(limit)


def window_stats(history: DataFrame, now: dt.datetime, lookback: int = 30, window: int = 7) -> DataFrame:
    """Mean and deviation of each metric in the baseline and the recent span, in one pass. The spans share their border."""
    oldest, border = F.lit(now - dt.timedelta(days=lookback)), F.lit(now - dt.timedelta(days=window))
    ts, v = F.col("timestamp"), F.col("metric_value")
    base, recent = F.when(ts.between(oldest, border), v), F.when(ts >= border, v)
    return history.where(ts >= oldest).groupBy("model_name", "metric_name").agg(
        F.avg(base).alias("baseline_avg"), F.stddev_samp(base).alias("baseline_std"),
        F.avg(recent).alias("recent_avg"), F.stddev_samp(recent).alias("recent_std"))


def model_decay(stats: DataFrame) -> DataFrame:
    """Per model: RMSE rise in percent, R2 drop, and whether either passes its limit. A side without data decides nothing."""
    def of(metric: str, column: str) -> Column:
        return F.max(F.when(F.col("metric_name") == metric, F.col(column)))

    wide = stats.groupBy("model_name").agg(
        of("rmse", "baseline_avg").alias("baseline_rmse"), of("rmse", "recent_avg").alias("recent_rmse"),
        of("r_squared", "baseline_avg").alias("baseline_r_squared"), of("r_squared", "recent_avg").alias("recent_r_squared"),
        F.count("baseline_avg").alias("_b"), F.count("recent_avg").alias("_r"))
    rise = (F.col("recent_rmse") - F.col("baseline_rmse")) / F.col("baseline_rmse") * 100
    drop = F.col("baseline_r_squared") - F.col("recent_r_squared")
    enough = (F.col("_b") > 0) & (F.col("_r") > 0)
    rmse_hit, r2_hit = F.coalesce(rise > DECAY_RMSE_PCT, F.lit(False)), F.coalesce(drop > DECAY_R2_DROP, F.lit(False))
    return wide.select(
        "model_name", "baseline_rmse", "recent_rmse", rise.alias("rmse_change_pct"), "baseline_r_squared", "recent_r_squared",
        drop.alias("r_squared_drop"), (enough & (rmse_hit | r2_hit)).alias("decay_detected"),
        F.when(~enough, "insufficient_data").otherwise("compared").alias("reason"))


def click_through(events: DataFrame, now: dt.datetime, hours: int = 24, threshold: float = CTR_THRESHOLD) -> DataFrame:
    """Mean per-user click-through over the trailing hours and the decay verdict, one row.

    Users without clicks are left out; users without views count as users but not in the mean. No data passes.
    """
    recent = events.where(F.col("event_timestamp") >= F.lit(now - dt.timedelta(hours=hours)))
    return ctr_verdict(user_clicks(recent), threshold)


def user_clicks(events: DataFrame, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    kind = F.col("event_type")
    return events.groupBy(*keys).agg(F.count_if(kind == "view").alias("user_views"), F.count_if(kind == "click").alias("user_clicks"))


def ctr_verdict(per_user: DataFrame, threshold: float = CTR_THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    ctr = share(F.col("user_clicks"), F.col("user_views"))
    out = per_user.where(F.col("user_clicks") > 0).groupBy(*by).agg(
        F.avg(ctr).alias("avg_ctr"), F.count(F.lit(1)).alias("distinct_users_counted"))
    verdict = F.when(F.col("avg_ctr").isNull() | (F.col("avg_ctr") == 0), "no_data").when(F.col("avg_ctr") < threshold, "decay").otherwise("healthy")
    return out.withColumn("status", verdict)


def _melt(df: DataFrame, features: Sequence[str], side: int) -> DataFrame:
    unknown = [f for f in features if f not in df.columns]
    if unknown:
        raise ValueError(f"unknown drift features: {', '.join(unknown)}")
    pairs = F.array(*[F.struct(F.lit(f).alias("feature_name"), F.col(f).cast("double").alias("value")) for f in features])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).withColumn("side", F.lit(side))


def value_counts(baseline: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Occurrences of every distinct value of every feature on both sides: what all drift figures are made from."""
    both = _melt(baseline, features, 0).unionByName(_melt(current, features, 1))
    return both.groupBy("feature_name", "value").agg(
        F.count_if(F.col("side") == 0).alias("n_base"), F.count_if(F.col("side") == 1).alias("n_cur"))


def ks_test(counts: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic over all values, with the asymptotic p-value.

    The cumulative counts come from ``running_totals``, so a feature is never ordered inside one task.
    """
    totals = running_totals(counts, ["feature_name"], "value", ["n_base", "n_cur"])
    n, m = F.col("n_base_total"), F.col("n_cur_total")
    gap = F.abs((F.col("n_base_before") + F.col("n_base")) / n - (F.col("n_cur_before") + F.col("n_cur")) / m)
    stat = totals.groupBy("feature_name").agg(F.max(gap).alias("ks_statistic"), F.max(n).alias("_n"), F.max(m).alias("_m"))
    lam = F.sqrt(F.col("_n") * F.col("_m") / (F.col("_n") + F.col("_m"))) * F.col("ks_statistic")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda s, k: s + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * F.col("_lam") * F.col("_lam")))
    # The alternating series converges too slowly for a tiny statistic, where the p-value is 1.
    p = F.when(F.col("_lam") < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))
    return stat.where((F.col("_n") > 0) & (F.col("_m") > 0)).withColumn("_lam", lam).select("feature_name", "ks_statistic", p.alias("ks_pvalue"))


def psi(counts: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """Population stability index over equal-width bins of the baseline range.

    Values outside the range fall in no bin but still count in the divisor; the last bin is closed; a
    constant baseline gets a range one unit wide; an empty bin counts as a small share.
    """
    seen = F.when(F.col("n_base") > 0, F.col("value"))
    bounds = counts.groupBy("feature_name").agg(
        F.min(seen).alias("_min"), F.max(seen).alias("_max"), F.sum("n_base").alias("_n"), F.sum("n_cur").alias("_m"),
    ).where((F.col("_n") > 0) & (F.col("_m") > 0))
    flat = F.col("_min") == F.col("_max")
    bounds = bounds.select("feature_name", "_n", "_m", F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
                           F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"))
    v, lo, hi = F.col("value"), F.col("_lo"), F.col("_hi")
    index = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    filled = counts.join(bounds, "feature_name").where(v.between(lo, hi)).groupBy("feature_name", index.alias("bin")).agg(
        F.sum("n_base").alias("b"), F.sum("n_cur").alias("c"))
    grid = bounds.select("feature_name", "_n", "_m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))

    def part(count: str, total: str) -> Column:
        value = F.coalesce(F.col(count), F.lit(0)) / F.col(total)
        return F.when(value == 0, F.lit(PSI_EMPTY_SHARE)).otherwise(value)

    shares = grid.join(filled, ["feature_name", "bin"], "left").select("feature_name", part("b", "_n").alias("pb"), part("c", "_m").alias("pc"))
    return shares.groupBy("feature_name").agg(F.sum((F.col("pc") - F.col("pb")) * F.ln(F.col("pc") / F.col("pb"))).alias("psi_score"))


def mean_shift(counts: DataFrame) -> DataFrame:
    """Mean and population deviation on both sides, and the shift in baseline deviations."""
    v = F.col("value")

    def moments(n: str, side: str) -> list[Column]:
        weight = F.sum(n)
        return [F.try_divide(F.sum(v * F.col(n)), weight).alias(f"{side}_mean")]

    means = counts.groupBy("feature_name").agg(*moments("n_base", "baseline"), *moments("n_cur", "current"))
    # Second pass around the means: summing squares directly would lose digits for large values.
    around = counts.join(means, "feature_name")
    spread = around.groupBy("feature_name").agg(
        F.max("baseline_mean").alias("baseline_mean"),
        F.sqrt(F.sum(F.pow(v - F.col("baseline_mean"), F.lit(2)) * F.col("n_base")) / F.sum("n_base")).alias("baseline_std"),
        F.max("current_mean").alias("current_mean"),
        F.sqrt(F.sum(F.pow(v - F.col("current_mean"), F.lit(2)) * F.col("n_cur")) / F.sum("n_cur")).alias("current_std"))
    shift = F.abs(F.col("current_mean") - F.col("baseline_mean")) / F.greatest("baseline_std", F.lit(STD_FLOOR))
    return spread.withColumn("mean_shift_std", shift)


def data_drift(baseline: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """All drift figures per feature, over every row of both sides."""
    counts = value_counts(baseline, current, features)
    figures = mean_shift(counts).join(ks_test(counts), "feature_name").join(psi(counts), "feature_name")
    hit = (F.col("ks_pvalue") < DRIFT_KS_P) | (F.col("psi_score") > DRIFT_PSI) | (F.col("mean_shift_std") > DRIFT_MEAN_SHIFT)
    return figures.withColumn("drift_detected", hit)


def drift_rows(drift: DataFrame, logged_at: Column) -> DataFrame:
    """Drift figures in the layout of the drift history."""
    return drift.select(logged_at.alias("timestamp"), "feature_name", "baseline_mean", "baseline_std", "current_mean", "current_std",
                        "ks_statistic", "ks_pvalue", "psi_score", "drift_detected")


def alerts(decay: DataFrame, drift: DataFrame) -> DataFrame:
    a = decay.where("decay_detected").select(
        F.lit("MODEL_DECAY").alias("alert_type"), F.col("model_name").alias("subject"),
        F.format_string("RMSE change %.1f%%, R2 drop %.4f", "rmse_change_pct", "r_squared_drop").alias("detail"))
    b = drift.where("drift_detected").select(
        F.lit("DATA_DRIFT").alias("alert_type"), F.col("feature_name").alias("subject"),
        F.format_string("KS p %.4f, PSI %.4f, mean shift %.2f", "ks_pvalue", "psi_score", "mean_shift_std").alias("detail"))
    return a.unionByName(b)
