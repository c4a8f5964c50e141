"""Bias audits: detect, mitigate, validate, select."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions.labels import audit_slices, dimension_rank
from foliospark.operators import bias, mitigation, scoring, selection
from foliospark.sources.tables import stage

TECHNIQUES = ("prediction_shrinkage", "threshold_adjustment", "shrinkage", "reweighting")


class Detection(NamedTuple):
    metrics: DataFrame
    summary: DataFrame
    flags: DataFrame
    risks: DataFrame
    advice: DataFrame


def detect(predictions: DataFrame) -> Detection:
    """Slice metrics and everything derived from them."""
    metrics = stage(bias.slice_metrics(predictions), "slice_metrics")
    summary = bias.disparities(metrics)
    flags, risks = bias.flagged(summary), bias.high_risk(metrics)
    return Detection(metrics, summary, flags, risks, bias.recommendations(summary, flags, risks))


def detection_report(d: Detection, model_name: str, dataset: str) -> DataFrame:
    """The whole detection as one nested row; its arrays hold one entry per slice, dimension or line."""
    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))

    out = rows(d.metrics, "slice_metrics")
    for df, name in ((d.summary, "summary"), (d.flags, "detailed_disparities"), (d.risks, "high_risk_slices"), (d.advice, "recommendations")):
        out = out.crossJoin(F.broadcast(rows(df, name)))
    return out.select(F.lit(model_name).alias("model_name"), F.lit(dataset).alias("dataset"), "*")


def counts(d: Detection) -> DataFrame:
    """One row of report sizes."""
    m = d.metrics.agg(F.count(F.lit(1)).alias("total_slices"))
    f = d.flags.agg(F.count(F.lit(1)).alias("disparities_found"), F.count_if(F.col("severity") == "high").alias("high_severity"))
    r = d.risks.agg(F.count(F.lit(1)).alias("high_risk_slices"))
    return m.crossJoin(F.broadcast(f)).crossJoin(F.broadcast(r))


def worst_dimension(flags: DataFrame) -> DataFrame:
    """The flagged dimension with the greatest CV; ties fall to the audit order."""
    return flags.agg(F.min_by("slice_dimension", F.struct((-F.col("mae_cv")).alias("c"), dimension_rank(F.col("slice_dimension")).alias("r"))).alias("slice_dimension"),
                     F.max("mae_cv").alias("mae_cv"))


def _slice(dimension: str):
    return dict(audit_slices())[dimension]


def mitigate(predictions: DataFrame, features: DataFrame | None, flags: DataFrame, techniques: Sequence[str]) -> dict[str, DataFrame]:
    """Apply the techniques to what was flagged. The flags are a few rows, read once to choose the dimension."""
    unknown = [t for t in techniques if t not in TECHNIQUES]
    if unknown:
        raise ValueError(f"unknown techniques: {', '.join(unknown)}")
    found = {r["slice_dimension"]: r["mae_cv"] for r in flags.collect()}
    if not found:
        return {}
    worst = worst_dimension(flags).first()["slice_dimension"]
    out = {}
    for technique in techniques:
        if technique == "prediction_shrinkage" and "Book Era" in found:
            out[technique] = mitigation.shrink_predictions(predictions)
        elif technique == "threshold_adjustment":
            out[technique] = mitigation.apply_offsets(predictions, worst, _slice(worst))
        elif technique in ("shrinkage", "reweighting") and features is not None and worst not in ("Author Gender", "Rating Range"):
            change = mitigation.shrink if technique == "shrinkage" else mitigation.reweight
            out[technique] = change(features, worst, _slice(worst))
    return out


def executive_summary(before: Detection, n_mitigations: int) -> DataFrame:
    """One row: was bias found, how severe, where, and the standing after mitigation."""
    names = F.transform(F.sort_array(F.collect_list(F.struct(dimension_rank(F.col("slice_dimension")).alias("r"), "slice_dimension"))),
                        lambda x: x["slice_dimension"])
    s = before.flags.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("severity") == "high").alias("_high"), F.array_join(names, ", ").alias("dimensions_with_bias"))
    n = F.col("_n")
    return s.select(
        (n > 0).alias("bias_detected"), F.when(F.col("_high") > 0, "high").when(n > 0, "medium").otherwise("none").alias("severity"),
        "dimensions_with_bias", F.lit(n_mitigations > 0).alias("mitigation_applied"),
        F.when(n == 0, "PASS").when(F.lit(n_mitigations > 0), "MITIGATED").otherwise("NEEDS_ATTENTION").alias("overall_status"))


def validation(predictions: DataFrame, mitigated: dict[str, DataFrame]) -> DataFrame:
    """Per technique that changes predictions: MAE before and after, and the disparities that remain."""
    out = None
    before = scoring.error_metrics(predictions).select(F.col("mae").alias("mae_before"), F.col("rmse").alias("rmse_before"))
    for technique, df in mitigated.items():
        if technique not in ("prediction_shrinkage", "threshold_adjustment"):
            continue
        after = scoring.error_metrics(df).select(F.col("mae").alias("mae_after"), F.col("rmse").alias("rmse_after"))
        row = before.crossJoin(F.broadcast(after)).crossJoin(F.broadcast(counts(detect(df)))).select(F.lit(technique).alias("technique"), "*")
        row = row.withColumn("mae_change_pct", (F.col("mae_after") - F.col("mae_before")) / F.col("mae_before") * 100)
        out = row if out is None else out.unionByName(row)
    return out


def full_audit(predictions: DataFrame, features: DataFrame | None = None, techniques: Sequence[str] = ("prediction_shrinkage",)):
    """Detect, mitigate what was flagged, validate and summarise. Returns (detection, mitigated tables, validation, summary)."""
    before = detect(predictions)
    mitigated = mitigate(predictions, features, before.flags, techniques)
    return before, mitigated, validation(predictions, mitigated), executive_summary(before, len(mitigated))


def score_candidates(candidates: DataFrame, performance_weight: float = 0.6, fairness_weight: float = 0.4) -> DataFrame:
    """Errors, fairness and combined score of every model in a table with a ``model_name`` column; all share one slice pass."""
    by = ["model_name"]
    errors = scoring.error_metrics(candidates, by).select("model_name", "mae", "rmse")
    fair = bias.fairness_score(bias.flagged(bias.disparities(bias.slice_metrics(candidates, by=by), by)), by)
    filled = errors.join(fair, "model_name", "left").fillna({"fairness_score": 100, "disparities_count": 0, "high_severity_count": 0})
    return selection.combined_scores(selection.performance_scores(filled), performance_weight, fairness_weight)


def run_selection(candidates: DataFrame, min_fairness: float = 60.0):
    """Rank the candidates, then shrink the winner's predictions when it shows disparities.

    Returns (ranking, winner's name, debiased predictions or None).
    """
    ranking = selection.select_model(score_candidates(candidates), min_fairness)
    winner = ranking.where(F.col("selection_rank") == 1).select("model_name", "disparities_count").first()
    own = candidates.where(F.col("model_name") == winner["model_name"]).drop("model_name")
    debiased = None
    if winner["disparities_count"] > 0:
        debiased = mitigate(own, None, detect(own).flags, ["prediction_shrinkage"]).get("prediction_shrinkage")
    return ranking, winner["model_name"], debiased
