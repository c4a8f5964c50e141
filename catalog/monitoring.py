"""Decay, drift, alerts and promotion."""

from pyspark.sql import functions as F

from catalog.registry import on_tables, query
from foliospark.operators import monitoring, scoring, selection
from foliospark.session import work_folder
from foliospark.sources import adapters, histories, tables

_FEATURES = ["o_totalprice", "o_custkey"]


def _decay(spark, sf_dir):
    stats = monitoring.window_stats(adapters.metric_history(spark, sf_dir), adapters.EVENTS_AS_OF)
    return monitoring.model_decay(tables.stage(stats, "window_stats"))


def _counts(spark, sf_dir):
    before, after = adapters.order_halves(spark, sf_dir)
    return tables.stage(monitoring.value_counts(before, after, _FEATURES), "value_counts")


def _drift(spark, sf_dir):
    before, after = adapters.order_halves(spark, sf_dir)
    return tables.stage(monitoring.data_drift(before, after, _FEATURES), "drift")


@on_tables("n1_log_metrics", """
SELECT metric_name, r4(metric_value) AS metric_value, n AS predictions_count FROM (UNPIVOT (SELECT count(*) AS n, avg(abs(error)) AS mae, sqrt(avg(error * error)) AS rmse, pow(corr(actual_rating, predicted_rating), 2) AS r_squared,
  corr(actual_rating, predicted_rating) AS correlation, 100.0 * count(*) FILTER (WHERE abs(error) <= 0.5) / count(*) AS accuracy_within_0_5,
  100.0 * count(*) FILTER (WHERE abs(error) <= 1.0) / count(*) AS accuracy_within_1_0 FROM preds) ON mae, rmse, r_squared, correlation, accuracy_within_0_5, accuracy_within_1_0 INTO NAME metric_name VALUE metric_value)""")
def log_metrics(d):
    """Metric rows are appended to the day-partitioned history and read back."""
    spark = d.raw.books.sparkSession
    root = work_folder(spark)
    histories.set_up(spark, root)
    wide = scoring.monitoring_metrics(d.predictions).withColumn("model_name", F.lit("mean_deviation"))
    rows = monitoring.metric_rows(wide, F.lit(adapters.EVENTS_AS_OF), "v1", "test")
    return histories.append_dated(rows, f"{root}/model_metrics_history", "timestamp").select("metric_name", "metric_value", "predictions_count")


_DECAYED = "(coalesce(rmse_change_pct > 10, FALSE) OR coalesce(r_squared_drop > 0.05, FALSE))"


@query("n2_model_decay", f"""
SELECT model_name, r4(baseline_rmse) AS baseline_rmse, r4(recent_rmse) AS recent_rmse, r4(rmse_change_pct) AS rmse_change_pct, r4(baseline_r_squared) AS baseline_r_squared,
  r4(recent_r_squared) AS recent_r_squared, r4(r_squared_drop) AS r_squared_drop, {_DECAYED} AS decay_detected, 'compared' AS reason FROM decay""")
def decay(spark, sf_dir):
    return _decay(spark, sf_dir)


@query("n3_data_drift", """
SELECT feature_name, r4(baseline_mean) AS baseline_mean, r4(baseline_std) AS baseline_std, r4(current_mean) AS current_mean, r4(current_std) AS current_std, r4(mean_shift_std) AS mean_shift_std,
  r4(ks_statistic) AS ks_statistic, r4(ks_pvalue) AS ks_pvalue, r4(psi_score) AS psi_score, drift_detected FROM drift_all""")
def drift(spark, sf_dir):
    return _drift(spark, sf_dir)


@query("n4_ks_test", "SELECT feature_name, r4(ks_statistic) AS ks_statistic, r4(ks_pvalue) AS ks_pvalue FROM drift_p")
def ks(spark, sf_dir):
    return monitoring.ks_test(_counts(spark, sf_dir))


@query("n5_stability_index", "SELECT feature_name, r4(psi_score) AS psi_score FROM drift_psi")
def psi(spark, sf_dir):
    return monitoring.psi(_counts(spark, sf_dir))


@query("n6_mean_shift", """
SELECT feature_name, r4(baseline_mean) AS baseline_mean, r4(baseline_std) AS baseline_std, r4(current_mean) AS current_mean, r4(current_std) AS current_std,
  r4(abs(current_mean - baseline_mean) / greatest(baseline_std, 0.001)) AS mean_shift_std FROM drift_moments""")
def mean_shift(spark, sf_dir):
    return monitoring.mean_shift(_counts(spark, sf_dir))


@query("n7_log_drift", """
SELECT '2024-01-31 00:00:00.000000' AS timestamp, feature_name, r4(baseline_mean) AS baseline_mean, r4(baseline_std) AS baseline_std, r4(current_mean) AS current_mean, r4(current_std) AS current_std,
  r4(ks_statistic) AS ks_statistic, r4(ks_pvalue) AS ks_pvalue, r4(psi_score) AS psi_score, drift_detected FROM drift_all""")
def log_drift(spark, sf_dir):
    root = work_folder(spark)
    histories.set_up(spark, root)
    rows = monitoring.drift_rows(_drift(spark, sf_dir), F.lit(adapters.EVENTS_AS_OF))
    return histories.append_dated(rows, f"{root}/data_drift_history", "timestamp").drop("date")


@query("n8_alerts", f"""
SELECT 'MODEL_DECAY' AS alert_type, model_name AS subject, 'RMSE change ' || printf('%.1f', rmse_change_pct) || '%, R2 drop ' || printf('%.4f', r_squared_drop) AS detail FROM decay WHERE {_DECAYED}
UNION ALL SELECT 'DATA_DRIFT', feature_name, 'KS p ' || printf('%.4f', ks_pvalue) || ', PSI ' || printf('%.4f', psi_score) || ', mean shift ' || printf('%.2f', mean_shift_std) FROM drift_all WHERE drift_detected""")
def alerts(spark, sf_dir):
    return monitoring.alerts(_decay(spark, sf_dir), _drift(spark, sf_dir))


@query("n9_dashboard_history", """
SELECT model_name, metric_name, count(*) AS days, r4(max(avg_value)) AS top_value FROM (
  SELECT strftime(timestamp, '%Y-%m-%d') AS date, model_name, metric_name, avg(metric_value) AS avg_value FROM fx_history WHERE timestamp >= TIMESTAMP '2024-01-01'
  GROUP BY ALL ORDER BY 1 DESC, 2, 3 LIMIT 500) GROUP BY 1, 2""")
def dashboard(spark, sf_dir):
    """The daily history read from the stored, day-partitioned table."""
    root = work_folder(spark)
    histories.set_up(spark, root)
    stored = histories.append_dated(adapters.metric_history(spark, sf_dir), f"{root}/model_metrics_history", "timestamp")
    return monitoring.metric_history(stored, adapters.EVENTS_AS_OF).groupBy("model_name", "metric_name").agg(
        F.count(F.lit(1)).alias("days"), F.max("avg_value").alias("top_value"))


_PAIR = """(SELECT book_era, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, coalesce(pow(corr(a, p), 2), 0) AS r2 FROM (
  SELECT book_era, actual_rating AS a, predicted_rating AS p, actual_rating - predicted_rating AS e FROM cand WHERE model_name = '{}') GROUP BY 1)"""


@on_tables("n10_promotion_check", f"""
SELECT book_era, r4(n.mae) AS new_mae, r4(n.rmse) AS new_rmse, r4(n.r2) AS new_r_squared, r4(c.mae) AS current_mae, r4(c.rmse) AS current_rmse, r4(c.r2) AS current_r_squared,
  r4((c.rmse - n.rmse) / c.rmse * 100) AS rmse_improvement, r4((c.mae - n.mae) / c.mae * 100) AS mae_improvement, r4((n.r2 - c.r2) / greatest(c.r2, 0.01) * 100) AS r_squared_improvement,
  (c.rmse - n.rmse) / c.rmse > 0 AND NOT ((c.mae - n.mae) / c.mae * 100 < -10 OR (n.r2 - c.r2) / greatest(c.r2, 0.01) * 100 < -10) AS promote
FROM {_PAIR.format('mean_deviation')} n JOIN {_PAIR.format('book_mean')} c USING (book_era)""")
def promotion(d):
    def of(name):
        return scoring.monitoring_metrics(d.candidates.where(F.col("model_name") == name), ["book_era"])

    return selection.promotion(of("mean_deviation"), of("book_mean"), ["book_era"])


@query("n11_promotion_decisions", """
SELECT display_name, CAST(new_version AS VARCHAR) AS new_version, CAST(current_version AS VARCHAR) AS current_version, decision,
  CAST(CASE WHEN decision LIKE 'PROMOTED%' THEN new_version WHEN decision = 'ROLLBACK_KEPT_CURRENT' THEN current_version END AS VARCHAR) AS promoted_version FROM (
  SELECT d.display_name, n.version AS new_version, c.version AS current_version, CASE WHEN n.version IS NULL THEN 'ERROR_NO_VERSIONS' WHEN mn.version IS NULL THEN 'ERROR_NEW_METRICS'
    WHEN c.version IS NULL THEN 'PROMOTED_FIRST_DEFAULT' WHEN mc.version IS NULL THEN 'KEPT_CURRENT_NO_COMPARISON' WHEN mc.rmse IS NULL THEN 'ERROR_CURRENT_METRICS'
    WHEN (mc.rmse - mn.rmse) / mc.rmse > 0 AND NOT ((mc.mae - mn.mae) / mc.mae * 100 < -10 OR (mn.r_squared - mc.r_squared) / greatest(mc.r_squared, 0.01) * 100 < -10) THEN 'PROMOTED_NEW_VERSION'
    ELSE 'ROLLBACK_KEPT_CURRENT' END AS decision
  FROM (SELECT display_name FROM fx_registry UNION SELECT display_name FROM fx_version_metrics) d
  LEFT JOIN (SELECT display_name, arg_max(version, (created, version)) AS version FROM fx_registry GROUP BY 1) n USING (display_name)
  LEFT JOIN (SELECT r.display_name, arg_max(r.version, (r.created, r.version)) AS version FROM fx_registry r JOIN (SELECT display_name, arg_max(version, (created, version)) AS newest FROM fx_registry GROUP BY 1) x USING (display_name)
    WHERE r.is_default AND r.version <> x.newest GROUP BY 1) c USING (display_name)
  LEFT JOIN fx_version_metrics mn ON mn.display_name = d.display_name AND mn.version = n.version
  LEFT JOIN fx_version_metrics mc ON mc.display_name = d.display_name AND mc.version = c.version)""")
def decisions(spark, sf_dir):
    out = selection.promotion_decisions(adapters.model_registry(spark, sf_dir), adapters.version_metrics(spark, sf_dir))
    return out.withColumns({c: F.col(c).cast("string") for c in ("new_version", "current_version", "promoted_version")})
