"""Bias detection, mitigation and model selection."""

from pyspark.sql import functions as F

from catalog.registry import on_tables
from foliospark.functions.labels import feature_slices
from foliospark.operators import bias, mitigation, selection
from foliospark.plans import audit
from foliospark.sources import tables

_SLICES = """slice_name, slice_dimension, slice_value, n AS "count", r4(mae) AS mae, r4(rmse) AS rmse, r4(mean_predicted) AS mean_predicted, r4(mean_actual) AS mean_actual,
  r4(mean_error) AS mean_error, r4(std_error) AS std_error"""


def _era():
    return F.col("book_era")


@on_tables("b1_slice_metrics", f"SELECT {_SLICES} FROM slices")
def slices(d):
    return bias.slice_metrics(d.predictions)


@on_tables("b2_slice_sizes", "SELECT slice_dimension, slice_value, count(*) AS row_count FROM sliced WHERE slice_value IS NOT NULL GROUP BY 1, 2")
def slice_sizes(d):
    return bias.slice_metrics(d.predictions).select("slice_dimension", "slice_value", F.col("count").alias("row_count"))


@on_tables("b3_disparities", """
SELECT slice_dimension, r4(mae_range) AS mae_range, r4(rmse_range) AS rmse_range, r4(mae_cv) AS mae_cv, r4(rmse_cv) AS rmse_cv, num_slices, max_mae_slice, min_mae_slice FROM dims""")
def disparities(d):
    return audit.detect(d.predictions).summary


@on_tables("b4_flagged_dimensions", "SELECT slice_dimension, r4(mae_range) AS mae_range, r4(mae_cv) AS mae_cv, severity, recommendation FROM flags")
def flagged(d):
    return audit.detect(d.predictions).flags


@on_tables("b5_high_risk_slices", 'SELECT slice, slice_dimension, slice_value, r4(mae) AS mae, r4(mae_deviation_pct) AS mae_deviation_pct, "count" FROM risks')
def risks(d):
    return audit.detect(d.predictions).risks


_ADVICE = "(SELECT * FROM advice UNION ALL SELECT 99, 'No significant bias detected across analyzed dimensions.' WHERE NOT EXISTS (SELECT 1 FROM advice))"


@on_tables("b6_recommendations", f"SELECT CAST(position AS BIGINT) AS position, recommendation FROM {_ADVICE}")
def recommendations(d):
    return audit.detect(d.predictions).advice


@on_tables("b7_detection_counts", """
SELECT (SELECT count(*) FROM slices) AS total_slices, (SELECT count(*) FROM flags) AS disparities_found, (SELECT count(*) FROM flags WHERE severity = 'high') AS high_severity, (SELECT count(*) FROM risks) AS high_risk_slices""")
def detection(d):
    return audit.counts(audit.detect(d.predictions))


@on_tables("b8_group_metrics", """
SELECT book_era AS slice_group, count(*) AS "count", r4(avg(user_avg_rating_vs_book)) AS mean_rating, r4(coalesce(stddev_samp(user_avg_rating_vs_book), 0)) AS std_rating FROM feats GROUP BY 1""")
def group_metrics(d):
    return mitigation.group_metrics(d.features, _era())


_SHRUNK = """(SELECT f.*, m AS group_mean, gm AS global_mean, user_avg_rating_vs_book - 0.5 * (m - gm) AS rating_debiased, rating - 0.5 * (m - gm) AS rating_debiased_predicted
  FROM feats f JOIN (SELECT book_era, avg(user_avg_rating_vs_book) AS m FROM feats GROUP BY 1) USING (book_era) CROSS JOIN (SELECT avg(user_avg_rating_vs_book) AS gm FROM feats))"""


@on_tables("b9_shrinkage", f"""
SELECT user_id_clean, book_id, r4(group_mean) AS group_mean, r4(global_mean) AS global_mean, r4(rating_debiased) AS rating_debiased, r4(rating_debiased_predicted) AS rating_debiased_predicted, book_era AS book_era_group FROM {_SHRUNK}""")
def shrinkage(d):
    return mitigation.shrink(d.features, "Book Era", _era()).select(
        "user_id_clean", "book_id", "group_mean", "global_mean", "rating_debiased", "rating_debiased_predicted", "book_era_group")


def _weights(expr):
    return f"""SELECT user_id_clean, book_id, book_era AS book_era_group, r4({expr}) AS sample_weight FROM feats JOIN (SELECT book_era, CAST(count(*) AS DOUBLE) AS n FROM feats GROUP BY 1) USING (book_era)
  CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS total, count(DISTINCT book_era) AS g FROM feats)"""


@on_tables("b10_inverse_propensity", _weights("1.0 / (n / total)"))
def inverse_propensity(d):
    return mitigation.reweight(d.features, "Book Era", _era()).select("user_id_clean", "book_id", "book_era_group", "sample_weight")


@on_tables("b10_balanced_weights", _weights("(total / g) / n"))
def balanced(d):
    return mitigation.reweight(d.features, "Book Era", _era(), "balanced").select("user_id_clean", "book_id", "book_era_group", "sample_weight")


@on_tables("b11_group_offsets", 'SELECT author_gender_group AS slice_group, r4(avg(error)) AS "offset" FROM preds WHERE author_gender_group IS NOT NULL GROUP BY 1')
def offsets(d):
    return mitigation.group_offsets(d.predictions, F.col("author_gender_group"))


@on_tables("b12_apply_offsets", """
SELECT p.user_id_clean, p.book_id, p.author_gender_group AS author_gender_group_label, r4(p.predicted_rating) AS original_predicted_rating, r4(p.predicted_rating + coalesce(o.m, 0)) AS predicted_rating
FROM preds p LEFT JOIN (SELECT author_gender_group, avg(error) AS m FROM preds WHERE author_gender_group IS NOT NULL GROUP BY 1) o ON p.author_gender_group = o.author_gender_group""")
def apply_offsets(d):
    out = mitigation.apply_offsets(d.predictions.withColumnRenamed("author_gender_group", "g"), "Author Gender", F.col("g"))
    return out.select("user_id_clean", "book_id", F.col("author_gender_group").alias("author_gender_group_label"), "original_predicted_rating", "predicted_rating")


_PRED = """user_id_clean, book_id, r4(original_predicted_rating) AS original_predicted_rating, r4(predicted_rating) AS predicted_rating, r4(absolute_error) AS absolute_error, r4(error) AS error"""


@on_tables("b13_prediction_shrinkage", f"SELECT {_PRED} FROM era_preds")
def prediction_shrinkage(d):
    return mitigation.shrink_predictions(d.predictions).select("user_id_clean", "book_id", "original_predicted_rating", "predicted_rating", "absolute_error", "error")


@on_tables("b14_improvements", f"""
SELECT r4(v0) AS variance_before, r4(v1) AS variance_after, r4(CASE WHEN v0 > 0 THEN (v0 - v1) / v0 * 100 ELSE 0 END) AS variance_reduction_pct, r4(mae_before) AS mae_before, r4(rmse_before) AS rmse_before,
  r4(mae_after) AS mae_after, r4(rmse_after) AS rmse_after, r4((mae_before - mae_after) / mae_before * 100) AS mae_improvement_pct, r4((rmse_before - rmse_after) / rmse_before * 100) AS rmse_improvement_pct
FROM (SELECT var_pop(m) AS v0, var_pop(a) AS v1 FROM (SELECT avg(user_avg_rating_vs_book) AS m, avg(rating_debiased) AS a FROM {_SHRUNK} GROUP BY book_era))
CROSS JOIN (SELECT avg(abs(error)) AS mae_before, sqrt(avg(error * error)) AS rmse_before FROM preds) CROSS JOIN (SELECT avg(abs(error)) AS mae_after, sqrt(avg(error * error)) AS rmse_after FROM era_preds)""")
def improvements(d):
    from foliospark.operators.scoring import error_metrics

    shrunk = mitigation.shrink(d.features, "Book Era", _era())
    variance = mitigation.variance_reduction(mitigation.group_metrics(d.features, _era()), mitigation.group_metrics(shrunk, _era(), "rating_debiased"))
    errors = mitigation.error_improvement(error_metrics(d.predictions), error_metrics(mitigation.shrink_predictions(d.predictions)))
    return variance.crossJoin(F.broadcast(errors))


_RESLICE = """(SELECT slice_dimension, slice_value, avg(abs(a - p)) AS mae FROM (
  SELECT 'Book Era' AS slice_dimension, book_era AS slice_value, actual_rating AS a, predicted_rating AS p FROM era_preds
  UNION ALL SELECT 'Reading Pace', reading_pace_category, actual_rating, predicted_rating FROM era_preds) WHERE slice_value IS NOT NULL GROUP BY 1, 2)"""


@on_tables("b15_validation", """
SELECT r4(mae_before) AS mae_before, r4(mae_after) AS mae_after, r4((mae_after - mae_before) / mae_before * 100) AS mae_change_pct
FROM (SELECT avg(abs(error)) AS mae_before FROM preds) CROSS JOIN (SELECT avg(abs(error)) AS mae_after FROM era_preds)""")
def validation(d):
    mitigated = {"prediction_shrinkage": tables.stage(mitigation.shrink_predictions(d.predictions))}
    return audit.validation(d.predictions, mitigated).select("mae_before", "mae_after", "mae_change_pct")


@on_tables("b16_worst_dimension", "SELECT slice_dimension, r4(mae_cv) AS mae_cv FROM flags ORDER BY flags.mae_cv DESC, k LIMIT 1")
def worst(d):
    return audit.worst_dimension(audit.detect(d.predictions).flags)


def _summary(mitigated):
    return f"""SELECT count(*) > 0 AS bias_detected, CASE WHEN count(*) FILTER (WHERE severity = 'high') > 0 THEN 'high' WHEN count(*) > 0 THEN 'medium' ELSE 'none' END AS severity,
  coalesce(string_agg(slice_dimension, ', ' ORDER BY k), '') AS dimensions_with_bias, {mitigated} AS mitigation_applied,
  CASE WHEN count(*) = 0 THEN 'PASS' WHEN {mitigated} THEN 'MITIGATED' ELSE 'NEEDS_ATTENTION' END AS overall_status FROM flags"""


@on_tables("b17_executive_summary", _summary("FALSE"))
def summary(d):
    return audit.executive_summary(audit.detect(d.predictions), 0)


@on_tables("b18_fairness_score", """
SELECT CAST(greatest(0, 100 - 20 * count(*) FILTER (WHERE severity = 'high') - 10 * count(*) FILTER (WHERE severity = 'medium')) AS BIGINT) AS fairness_score, count(*) AS disparities_count,
  count(*) FILTER (WHERE severity = 'high') AS high_severity_count FROM flags""")
def fairness(d):
    return bias.fairness_score(audit.detect(d.predictions).flags)


_CAND_ERRORS = "(SELECT model_name, avg(abs(actual_rating - predicted_rating)) AS mae, sqrt(avg((actual_rating - predicted_rating) * (actual_rating - predicted_rating))) AS rmse FROM cand GROUP BY 1)"


@on_tables("b19_performance_scores", f"""
SELECT model_name, r4(mae) AS mae, r4(rmse) AS rmse, r4(((1 - (mae - min(mae) OVER ()) / (max(mae) OVER () - min(mae) OVER ())) + (1 - (rmse - min(rmse) OVER ()) / (max(rmse) OVER () - min(rmse) OVER ()))) / 2 * 100) AS performance_score FROM {_CAND_ERRORS}""")
def performance(d):
    from foliospark.operators.scoring import error_metrics

    return selection.performance_scores(error_metrics(d.candidates, ["model_name"]).select("model_name", "mae", "rmse"))


@on_tables("b19_performance_two_models", f"""
SELECT model_name, r4((greatest(0, 100 - (mae - min(mae) OVER ()) / min(mae) OVER () * 100) + greatest(0, 100 - (rmse - min(rmse) OVER ()) / min(rmse) OVER () * 100)) / 2) AS performance_score
FROM {_CAND_ERRORS} WHERE model_name <> 'global_mean'""")
def performance_pair(d):
    from foliospark.operators.scoring import error_metrics

    pair = error_metrics(d.candidates.where(F.col("model_name") != "global_mean"), ["model_name"]).select("model_name", "mae", "rmse")
    return selection.performance_scores(pair).select("model_name", "performance_score")


_CAND_SLICED = "\n  UNION ALL ".join(f"SELECT model_name, '{n}' AS dim, {e} AS v, actual_rating AS a, predicted_rating AS p FROM cand" for n, e in (
    ("Popularity", "CASE WHEN book_popularity_normalized >= 0.66 THEN 'High' WHEN book_popularity_normalized >= 0.33 THEN 'Medium' ELSE 'Low' END"), ("Book Length", "book_length_category"),
    ("Book Era", "book_era"), ("Genre Diversity", "CASE WHEN num_genres >= 5 THEN 'Multi-genre' WHEN num_genres >= 2 THEN 'Some genres' ELSE 'Single/No genre' END"),
    ("User Activity", "CASE WHEN user_activity_count >= 50 THEN 'High' WHEN user_activity_count >= 10 THEN 'Medium' ELSE 'Low' END"), ("Reading Pace", "reading_pace_category"),
    ("Author Gender", "author_gender_group"), ("Rating Range", "CASE WHEN actual_rating >= 4.0 THEN 'High (4-5)' WHEN actual_rating >= 3.0 THEN 'Medium (3-4)' ELSE 'Low (1-3)' END")))
_CAND_FAIR = f"""(SELECT model_name, 100 - 20 * count(*) FILTER (WHERE cv > 0.25) - 10 * count(*) FILTER (WHERE cv <= 0.25) AS raw, count(*) AS n, count(*) FILTER (WHERE cv > 0.25) AS high FROM (
  SELECT model_name, dim, stddev_pop(mae) / avg(mae) AS cv, max(mae) - min(mae) AS rg FROM (SELECT model_name, dim, v, avg(abs(a - p)) AS mae FROM ({_CAND_SLICED}) WHERE v IS NOT NULL GROUP BY 1, 2, 3)
  GROUP BY 1, 2 HAVING count(*) >= 2) WHERE cv > 0.15 OR rg > 0.3 GROUP BY 1)"""
_SCORED = f"""(SELECT *, 0.6 * performance_score + 0.4 * fairness_score AS combined_score FROM (
  SELECT e.model_name, e.mae, e.rmse, CAST(coalesce(greatest(0, f.raw), 100) AS BIGINT) AS fairness_score, coalesce(f.n, 0) AS disparities_count, coalesce(f.high, 0) AS high_severity_count,
    ((1 - (mae - min(mae) OVER ()) / (max(mae) OVER () - min(mae) OVER ())) + (1 - (rmse - min(rmse) OVER ()) / (max(rmse) OVER () - min(rmse) OVER ()))) / 2 * 100 AS performance_score
  FROM {_CAND_ERRORS} e LEFT JOIN {_CAND_FAIR} f USING (model_name)))"""


@on_tables("b20_combined_scores", f"SELECT model_name, r4(mae) AS mae, r4(rmse) AS rmse, fairness_score, disparities_count, high_severity_count, r4(performance_score) AS performance_score, r4(combined_score) AS combined_score FROM {_SCORED}")
def combined(d):
    return audit.score_candidates(d.candidates)


_RANKED = f"""(SELECT *, row_number() OVER (ORDER BY fairness_score >= 60 DESC, CASE WHEN fairness_score >= 60 THEN combined_score ELSE fairness_score END DESC, combined_score DESC, model_name) AS selection_rank FROM {_SCORED})"""


@on_tables("b21_select_model", f"""
SELECT model_name, r4(combined_score) AS combined_score, fairness_score, selection_rank, CASE WHEN selection_rank = 1 THEN 'SELECTED' WHEN fairness_score < 60 THEN 'NOT SELECTED - Below fairness threshold'
  WHEN combined_score < best THEN 'NOT SELECTED - Lower combined score (' || printf('%.1f', combined_score) || ' vs ' || printf('%.1f', best) || ')' ELSE 'NOT SELECTED' END AS recommendation
FROM (SELECT *, max(CASE WHEN selection_rank = 1 THEN combined_score END) OVER () AS best FROM {_RANKED})""")
def select_model(d):
    return selection.select_model(audit.score_candidates(d.candidates)).select("model_name", "combined_score", "fairness_score", "selection_rank", "recommendation")


@on_tables("b21_trade_offs", f"""
SELECT s.model_name AS selected_model, p.model_name AS best_performance_model, r4(p.mae) AS best_performance_mae, f.model_name AS best_fairness_model, f.fairness_score AS best_fairness_score,
  s.model_name = p.model_name AS selected_is_best_performance, s.model_name = f.model_name AS selected_is_best_fairness,
  r4(CASE WHEN s.model_name = p.model_name THEN 0 ELSE (s.mae - p.mae) / p.mae * 100 END) AS performance_sacrifice,
  r4(CASE WHEN s.model_name = p.model_name THEN 0 ELSE s.fairness_score - p.fairness_score END) AS fairness_gain
FROM (SELECT * FROM {_RANKED} WHERE selection_rank = 1) s CROSS JOIN (SELECT * FROM {_RANKED} ORDER BY mae, model_name LIMIT 1) p
CROSS JOIN (SELECT * FROM {_RANKED} ORDER BY fairness_score DESC, combined_score DESC, model_name LIMIT 1) f""")
def trade_offs(d):
    out = selection.trade_offs(selection.select_model(audit.score_candidates(d.candidates)))
    return out.drop("combined_score", "fairness_score", "high_severity_count", "disparities_count", "rationale")


@on_tables("b22_heatmap", "SELECT slice_dimension, r4(mae_range) AS mae_range, r4(mae_cv) AS mae_cv, r4(rmse_range) AS rmse_range, r4(rmse_cv) AS rmse_cv, num_slices FROM dims")
def heatmap(d):
    return bias.heatmap(audit.detect(d.predictions).summary)


@on_tables("b23_before_after", f"""
SELECT slice_dimension, slice_value, r4(b.mae) AS mae_before, r4(a.mae) AS mae_after, r4(CASE WHEN b.mae > 0 THEN (b.mae - a.mae) / b.mae * 100 ELSE 0 END) AS improvement_pct
FROM (SELECT slice_dimension, slice_value, mae FROM slices) b JOIN {_RESLICE} a USING (slice_dimension, slice_value)""")
def before_after(d):
    dims = [("Book Era", _era()), ("Reading Pace", F.col("reading_pace_category"))]
    before = bias.slice_metrics(d.predictions, dims)
    return bias.before_after(before, bias.slice_metrics(mitigation.shrink_predictions(d.predictions), dims))


_GROUPED = "\n  UNION ALL ".join(f"SELECT '{n}' AS slice_dimension, {e} AS slice_value, user_avg_rating_vs_book AS x FROM {src}" for n, e, src in (
    ("Popularity", "CASE WHEN book_popularity_normalized >= 0.66 THEN 'High' WHEN book_popularity_normalized >= 0.33 THEN 'Medium' ELSE 'Low' END", "feats"),
    ("Book Length", "book_length_category", "feats"), ("Book Era", "book_era", "feats"),
    ("User Activity", "CASE WHEN user_activity_count >= 50 THEN 'High' WHEN user_activity_count >= 10 THEN 'Medium' ELSE 'Low' END", "feats"), ("Reading Pace", "reading_pace_category", "feats"),
    ("Author Gender", "author_gender_group", "(SELECT f.*, g.author_gender_group FROM feats f JOIN book_gender g USING (book_id) WHERE g.author_gender_group IS NOT NULL)")))
_DEBIASED = f"""(SELECT slice_dimension, slice_value, m, m - 0.5 * (m - g) AS a FROM (SELECT slice_dimension, slice_value, avg(x) AS m FROM ({_GROUPED}) GROUP BY 1, 2)
  JOIN (SELECT slice_dimension, avg(x) AS g FROM ({_GROUPED}) GROUP BY 1) USING (slice_dimension))"""
_EQUITY = f"""(SELECT *, greatest(0, 1 - 0.5 * least(1, abs(relative_mean_change)) - 0.5 * CASE WHEN variance_ratio <= 0 THEN 1 ELSE 1 - 1 / (1 + abs(ln(variance_ratio + 1e-9))) END) AS equity_index FROM (
  SELECT *, (mean_after - mean_before) / (abs(mean_before) + 1e-9) AS relative_mean_change, variance_after / (variance_before + 1e-9) AS variance_ratio FROM (
    SELECT slice_dimension, var_pop(m) AS variance_before, var_pop(a) AS variance_after, avg(m) AS mean_before, avg(a) AS mean_after FROM {_DEBIASED} GROUP BY 1)))"""


def _groups(d):
    """Six dimensions: five of the features, and the author's gender group."""
    with_author = d.features.join(d.books.select("book_id"), "book_id").join(_gender_of(d), "book_id", "left")
    dims = [s for s in feature_slices() if s[0] != "Genre Diversity"] + [("Author Gender", F.col("author_gender_group"))]
    return mitigation.debiased_means(tables.stage(mitigation.grouped_means(with_author, dims)))


def _gender_of(d):
    from foliospark.operators.scoring import author_group_of_books

    return author_group_of_books(d.books, d.gender_map)


@on_tables("b24_equity_index", f"""
SELECT slice_dimension, r4(variance_before) AS variance_before, r4(variance_after) AS variance_after, r4(mean_before) AS mean_before, r4(mean_after) AS mean_after,
  r4(relative_mean_change) AS relative_mean_change, r4(variance_ratio) AS variance_ratio, r4(equity_index) AS equity_index FROM {_EQUITY}""")
def equity(d):
    return mitigation.equity(_groups(d))


@on_tables("b25_grouped_analysis", f"SELECT slice_dimension, slice_value, r4(m) AS avg_rating, r4(a) AS avg_rating_after FROM {_DEBIASED}")
def grouped_analysis(d):
    return _groups(d).select("slice_dimension", "slice_value", "avg_rating", "avg_rating_after")


@on_tables("b26_scorecard", f"""
SELECT 'score' AS section, CAST(1 AS BIGINT) AS position, 'Fairness Score' AS label, r4(greatest(0, 100 - 20 * count(*) FILTER (WHERE severity = 'high') - 10 * count(*) FILTER (WHERE severity = 'medium'))) AS value, '' AS band FROM flags
UNION ALL SELECT 'dimension', k, slice_dimension, r4(mae_cv), CASE WHEN mae_cv > 0.25 THEN 'red' WHEN mae_cv > 0.15 THEN 'orange' ELSE 'green' END FROM (SELECT * FROM dims ORDER BY k LIMIT 6)
UNION ALL SELECT 'high_risk', k, slice_value, r4(mae), 'red' FROM (SELECT * FROM risks ORDER BY k, slice_value LIMIT 6)
UNION ALL SELECT 'recommendation', position, recommendation, CAST(NULL AS DOUBLE), '' FROM (SELECT * FROM {_ADVICE} ORDER BY position LIMIT 5)""")
def scorecard(d):
    found = audit.detect(d.predictions)
    return bias.scorecard(found.summary, found.flags, found.risks, found.advice)


@on_tables("b27_full_audit", _summary("EXISTS (SELECT 1 FROM flags)"))
def full_audit(d):
    techniques = ["prediction_shrinkage", "threshold_adjustment", "shrinkage", "reweighting"]
    return audit.full_audit(d.predictions, d.features, techniques)[3]


@on_tables("b28_run_selection", f"SELECT model_name, selection_rank, disparities_count FROM {_RANKED}")
def run_selection(d):
    return audit.run_selection(d.candidates)[0].select("model_name", "selection_rank", "disparities_count")
