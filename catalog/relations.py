"""Joins, aggregates, windows, top-k and set operations."""

from pyspark.sql import functions as F

from catalog.registry import on_tables, query
from foliospark.operators import cleaning, etl, features, monitoring, recommend, relational, scoring, sketches
from foliospark.operators.bias import high_risk, slice_metrics, top_risks
from foliospark.operators.mitigation import group_metrics, grouped_means, reweight, shrink, weight_stats
from foliospark.operators.ordered import top_per_key
from foliospark.settings import GREAT_QUANTILE
from foliospark.sources import adapters, tables


def _era():
    return F.col("book_era")


def _timed(d):
    return features.with_times(d.interactions)


def _books0(d):
    return features.base_books(d.books, features.book_reading_times(_timed(d)), d.raw.as_of)


# ---- joins ------------------------------------------------------------------------------------------

@on_tables("j1_interactions_of_books", "SELECT i.user_id, count(*) AS row_count FROM fx_interactions i JOIN cl_books b USING (book_id) GROUP BY 1")
def inner_join(d):
    return d.raw.interactions.join(d.books.select("book_id"), "book_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("row_count"))


@on_tables("j2_books_with_reading_times", "SELECT b.book_id, r4(t.avg_book_reading_time) AS avg_book_reading_time, coalesce(t.num_readers_with_time, 0) AS readers FROM cl_books b LEFT JOIN book_times t USING (book_id)")
def left_join(d):
    times = features.book_reading_times(_timed(d))
    return d.books.join(times, "book_id", "left").select("book_id", "avg_book_reading_time", F.coalesce("num_readers_with_time", F.lit(0)).alias("readers"))


@on_tables("j3_feature_star", "SELECT book_era, reading_pace_category, count(*) AS row_count, r4(avg(user_avg_rating_vs_book)) AS avg_gap FROM merged GROUP BY 1, 2")
def star(d):
    timed = _timed(d)
    books = features.final_books(tables.stage(_books0(d)))
    merged = features.merge_features(features.interaction_features(timed, d.raw.as_of), features.user_features(timed, d.raw.as_of), books)
    return merged.groupBy("book_era", "reading_pace_category").agg(F.count(F.lit(1)).alias("row_count"), F.avg("user_avg_rating_vs_book").alias("avg_gap"))


@on_tables("j4_scalar_cross", "SELECT book_id, r4(popularity_score - m) AS above_mean FROM books0 CROSS JOIN (SELECT avg(popularity_score) AS m FROM books0)")
def scalar_cross(d):
    base = tables.stage(_books0(d))
    one = base.agg(F.avg("popularity_score").alias("m"))
    return base.crossJoin(F.broadcast(one)).select("book_id", (F.col("popularity_score") - F.col("m")).alias("above_mean"))


@on_tables("j5_unread_candidates", """
SELECT u.user_id, (SELECT count(*) FROM cl_books) - count(c.book_id) AS candidates
FROM users u LEFT JOIN read_pairs r ON u.user_id = r.user_id LEFT JOIN cl_books c ON r.book_id = c.book_id GROUP BY 1""")
def unread_candidates(d):
    """How many unread books each user could be offered; the pairs themselves are formed only for a request."""
    return recommend.unread_counts(d.raw.interactions.select("user_id").distinct(), d.books, recommend.reads(d.raw.interactions))


@on_tables("j5_unread_pairs", """
SELECT u.user_id, b.book_id FROM users u CROSS JOIN (SELECT DISTINCT book_id FROM cl_books) b
WHERE CAST(u.user_id[2:] AS BIGINT) % 20 = 0 AND NOT EXISTS (SELECT 1 FROM read_pairs r WHERE r.user_id = u.user_id AND r.book_id = b.book_id)""")
def unread_pairs(d):
    """The unread pairs of a request: the users whose number is divisible by 20, with every book."""
    requested = recommend.asking(d.raw.interactions.select("user_id").distinct())
    return recommend.requested_pairs(requested, d.books, recommend.reads(d.raw.interactions))


@on_tables("j6_never_read", """
SELECT DISTINCT user_id, book_id FROM fx_interactions i WHERE NOT EXISTS (SELECT 1 FROM read_pairs r WHERE r.user_id = i.user_id AND r.book_id = i.book_id)""")
def never_read(d):
    pairs = d.raw.interactions.select("user_id", "book_id").distinct()
    return pairs.join(recommend.reads(d.raw.interactions), ["user_id", "book_id"], "left_anti")


@on_tables("j7_not_in", "SELECT book_id, title_clean FROM cl_books WHERE book_id NOT IN (SELECT book_id FROM fx_interactions WHERE is_read AND rating = 4)")
def null_aware_anti(d):
    return relational.not_in(d.books.select("book_id", "title_clean"), d.raw.interactions.where("is_read AND rating = 4").select("book_id"), "book_id")


@on_tables("j7_not_in_with_null", "SELECT book_id FROM cl_books WHERE book_id NOT IN (SELECT CASE WHEN rating = 4 THEN book_id END FROM fx_interactions WHERE is_read)")
def null_aware_anti_null(d):
    marked = d.raw.interactions.where("is_read").select(F.when(F.col("rating") == 4, F.col("book_id")).alias("book_id"))
    return relational.not_in(d.books.select("book_id"), marked, "book_id")


@on_tables("j8_semi", "SELECT book_id, title FROM fx_books WHERE book_id IN (SELECT book_id FROM fx_interactions WHERE is_read AND rating = 4)")
def semi(d):
    return d.raw.books.select("book_id", "title").join(d.raw.interactions.where("is_read AND rating = 4"), "book_id", "left_semi")


@on_tables("j9_left_then_not_null", "SELECT i.user_id, i.book_id, b.title_clean FROM fx_interactions i JOIN cl_books b USING (book_id)")
def left_not_null(d):
    joined = d.raw.interactions.select("user_id", "book_id").join(d.books.select("book_id", "title_clean"), "book_id", "left")
    return joined.where(F.col("title_clean").isNotNull())


@on_tables("j10_author_links", "SELECT l.book_id, a.name FROM links l JOIN fx_authors a ON CAST(a.author_id AS VARCHAR) = l.author_key")
def unnest_join(d):
    names = d.raw.authors.select(F.col("author_id").cast("string").alias("author_key"), "name")
    return recommend.author_links(d.raw.books).join(names, "author_key").select("book_id", "name")


@on_tables("j11_first_author", "SELECT book_id, author FROM one_author")
def first_author(d):
    return recommend.book_author(recommend.author_links(d.raw.books), d.raw.authors)


@on_tables("j11_first_author_json", "SELECT book_id, author FROM one_author WHERE book_id IN (SELECT book_id FROM cl_books)")
def first_author_json(d):
    return recommend.book_author(recommend.flat_author_links(d.books), d.raw.authors)


@on_tables("j12_author_gender_of_books", "SELECT book_id, author_gender_group FROM book_gender")
def two_hops(d):
    return scoring.author_group_of_books(d.books, d.gender_map)


@on_tables("j13_scored_rows_rejoined", "SELECT p.user_id_clean, p.book_id, r4(p.predicted_rating) AS predicted_rating, r4(f.adjusted_average_rating) AS adjusted_average_rating FROM preds p JOIN feats f USING (user_id_clean, book_id)")
def rejoin(d):
    side = d.features.select("user_id_clean", "book_id", "adjusted_average_rating")
    return d.predictions.join(side, ["user_id_clean", "book_id"]).select("user_id_clean", "book_id", "predicted_rating", "adjusted_average_rating")


@on_tables("j14_group_stat_join", """
SELECT book_era, count(*) AS row_count, r4(avg(user_avg_rating_vs_book - m)) AS mean_residual, r4(stddev_samp(user_avg_rating_vs_book - m)) AS std_residual
FROM feats JOIN (SELECT book_era, avg(user_avg_rating_vs_book) AS m FROM feats GROUP BY 1) USING (book_era) GROUP BY 1""")
def group_stat_join(d):
    out = shrink(d.features, "Book Era", _era(), 1.0)
    residual = F.col("user_avg_rating_vs_book") - F.col("group_mean")
    return out.groupBy("book_era").agg(F.count(F.lit(1)).alias("row_count"), F.avg(residual).alias("mean_residual"), F.stddev_samp(residual).alias("std_residual"))


@on_tables("j15_scalar_subquery", "SELECT book_id, r4(average_rating - (SELECT avg(average_rating) FROM cl_books)) AS gap FROM cl_books")
def scalar_subquery(d):
    spark = d.raw.books.sparkSession
    return spark.sql("SELECT book_id, average_rating - (SELECT avg(average_rating) FROM {b}) AS gap FROM {b}", b=d.books)


@on_tables("j16_before_after_groups", """
SELECT b.slice_value, r4(b.m) AS avg_rating_before, r4(b.m - 0.5 * (b.m - g.m)) AS avg_rating_after FROM
  (SELECT book_era AS slice_value, avg(user_avg_rating_vs_book) AS m FROM feats GROUP BY 1) b CROSS JOIN (SELECT avg(user_avg_rating_vs_book) AS m FROM feats) g""")
def before_after_groups(d):
    before = group_metrics(d.features, _era()).select(F.col("slice_group").alias("slice_value"), F.col("mean_rating").alias("avg_rating_before"))
    shrunk = shrink(d.features, "Book Era", _era(), 0.5)
    after = group_metrics(shrunk, _era(), "rating_debiased").select(F.col("slice_group").alias("slice_value"), F.col("mean_rating").alias("avg_rating_after"))
    return before.join(after, "slice_value")


# ---- aggregates ---------------------------------------------------------------------------------------

@on_tables("a1_book_reading_times", "SELECT book_id, r4(avg_book_reading_time) AS avg_book_reading_time, num_readers_with_time FROM book_times")
def reading_times(d):
    return features.book_reading_times(_timed(d))


USER_SQL = """SELECT user_id_clean, num_books_read, r4(avg_rating_given) AS avg_rating_given, user_activity_count, recent_activity_days,
  r4(user_avg_reading_time_days) AS user_avg_reading_time_days FROM user_feats"""


@on_tables("a2_user_features", USER_SQL)
def user_features(d):
    return features.user_features(_timed(d), d.raw.as_of)


@on_tables("a3_conditional_counts", """
SELECT book_id, count(*) FILTER (WHERE is_read) AS reads, r4(avg(CASE WHEN rating > 0 THEN rating END)) AS avg_positive, count(CASE WHEN read_at = '' THEN 1 END) AS undated
FROM fx_interactions GROUP BY 1""")
def conditional(d):
    return d.raw.interactions.groupBy("book_id").agg(
        F.count_if("is_read").alias("reads"), F.avg(F.when(F.col("rating") > 0, F.col("rating"))).alias("avg_positive"), F.count_if(F.col("read_at") == "").alias("undated"))


@on_tables("a4_rating_quantile", "SELECT r4(quantile_disc(adjusted_average_rating, 0.8)) AS rating_threshold FROM books0")
def quantile(d):
    return features.rating_threshold(_books0(d))


@on_tables("a4_rating_quantile_approximate")
def quantile_approximate(d):
    return features.rating_threshold(_books0(d), exact=False)


@on_tables("a4_rating_quantile_sketch", "SELECT count(adjusted_average_rating) AS books, TRUE AS threshold_within FROM books0")
def quantile_sketch(d):
    """The same threshold from sketches of parts of the books, held against the ranks in the rows."""
    mark, rating = {"threshold": GREAT_QUANTILE}, F.col("adjusted_average_rating")
    rows = _books0(d).select("adjusted_average_rating", F.pmod(F.xxhash64("book_id"), F.lit(16)).alias("part"), "book_id")
    found = sketches.merged(sketches.of_days(rows, ["part"], rating, F.col("book_id"), F.current_date()), [], mark)
    checks = sketches.within_rank(rows, [], rating, found.select("threshold"), mark)
    return found.select(F.col("n_values").alias("books")).crossJoin(F.broadcast(checks))


@on_tables("a5_distinct_counts", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT book_id) AS books, count(DISTINCT interaction_type) AS kinds FROM fx_interactions")
def distinct_counts(d):
    return d.raw.interactions.agg(F.count_distinct("user_id").alias("users"), F.count_distinct("book_id").alias("books"), F.count_distinct("interaction_type").alias("kinds"))


@on_tables("a6_author_names", "SELECT book_id, author_names FROM names")
def author_names(d):
    return recommend.author_names(recommend.author_links(d.raw.books), d.raw.authors)


@on_tables("a7_any_title", "SELECT book_id, min(title) AS title FROM fx_books GROUP BY 1")
def any_title(d):
    return recommend.book_titles(d.raw.books)


@on_tables("a8_first_known_author", "SELECT author, count(*) AS books FROM one_author GROUP BY 1")
def first_known(d):
    return recommend.book_author(recommend.author_links(d.raw.books), d.raw.authors).groupBy("author").agg(F.count(F.lit(1)).alias("books"))


@on_tables("a9_error_metrics", "SELECT count(*) AS num_predictions, r4(avg(abs(error))) AS mae, r4(sqrt(avg(error * error))) AS rmse, r4(avg(predicted_rating)) AS mean_predicted, r4(avg(actual_rating)) AS mean_actual FROM preds")
def error_metrics(d):
    return scoring.error_metrics(d.predictions)


EXTENDED = """count(*) AS num_predictions, r4(avg(abs(error))) AS mae, r4(sqrt(avg(error * error))) AS rmse, r4(avg(predicted_rating)) AS mean_predicted, r4(avg(actual_rating)) AS mean_actual,
  r4(stddev_samp(error)) AS std_error, r4(corr(actual_rating, predicted_rating)) AS correlation, r4(var_samp(actual_rating)) AS variance_actual, r4(var_samp(predicted_rating)) AS variance_predicted,
  count(*) FILTER (WHERE abs(error) <= 0.5) AS within_0_5, count(*) FILTER (WHERE abs(error) <= 1.0) AS within_1_0, count(*) FILTER (WHERE abs(error) <= 1.5) AS within_1_5,
  r4(pow(corr(actual_rating, predicted_rating), 2)) AS r_squared, r4(100.0 * count(*) FILTER (WHERE abs(error) <= 0.5) / count(*)) AS accuracy_within_0_5_pct,
  r4(100.0 * count(*) FILTER (WHERE abs(error) <= 1.0) / count(*)) AS accuracy_within_1_0_pct, r4(100.0 * count(*) FILTER (WHERE abs(error) <= 1.5) / count(*)) AS accuracy_within_1_5_pct"""


@on_tables("a10_extended_metrics", f"SELECT {EXTENDED} FROM preds")
def extended(d):
    return scoring.extended_metrics(d.predictions)


@on_tables("a11_monitoring_metrics", """
SELECT book_era, count(*) AS num_predictions, r4(avg(abs(error))) AS mae, r4(sqrt(avg(error * error))) AS rmse, r4(pow(corr(actual_rating, predicted_rating), 2)) AS r_squared,
  r4(corr(actual_rating, predicted_rating)) AS correlation, r4(100.0 * count(*) FILTER (WHERE abs(error) <= 0.5) / count(*)) AS accuracy_within_0_5,
  r4(100.0 * count(*) FILTER (WHERE abs(error) <= 1.0) / count(*)) AS accuracy_within_1_0 FROM preds GROUP BY 1""")
def monitored(d):
    return scoring.monitoring_metrics(d.predictions, ["book_era"])


@query("a12_metric_history", """
SELECT strftime(timestamp, '%Y-%m-%d') AS date, model_name, metric_name, r4(avg(metric_value)) AS avg_value, r4(min(metric_value)) AS min_value, r4(max(metric_value)) AS max_value
FROM fx_history WHERE timestamp >= TIMESTAMP '2024-01-01' GROUP BY ALL ORDER BY 1 DESC, 2, 3 LIMIT 500""")
def metric_history(spark, sf_dir):
    return monitoring.metric_history(adapters.metric_history(spark, sf_dir), adapters.EVENTS_AS_OF)


@query("a13_window_stats", "SELECT model_name, metric_name, r4(baseline_avg) AS baseline_avg, r4(baseline_std) AS baseline_std, r4(recent_avg) AS recent_avg, r4(recent_std) AS recent_std FROM decay_stats")
def window_stats(spark, sf_dir):
    return monitoring.window_stats(adapters.metric_history(spark, sf_dir), adapters.EVENTS_AS_OF)


@on_tables("a14_weight_stats", """
SELECT r4(min(w)) AS min_weight, r4(max(w)) AS max_weight, r4(avg(w)) AS mean_weight, r4(stddev_samp(w)) AS std_weight
FROM (SELECT 1.0 / (n / (SELECT count(*) FROM feats)) AS w FROM feats JOIN (SELECT book_era, count(*) AS n FROM feats GROUP BY 1) USING (book_era))""")
def weights(d):
    return weight_stats(reweight(d.features, "Book Era", _era()))


@on_tables("a15_grouped_means", """
SELECT 'Book Era' AS slice_dimension, book_era AS slice_value, r4(avg(user_avg_rating_vs_book)) AS avg_rating, r4(avg(CASE WHEN is_read THEN 1 ELSE 0 END)) AS pct_read, count(*) AS row_count FROM feats GROUP BY 2
UNION ALL SELECT 'Reading Pace', reading_pace_category, r4(avg(user_avg_rating_vs_book)), r4(avg(CASE WHEN is_read THEN 1 ELSE 0 END)), count(*) FROM feats GROUP BY 2""")
def grouped(d):
    return grouped_means(d.features, [("Book Era", _era()), ("Reading Pace", F.col("reading_pace_category"))]).drop("n", "gap_sum")


@on_tables("a16_distinct_entities", """
SELECT 'users' AS entity, count(*) AS row_count FROM (SELECT DISTINCT user_id_clean, num_books_read, avg_rating_given, user_activity_count, recent_activity_days, user_avg_reading_time_days FROM feats)
UNION ALL SELECT 'books', count(DISTINCT book_id) FROM feats""")
def entities(d):
    return tables.row_counts({"users": features.distinct_user_features(d.features), "books": features.distinct_book_features(d.features)}).select(
        F.col("table_type").alias("entity"), F.col("record_count").alias("row_count"))


# ---- windows and top-k -----------------------------------------------------------------------------------

@on_tables("w1_latest_per_key", "SELECT user_id, book_id, review_id FROM in_latest")
def latest_per_key(d):
    return cleaning.latest_interactions(cleaning.without_views(d.raw.interactions)).select("user_id", "book_id", "review_id")


@query("w2_priority_then_recency", """
SELECT user_id, book_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, book_id ORDER BY CASE event_type WHEN 'like' THEN 3 WHEN 'add_to_list' THEN 2 WHEN 'click' THEN 1 ELSE 0 END DESC, event_timestamp DESC, event_id DESC) AS rn
  FROM fx_events WHERE event_type <> 'view') WHERE rn = 1""")
def priority_recency(spark, sf_dir):
    return etl.strongest_events(adapters.events(spark, sf_dir)).select("user_id", "book_id", "event_id")


@on_tables("w3_min_max_scaling", "SELECT book_id, r4(book_popularity_normalized) AS book_popularity_normalized FROM book_final")
def min_max(d):
    return features.final_books(tables.stage(_books0(d))).select("book_id", "book_popularity_normalized")


def _ranked(d):
    top = recommend.mean_model_ranking(d.mean_model.users.select(F.col("user_id_clean").alias("user_id")), recommend.reads(d.raw.interactions), d.mean_model)
    names = recommend.author_names(recommend.author_links(d.raw.books), d.raw.authors)
    stats = d.features.select("book_id", "average_rating").distinct()
    return recommend.with_details(tables.stage(top), recommend.book_titles(d.raw.books), names, stats)


_DETAILS = """(SELECT x.*, b.title, coalesce(n.author_names, 'Unknown Author') AS author_names, s.average_rating FROM best50 x LEFT JOIN fx_books b USING (book_id)
  LEFT JOIN names n USING (book_id) LEFT JOIN (SELECT DISTINCT book_id, average_rating FROM feats) s USING (book_id))"""
COLLAPSED = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, title, author_names ORDER BY rank) AS edition FROM {_DETAILS}) WHERE edition = 1)"""


@on_tables("w4_one_edition", f"SELECT user_id, book_id, title, author_names, rank FROM {COLLAPSED}")
def one_edition(d):
    return recommend.one_edition(_ranked(d)).select("user_id", "book_id", "title", "author_names", "rank")


@on_tables("w5_rank_all", "SELECT user_id, book_id, rank, r4(predicted_rating) AS predicted_rating FROM best50")
def rank_all(d):
    users = d.mean_model.users.select(F.col("user_id_clean").alias("user_id"))
    return recommend.mean_model_ranking(users, recommend.reads(d.raw.interactions), d.mean_model)


@on_tables("w6_rank_per_user", """
SELECT user_id_clean AS user_id, book_id, r4(predicted_rating) AS predicted_rating, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id_clean ORDER BY round(predicted_rating, 9) DESC, book_id) AS rank FROM preds) WHERE rank <= 10""")
def rank_per_user(d):
    rows = d.predictions.select(F.col("user_id_clean").alias("user_id"), "book_id", "predicted_rating")
    return top_per_key(rows, ["user_id"], [F.desc(F.round("predicted_rating", 9)), F.col("book_id")], 10)


@query("w7_latest_metrics", """
SELECT model_name, metric_name, round(metric_value, 4) AS metric_value, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name, metric_name ORDER BY timestamp DESC) AS rn FROM fx_history WHERE timestamp >= TIMESTAMP '2024-01-24') WHERE rn = 1""")
def latest_metrics(spark, sf_dir):
    return monitoring.latest_metrics(adapters.metric_history(spark, sf_dir), adapters.EVENTS_AS_OF)


def _author(d):
    return recommend.book_author(recommend.author_links(d.raw.books), d.raw.authors)


@on_tables("k1_global_top10", "SELECT book_id, r4(average_rating) AS average_rating, title_clean, author, ratings_count FROM top10")
def global_top(d):
    return recommend.global_top(d.books, _author(d))


@on_tables("k2_cold_start_list", "SELECT book_id, r4(average_rating) AS predicted_rating, title_clean AS title, author FROM top10")
def cold_start_list(d):
    return recommend.cold_start_list(recommend.global_top(d.books, _author(d)))


UNREAD = """(SELECT * FROM (SELECT u.user_id, b.book_id, b.title_clean, b.average_rating, b.ratings_count, row_number() OVER (PARTITION BY u.user_id ORDER BY b.average_rating DESC, b.book_id) AS unseen_rank
  FROM users u CROSS JOIN cl_books b WHERE NOT EXISTS (SELECT 1 FROM read_pairs r WHERE r.user_id = u.user_id AND r.book_id = b.book_id)) WHERE unseen_rank <= 50)"""


@on_tables("k3_top_unread", f"SELECT user_id, book_id, unseen_rank FROM {UNREAD}")
def top_unread(d):
    items = d.books.select("book_id", "average_rating")
    return recommend.unread_in_order(d.raw.interactions.select("user_id"), recommend.reads(d.raw.interactions), items,
                                     [-F.col("average_rating"), F.col("book_id")]).select("user_id", "book_id", "unseen_rank")


@on_tables("k4_first_ten_editions", f"SELECT user_id, book_id, title FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS place FROM {COLLAPSED}) WHERE place <= 10")
def first_ten(d):
    kept = recommend.one_edition(_ranked(d))
    return top_per_key(kept, ["user_id"], [F.col("rank")], 10, "place").select("user_id", "book_id", "title")


@query("k5_drift_history", """
SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, model_name AS feature_name, r4(metric_value) AS baseline_mean, r4(metric_value + 1) AS current_mean, r4(0.2) AS ks_pvalue,
  r4(metric_value / 7) AS psi_score, metric_value > 7 AS drift_detected FROM (
  SELECT * FROM fx_history WHERE metric_name = 'mae' AND timestamp >= TIMESTAMP '2024-01-24' ORDER BY timestamp DESC, model_name LIMIT 500)""")
def drift_history(spark, sf_dir):
    return monitoring.drift_history(adapters.drift_log(spark, sf_dir), adapters.EVENTS_AS_OF)


@on_tables("k6_top_risks", 'SELECT slice, slice_dimension, slice_value, r4(mae) AS mae, r4(mae_deviation_pct) AS mae_deviation_pct, "count" FROM risks ORDER BY mae_deviation_pct DESC, slice LIMIT 3')
def top_three(d):
    return top_risks(high_risk(tables.stage(slice_metrics(d.predictions))))


@on_tables("k7_validation_sample", "SELECT user_id_clean, book_id, rating FROM split_feats WHERE split = 'val' ORDER BY md5(concat_ws('/', user_id_clean, book_id, 42)), user_id_clean, book_id LIMIT 5000")
def validation_sample(d):
    return tables.hashed_sample(d.split.where(F.col("split") == "val"), ["user_id_clean", "book_id"], 5000).select("user_id_clean", "book_id", "rating")


@query("k8_union_all", "SELECT user_id, count(*) AS row_count FROM (SELECT user_id FROM fx_interactions UNION ALL SELECT user_id FROM fx_events) GROUP BY 1")
def union_all(spark, sf_dir):
    both = adapters.interactions(spark, sf_dir).select("user_id").unionByName(adapters.events(spark, sf_dir).select("user_id"))
    return both.groupBy("user_id").agg(F.count(F.lit(1)).alias("row_count"))


@query("k9_latest_models", """
SELECT prefix, model_name, strftime(created, '%Y-%m-%d %H:%M:%S.%f') AS created FROM (
  SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY created DESC, model_name DESC) AS rn FROM fx_registry) WHERE rn = 1""")
def latest_models(spark, sf_dir):
    return scoring.latest_models(adapters.model_registry(spark, sf_dir))
