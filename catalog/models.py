"""Models, scoring and recommendations."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.features import REQUESTED, SCORED, scored_candidates
from catalog.registry import on_tables, query
from catalog.relations import COLLAPSED, UNREAD, _author, _ranked
from foliospark.functions.numbers import split_bucket
from foliospark.operators import ensemble, features, models, recommend, scoring
from foliospark.sources import adapters, tables


def _ratings(d):
    return d.rated.select("user_id_clean", "book_id", "rating")


def _train(d):
    return d.split.where(F.col("split") == "train")


_HELD_OUT = "CAST('0x' || substr(md5('mf-' || user_id_clean || '/' || book_id), 1, 8) AS BIGINT) % 100 >= 90"


@on_tables("m1_factorisation", f"""
SELECT count(*) FILTER (WHERE NOT h) AS train_rows, count(*) FILTER (WHERE h) AS held_out_rows, count(*) FILTER (WHERE h AND ku AND kb) AS scored_rows, TRUE AS fits_better_than_mean FROM (
  SELECT h, max(NOT h) OVER (PARTITION BY user_id_clean) AS ku, max(NOT h) OVER (PARTITION BY book_id) AS kb
  FROM (SELECT user_id_clean, book_id, {_HELD_OUT} AS h FROM feats WHERE rating > 0))""")
def factorisation(d):
    """Fit on nine tenths of the ratings with 25 factors and 40 iterations; the others are scored once each where user and book are known."""
    bucket = split_bucket(F.concat(F.lit("mf-"), "user_id_clean", F.lit("/"), F.col("book_id").cast("string")))
    ratings = tables.stage(_ratings(d).withColumn("held_out", bucket >= 90), "ratings")
    train, rest = ratings.where("NOT held_out").drop("held_out"), ratings.where("held_out").drop("held_out")
    fitted = models.fit_factors(train)
    error = F.col("rating") - F.col("predicted_rating")
    fit = models.score_factors(train, fitted).agg(F.avg(error * error).alias("mse"), F.var_pop("rating").alias("variance"))
    scored = models.score_factors(rest, fitted).agg(F.count(F.lit(1)).alias("scored_rows"))
    sizes = ratings.agg(F.count_if(~F.col("held_out")).alias("train_rows"), F.count_if("held_out").alias("held_out_rows"))
    return sizes.crossJoin(F.broadcast(scored)).crossJoin(F.broadcast(fit)).select("train_rows", "held_out_rows", "scored_rows", (F.col("mse") < F.col("variance")).alias("fits_better_than_mean"))


@on_tables("m2_boosted_trees", "SELECT split, count(*) AS scored_rows, TRUE AS in_range FROM split_feats WHERE rating > 0 GROUP BY 1")
def boosted_trees(d):
    """Fit on the train split until the held-out users stop it; every rated row of each split is scored once. The errors have no SQL form, so their bounds are given."""
    rows = tables.stage(d.split.where(F.col("rating") > 0), "rated_split")
    fitted = models.fit_trees(rows.where(F.col("split") == "train"))
    scored = models.score_trees(rows, fitted)
    return scored.groupBy("split").agg(F.count(F.lit(1)).alias("scored_rows"), F.bool_and(F.col("predicted_rating").between(-2, 8)).alias("in_range"))


@on_tables("m3_mean_deviation_scores", "SELECT user_id_clean, book_id, r4(actual_rating) AS actual_rating, r4(predicted_rating) AS predicted_rating, r4(absolute_error) AS absolute_error, author_gender_group, book_era FROM preds")
def mean_scores(d):
    return d.predictions.select("user_id_clean", "book_id", "actual_rating", "predicted_rating", "absolute_error", "author_gender_group", "book_era")


REPORT = """count(*) AS num_predictions, r4(avg(abs(a - p))) AS mean_absolute_error, r4(avg((a - p) * (a - p))) AS mean_squared_error,
  r4(avg(CASE WHEN a > -1 AND p > -1 THEN pow(ln(1 + a) - ln(1 + p), 2) END)) AS mean_squared_log_error, r4(1 - avg((a - p) * (a - p)) / var_pop(a)) AS r2_score,
  r4(1 - var_pop(a - p) / var_pop(a)) AS explained_variance, r4(quantile_cont(abs(a - p), 0.5)) AS median_absolute_error"""


@on_tables("m4_regression_report", f"SELECT {REPORT} FROM (SELECT actual_rating AS a, predicted_rating AS p FROM preds)")
def regression_report(d):
    return scoring.regression_report(d.predictions)


_SPLIT_SCORED = """(SELECT s.split, CAST(s.rating AS DOUBLE) AS a, mu + coalesce(user_mean - mu, 0) + coalesce(book_mean - mu, 0) AS p
  FROM (SELECT * FROM split_feats WHERE rating > 0) s CROSS JOIN (SELECT avg(rating) AS mu FROM split_feats WHERE rating > 0 AND split = 'train')
  LEFT JOIN (SELECT user_id_clean, avg(rating) AS user_mean FROM split_feats WHERE rating > 0 AND split = 'train' GROUP BY 1) USING (user_id_clean)
  LEFT JOIN (SELECT book_id, avg(rating) AS book_mean FROM split_feats WHERE rating > 0 AND split = 'train' GROUP BY 1) USING (book_id))"""


def _by_split(d):
    rows = tables.stage(d.split.where(F.col("rating") > 0), "rated_split")
    model = scoring.fit_means(rows.where(F.col("split") == "train"))
    scored = scoring.score(rows, model).withColumn("actual_rating", F.col("rating").cast("double"))
    return scoring.regression_report(tables.stage(scored.select("split", "actual_rating", "predicted_rating"), "scored"), ["split"])


@on_tables("m5_report_by_split", f"SELECT split, {REPORT} FROM {_SPLIT_SCORED} GROUP BY 1")
def report_by_split(d):
    return _by_split(d)


@on_tables("m5_validation_gate", f"SELECT r4(sqrt(avg((a - p) * (a - p)))) AS validation_rmse, sqrt(avg((a - p) * (a - p))) <= 3.0 AS approved FROM {_SPLIT_SCORED} WHERE split = 'val'")
def validation_gate(d):
    return scoring.validation_gate(_by_split(d))


@on_tables("m6_prediction_table", """
SELECT user_id_clean, book_id, r4(actual_rating) AS actual_rating, r4(predicted_rating) AS predicted_rating, r4(absolute_error) AS absolute_error, r4(error) AS error,
  r4(book_popularity_normalized) AS book_popularity_normalized, book_length_category, book_era, num_genres, user_activity_count, reading_pace_category, r4(average_rating) AS average_rating,
  ratings_count, num_pages, publication_year, author_gender_group FROM preds""")
def prediction_table(d):
    return d.predictions


@on_tables("m6_tree_predictions")
def tree_predictions(d):
    """Trees fitted on the train split score the test split."""
    rows = tables.stage(d.split.where(F.col("rating") > 0), "rated_split")
    fitted = models.fit_trees(rows.where(F.col("split") == "train"))
    scored = models.score_trees(rows.where(F.col("split") == "test"), fitted)
    return scoring.prediction_table(scored, d.books, d.gender_map)


@on_tables("m7_scored_sample", f"""
SELECT user_id_clean, book_id, rating, r4(p) AS predicted_rating FROM {_SPLIT_SCORED.replace("SELECT s.split,", "SELECT user_id_clean, book_id, s.rating, s.split,")} WHERE split = 'val'
ORDER BY md5(concat_ws('/', user_id_clean, book_id, 42)), user_id_clean, book_id LIMIT 5000""")
def scored_sample(d):
    rated = tables.stage(d.split.where(F.col("rating") > 0), "rated_split")
    model = scoring.fit_means(rated.where(F.col("split") == "train"))
    sample = tables.hashed_sample(rated.where((F.col("split") == "val") & (F.col("rating") > 0)), ["user_id_clean", "book_id"], 5000)
    return scoring.score(sample, model).select("user_id_clean", "book_id", "rating", "predicted_rating")


def _factor_lists(d):
    fitted = models.fit_factors(tables.stage(_ratings(d), "ratings"))
    return tables.stage(models.factor_recommendations(fitted, recommend.reads(d.raw.interactions)), "ranked")


@on_tables("m8_factor_recommendations")
def factor_recommendations(d):
    """Top unread books of every user under the factor model, with titles and authors, one edition each."""
    names = recommend.author_names(recommend.author_links(d.raw.books), d.raw.authors)
    stats = d.features.select("book_id", "average_rating").distinct()
    return recommend.one_edition(recommend.with_details(_factor_lists(d).drop("compared"), recommend.book_titles(d.raw.books), names, stats))


@on_tables("m8_factor_list_facts", """
SELECT user_id, least(count(*), 50) AS listed, CAST(0 AS BIGINT) AS read_books, TRUE AS ranks_follow_scores, (SELECT count(DISTINCT book_id) FROM feats WHERE rating > 0) AS books, TRUE AS compared_at_most_all
FROM (SELECT u.user_id_clean AS user_id, b.book_id FROM (SELECT DISTINCT user_id_clean FROM feats WHERE rating > 0) u CROSS JOIN (SELECT DISTINCT book_id FROM feats WHERE rating > 0) b
  WHERE NOT EXISTS (SELECT 1 FROM read_pairs r WHERE r.user_id = u.user_id_clean AND r.book_id = b.book_id)) GROUP BY 1""")
def factor_list_facts(d):
    """Per user: as many books as can be, none of them read, in the order of their scores, and compared with no more books than there are."""
    books = _ratings(d).agg(F.count_distinct("book_id").alias("books"))
    read = recommend.reads(d.raw.interactions).withColumn("_read", F.lit(1))
    ahead = F.lag("predicted_rating").over(Window.partitionBy("user_id").orderBy("rank"))
    rows = _factor_lists(d).withColumn("_ok", F.coalesce(ahead >= F.col("predicted_rating"), F.lit(True))).join(read, ["user_id", "book_id"], "left")
    lists = rows.groupBy("user_id").agg(F.count_distinct("book_id").alias("listed"), F.count("_read").alias("read_books"),
                                        (F.bool_and("_ok") & (F.max("rank") == F.count(F.lit(1)))).alias("ranks_follow_scores"), F.max("compared").alias("_compared"))
    return lists.crossJoin(F.broadcast(books)).select("user_id", "listed", "read_books", "ranks_follow_scores", "books", (F.col("_compared") <= F.col("books")).alias("compared_at_most_all"))


@on_tables("m8_mean_recommendations", f"""
SELECT user_id, book_id, title, author_names, r4(average_rating) AS rating, r4(predicted_rating) AS predicted_rating FROM {COLLAPSED}""")
def mean_recommendations(d):
    return recommend.one_edition(_ranked(d)).select("user_id", "book_id", "title", "author_names", F.col("average_rating").alias("rating"), "predicted_rating")


def _tree_lists(d):
    """The 50 best unread books, under trees fitted on the train split, of the users whose number is divisible by 20, out of all books."""
    rated = tables.stage(d.split.where(F.col("rating") > 0), "rated_split")
    fitted = models.fit_trees(rated.where(F.col("split") == "train"))
    users, books = features.distinct_user_features(d.features), tables.stage(features.distinct_book_features(d.features), "book_features")
    requested = users.where(F.substring("user_id_clean", 2, 20).cast("bigint") % 20 == 0)
    return tables.stage(ensemble.top_unread(fitted, rated, tables.stage(requested, "requested"), books, recommend.reads(d.raw.interactions)), "tree_lists")


@on_tables("m9_tree_recommendations")
def tree_recommendations(d):
    """The scores of trees have no SQL form; the tests compare the lists with the scores of all pairs, and ``m9_tree_list_facts`` states what SQL can."""
    return _tree_lists(d)


@on_tables("m9_tree_list_facts", f"""
SELECT user_id, least(count(*), 50) AS listed, CAST(0 AS BIGINT) AS read_books, TRUE AS ranks_follow_scores FROM {REQUESTED} GROUP BY 1""")
def tree_list_facts(d):
    """Per user: as many books as can be, none of them read, in the order of their scores, ties by id."""
    top = _tree_lists(d)
    read = recommend.reads(d.raw.interactions).withColumn("_read", F.lit(1))
    before = Window.partitionBy("user_id").orderBy("rank")
    ahead, id_ahead = F.lag("predicted_rating").over(before), F.lag("book_id").over(before)
    in_order = ahead.isNull() | (ahead > F.col("predicted_rating")) | ((ahead == F.col("predicted_rating")) & (id_ahead < F.col("book_id")))
    rows = top.withColumn("_ok", in_order).join(read, ["user_id", "book_id"], "left")
    return rows.groupBy("user_id").agg(F.count_distinct("book_id").alias("listed"), F.count("_read").alias("read_books"), (F.bool_and("_ok") & (F.max("rank") == F.count(F.lit(1)))).alias("ranks_follow_scores"))


@on_tables("m9_tree_featured_lists")
def tree_featured_lists(d):
    """The lists with titles, authors and book features, one edition each."""
    names = recommend.author_names(recommend.author_links(d.raw.books), d.raw.authors)
    books = features.distinct_book_features(d.features).select("book_id", F.col("title_clean").alias("title"), F.col("average_rating").alias("rating"), "ratings_count", "num_pages", "publication_year",
                                                              "book_popularity_normalized", "book_length_category", "book_era")
    rows = _tree_lists(d).join(books, "book_id").join(names, "book_id", "left").withColumn("author_names", F.coalesce("author_names", F.lit(recommend.NO_AUTHOR)))
    return recommend.one_edition(rows)


@on_tables("m9_featured_recommendations", f"""
SELECT user_id, book_id, author_names, r4(predicted_rating) AS predicted_rating, rank, title_clean AS title, r4(average_rating) AS rating, ratings_count, num_pages, publication_year,
  r4(book_popularity_normalized) AS book_popularity_normalized, book_length_category, book_era FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, title_clean, author_names ORDER BY rank) AS edition FROM (
    SELECT s.*, coalesce(n.author_names, 'Unknown Author') AS author_names FROM {SCORED} s LEFT JOIN names n USING (book_id))) WHERE edition = 1""")
def featured_recommendations(d):
    names = recommend.author_names(recommend.author_links(d.raw.books), d.raw.authors)
    rows, books = scored_candidates(d)
    # Names and features of the listed books alone are small enough to be sent, so the rows are not shuffled for them.
    listed = tables.stage(names.join(books, "book_id", "left_semi"), "listed_names")
    rows = rows.join(listed, "book_id", "left").withColumnsRenamed({"user_id_clean": "user_id", "title_clean": "title", "average_rating": "rating"})
    rows = rows.withColumn("author_names", F.coalesce("author_names", F.lit(recommend.NO_AUTHOR)))
    return recommend.one_edition(rows.select("user_id", "book_id", "author_names", "predicted_rating", "rank", "title", "rating", "ratings_count", "num_pages",
                                             "publication_year", "book_popularity_normalized", "book_length_category", "book_era"))


@query("m10_served_lists", f"""
SELECT user_id, book_id, r4(average_rating) AS predicted_rating, 'personal' AS source FROM {COLLAPSED} WHERE rank <= 10 AND user_id IN (SELECT concat('u', c_custkey) FROM customer)
UNION ALL SELECT q.user_id, t.book_id, r4(t.average_rating), 'global' FROM (
  SELECT concat('u', c_custkey) AS user_id FROM customer UNION SELECT concat('n', c_nationkey) FROM customer) q CROSS JOIN top10 t WHERE q.user_id NOT IN (SELECT user_id_clean FROM feats)""")
def served_lists(spark, sf_dir):
    from catalog.base import derived

    d = derived(spark, sf_dir)
    customers = adapters.table(spark, sf_dir, "customer")
    requested = customers.select(F.concat(F.lit("u"), "c_custkey").alias("user_id")).union(customers.select(F.concat(F.lit("n"), "c_nationkey"))).distinct()
    known = d.features.select(F.col("user_id_clean").alias("user_id")).distinct()
    personal = recommend.one_edition(_ranked(d)).withColumnRenamed("average_rating", "rating")
    cold = recommend.cold_start_list(recommend.global_top(d.books, _author(d)))
    return recommend.served_lists(requested, known, personal, tables.stage(cold, "cold_start"))


@on_tables("m11_personal_list_shape", f"""
SELECT user_id, book_id, title, author_names AS author, r4(average_rating) AS predicted_rating, r4(predicted_rating) AS model_rating FROM {COLLAPSED} WHERE rank <= 10""")
def personal_shape(d):
    """The served rating is the book's mean rating; the model's own prediction comes along."""
    rows = recommend.one_edition(_ranked(d)).where(F.col("rank") <= 10)
    return rows.select("user_id", "book_id", "title", F.col("author_names").alias("author"), F.col("average_rating").alias("predicted_rating"), F.col("predicted_rating").alias("model_rating"))


@on_tables("m12_books_read", """
SELECT i.user_id, i.book_id, b.title, r4(b.average_rating) AS average_rating, b.ratings_count, a.author,
  strftime(coalesce(try_strptime(replace(nullif(i.read_at, ''), ' +0000', ''), '%a %b %d %H:%M:%S %Y'), TIMESTAMP '2024-01-29'), '%A, %B %d %Y') AS date_read, i.read_at
FROM fx_interactions i LEFT JOIN fx_books b USING (book_id) LEFT JOIN one_author a USING (book_id) WHERE i.is_read""")
def books_read(d):
    return recommend.books_read(d.raw.interactions, d.raw.books, _author(d), adapters.EVENTS_AS_OF).orderBy("user_id", F.desc("read_at"))


@on_tables("m13_books_unread", f"SELECT x.user_id, x.unseen_rank, x.book_id, x.title_clean AS title, r4(x.average_rating) AS average_rating, x.ratings_count, a.author FROM {UNREAD} x LEFT JOIN one_author a USING (book_id)")
def books_unread(d):
    return recommend.books_unread(d.raw.interactions.select("user_id"), d.raw.interactions, d.books, _author(d))


@on_tables("m14_permutation_importance")
def permutation(d):
    rows = tables.stage(d.rated, "rated")
    fitted = models.fit_trees(rows)
    return models.permutation_importance(rows, fitted)


@on_tables("m15_category_codes", """
SELECT column_name, label, row_number() OVER (PARTITION BY column_name ORDER BY label) - 1 AS code FROM (
  SELECT DISTINCT 'book_era' AS column_name, book_era AS label FROM preds UNION SELECT DISTINCT 'book_length_category', book_length_category FROM preds
  UNION SELECT DISTINCT 'reading_pace_category', reading_pace_category FROM preds UNION SELECT DISTINCT 'author_gender_group', author_gender_group FROM preds) WHERE label IS NOT NULL""")
def codes(d):
    return models.category_codes(d.predictions)


@on_tables("m15_coded_rows", """
SELECT user_id_clean, book_id, (SELECT count(DISTINCT book_era) FROM preds q WHERE q.book_era < p.book_era) AS book_era,
  CASE WHEN author_gender_group IS NULL THEN -1 ELSE (SELECT count(DISTINCT author_gender_group) FROM preds q WHERE q.author_gender_group < p.author_gender_group) END AS author_gender_group FROM preds p""")
def coded_rows(d):
    table = tables.stage(models.category_codes(d.predictions), "codes")
    return models.with_codes(d.predictions, table).select("user_id_clean", "book_id", "book_era", "author_gender_group")


@on_tables("m16_compare_importance", """
SELECT slice_value AS feature, r4(coalesce(max(mae) FILTER (WHERE slice_dimension = 'Book Era'), 0)) AS "Book Era", r4(coalesce(max(mae) FILTER (WHERE slice_dimension = 'Reading Pace'), 0)) AS "Reading Pace"
FROM slices WHERE slice_dimension IN ('Book Era', 'Reading Pace') GROUP BY 1""")
def compare(d):
    """The pivot of two importance lists, fed with slice errors so that both engines hold the same list."""
    from foliospark.operators.bias import slice_metrics

    rows = slice_metrics(d.predictions).where(F.col("slice_dimension").isin("Book Era", "Reading Pace")).select(
        F.col("slice_dimension").alias("model_name"), F.col("slice_value").alias("feature"), F.col("mae").alias("importance"))
    return models.compare_importance(rows, ["Book Era", "Reading Pace"])


@on_tables("m16_model_importance")
def model_importance(d):
    rows = tables.stage(d.rated, "rated")
    fitted = models.fit_trees(rows)
    spark = rows.sparkSession
    impurity = spark.createDataFrame([("impurity", f, v) for f, v in models.tree_importance(fitted)], "model_name string, feature string, importance double")
    shuffled = models.permutation_importance(rows, fitted).select(F.lit("permutation").alias("model_name"), "feature", "importance")
    return models.compare_importance(impurity.unionByName(shuffled), ["impurity", "permutation"])
