"""Feature engineering, normalisation and the split."""

from pyspark.sql import functions as F

from catalog.registry import on_tables
from foliospark.operators import features, recommend
from foliospark.settings import BOOK_FEATURES, USER_FEATURES
from foliospark.sources import tables

_DOUBLES = {"avg_rating_given", "user_avg_reading_time_days", "average_rating", "adjusted_average_rating", "log_ratings_count", "book_popularity_normalized",
            "avg_pages_per_day", "avg_book_reading_time_days", "user_avg_rating_vs_book", "user_reading_speed_ratio", "user_pages_per_day_this_book"}
COLUMNS = ["user_id_clean", "book_id", "rating", "is_read", "interaction_weight", "user_days_to_read", "user_book_recency", *USER_FEATURES, *BOOK_FEATURES,
           "user_avg_rating_vs_book", "user_reading_speed_ratio", "user_pages_per_day_this_book"]


def _sql(columns, extra_doubles=()):
    return ", ".join(f"r4({c}) AS {c}" if c in _DOUBLES or c in extra_doubles else (f"CAST({c} AS BIGINT) AS {c}" if c == "interaction_weight" else c) for c in columns)


def _timed(d):
    return features.with_times(d.interactions)


def _base(d):
    return features.base_books(d.books, features.book_reading_times(_timed(d)), d.raw.as_of)


def _final(d):
    return features.final_books(tables.stage(_base(d), "base_books"))


_BASE = ["book_id", "title_clean", "average_rating", "ratings_count", "text_reviews_count", "log_ratings_count", "popularity_score", "title_length_in_characters", "title_length_in_words",
         "description_length", "num_genres", "is_series", "num_pages", "publication_year", "book_age_years", "avg_book_reading_time_days", "num_readers_with_reading_time", "adjusted_average_rating"]


@on_tables("f1_book_base", f"SELECT {_sql(_BASE)} FROM books0")
def book_base(d):
    return _base(d)


@on_tables("f2_adjusted_rating", "SELECT book_id, r4(adjusted_average_rating) AS adjusted_average_rating FROM books0")
def adjusted(d):
    return _base(d).select("book_id", "adjusted_average_rating")


@on_tables("f3_great_books", "SELECT book_id, great FROM book_final")
def great(d):
    return _final(d).select("book_id", "great")


@on_tables("f4_scaled_popularity", "SELECT book_id, r4(book_popularity_normalized) AS book_popularity_normalized FROM book_final")
def popularity(d):
    return _final(d).select("book_id", "book_popularity_normalized")


@on_tables("f5_pages_per_day", "SELECT book_id, r4(avg_pages_per_day) AS avg_pages_per_day FROM book_final")
def pages_per_day(d):
    return _final(d).select("book_id", "avg_pages_per_day")


@on_tables("f6_reading_pace", "SELECT book_id, reading_pace_category FROM book_final")
def pace(d):
    return _final(d).select("book_id", "reading_pace_category")


@on_tables("f7_book_length", "SELECT book_id, book_length_category FROM book_final")
def length(d):
    return _final(d).select("book_id", "book_length_category")


@on_tables("f8_book_era", "SELECT book_id, book_era FROM book_final")
def era(d):
    return _final(d).select("book_id", "book_era")


@on_tables("f9_interaction_weight", "SELECT user_id_clean, book_id, CAST(interaction_weight AS BIGINT) AS interaction_weight FROM inter_feats")
def weight(d):
    return features.interaction_features(_timed(d), d.raw.as_of).select("user_id_clean", "book_id", "interaction_weight")


@on_tables("f10_user_features", f"SELECT {_sql(['user_id_clean', *USER_FEATURES])} FROM user_feats")
def users(d):
    return features.user_features(_timed(d), d.raw.as_of)


@on_tables("f11_interaction_features", f"SELECT {_sql(COLUMNS[:7])} FROM inter_feats")
def interactions(d):
    return features.interaction_features(_timed(d), d.raw.as_of)


@on_tables("f12_cross_features", f"SELECT user_id_clean, book_id, {_sql(COLUMNS[-3:])} FROM merged")
def cross(d):
    timed = _timed(d)
    merged = features.merge_features(features.interaction_features(timed, d.raw.as_of), features.user_features(timed, d.raw.as_of), _final(d))
    return merged.select("user_id_clean", "book_id", *COLUMNS[-3:])


@on_tables("f13_feature_table", f"SELECT {_sql(COLUMNS)} FROM feats")
def feature_table(d):
    return features.build_features(d.books, d.interactions, d.raw.as_of)


@on_tables("f14_log_transform", f"SELECT {_sql(COLUMNS)} FROM log_feats")
def log_transform(d):
    return features.log_transform(d.features)


@on_tables("f15_centred_ratings", f"SELECT {_sql(COLUMNS, ['rating'])} FROM norm_feats")
def centred(d):
    return d.normalised


@on_tables("f16_user_split", "SELECT user_id_clean, book_id, split FROM split_feats")
def user_split(d):
    return d.split.select("user_id_clean", "book_id", "split")


@on_tables("f16_split_sizes", "SELECT split, count(*) AS row_count, count(DISTINCT user_id_clean) AS users FROM split_feats GROUP BY 1")
def split_sizes(d):
    """Written once, partitioned by split, and read back per split."""
    from foliospark.session import work_folder

    path = f"{work_folder(d.raw.books.sparkSession)}/splits"
    stored = tables.replace(d.split, path, ["split"])
    return stored.groupBy("split").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("user_id_clean").alias("users"))


@on_tables("f17_author_gender", "SELECT author_id, name, author_gender_group FROM gender_map")
def gender(d):
    return recommend.author_gender_map(d.raw.authors, d.raw.name_genders)


def scored_candidates(d):
    """Each user's 50 best unread books with their scoring-time features, and the books that are listed: few, as all users rank alike."""
    users_ = d.mean_model.users.select(F.col("user_id_clean").alias("user_id"))
    top = tables.stage(recommend.mean_model_ranking(users_, recommend.reads(d.raw.interactions), d.mean_model), "ranked")
    pairs = top.select(F.col("user_id").alias("user_id_clean"), "book_id", "predicted_rating", "rank")
    books = tables.stage(features.distinct_book_features(d.features).join(top.select("book_id").distinct(), "book_id", "left_semi"), "listed_books")
    return features.scoring_features(pairs, features.distinct_user_features(d.features), books), books


SCORED = """(SELECT x.user_id, x.book_id, x.rank, x.predicted_rating, u.avg_rating_given, u.num_books_read, b.* EXCLUDE (book_id),
    u.avg_rating_given - b.adjusted_average_rating AS user_avg_rating_vs_book, coalesce(14.0 / nullif(b.avg_book_reading_time_days, 0), 1.0) AS user_reading_speed_ratio,
    coalesce(b.num_pages / 14.0, 25.0) AS user_pages_per_day_this_book, 3 AS interaction_weight
  FROM best50 x JOIN user_feats u ON x.user_id = u.user_id_clean JOIN book_final b USING (book_id))"""


REQUESTED = """(SELECT u.user_id_clean AS user_id, b.book_id FROM user_feats u CROSS JOIN (SELECT DISTINCT book_id FROM feats) b
  WHERE CAST(u.user_id_clean[2:] AS BIGINT) % 20 = 0 AND NOT EXISTS (SELECT 1 FROM read_pairs r WHERE r.user_id = u.user_id_clean AND r.book_id = b.book_id))"""


UNREAD = """(SELECT u.user_id_clean AS user_id, b.book_id FROM user_feats u CROSS JOIN (SELECT DISTINCT book_id FROM feats) b
  WHERE NOT EXISTS (SELECT 1 FROM read_pairs r WHERE r.user_id = u.user_id_clean AND r.book_id = b.book_id))"""


@on_tables("f18_scoring_features", f"""
SELECT user_id_clean, book_id, num_books_read, r4(avg_rating_given) AS avg_rating_given, book_era, num_pages, great, r4(avg_rating_given - adjusted_average_rating) AS user_avg_rating_vs_book,
  r4(coalesce(14.0 / nullif(avg_book_reading_time_days, 0), 1.0)) AS user_reading_speed_ratio, r4(coalesce(num_pages / 14.0, 25.0)) AS user_pages_per_day_this_book, CAST(3 AS BIGINT) AS interaction_weight
FROM {UNREAD} x JOIN user_feats u ON x.user_id = u.user_id_clean JOIN book_final b USING (book_id)""")
def scoring_features(d):
    """Every unread book of every user, with its scoring-time features."""
    users = tables.stage(features.user_features(_timed(d), d.raw.as_of), "user_features")
    books = tables.stage(features.distinct_book_features(d.features), "book_features")
    rows = recommend.unread_rows(users.withColumnRenamed("user_id_clean", "user_id"), books, recommend.reads(d.raw.interactions)).withColumnRenamed("user_id", "user_id_clean")
    return features.with_scoring_defaults(rows).select("user_id_clean", "book_id", "num_books_read", "avg_rating_given", "book_era", "num_pages", "great", "user_avg_rating_vs_book",
                                                                  "user_reading_speed_ratio", "user_pages_per_day_this_book", "interaction_weight")
