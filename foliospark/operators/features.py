"""Book, user and interaction features, their normalisation and the leak-free split."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import labels
from foliospark.functions.dates import any_time, activity_time, days_since, reading_days
from foliospark.functions.numbers import log_step, share, split_bucket, wilson_rating
from foliospark.functions.text import element_count, word_count
from foliospark.operators.ordered import exact_percentiles
from foliospark.settings import (
    BOOK_FEATURES, CROSS_FEATURES, DEFAULT_BOOK_AGE, DEFAULT_PAGES, DEFAULT_PAGES_PER_DAY, DEFAULT_RATING,
    DEFAULT_READING_DAYS, DEFAULT_RECENCY_DAYS, GREAT_QUANTILE, INTERACTION_WEIGHTS, NOT_MODEL_INPUT,
    SCORING_DEFAULTS, SCORING_READING_DAYS, USER_FEATURES,
)
from foliospark.sources.tables import stage


def with_times(interactions: DataFrame, iso_dates: bool = True) -> DataFrame:
    """Parse each date text once: reading span, finish time and last update."""
    parse = any_time if iso_dates else activity_time
    return interactions.withColumns({
        "_read": parse(F.col("read_at_clean")), "_started": parse(F.col("started_at_clean")),
        "_updated": parse(F.col("date_updated_clean")),
    }).withColumn("_days", reading_days(F.col("_started"), F.col("_read")))


def book_reading_times(timed: DataFrame) -> DataFrame:
    """Mean plausible reading days per book, and the number of readers with both dates."""
    dated = F.col("_read").isNotNull() & F.col("_started").isNotNull()
    return timed.where("is_read").groupBy("book_id").agg(
        F.avg("_days").alias("avg_book_reading_time"), F.count_if(dated).alias("num_readers_with_time"))


def base_books(cleaned_books: DataFrame, reading_times: DataFrame, as_of: dt.date) -> DataFrame:
    year = F.lit(as_of.year)
    votes = F.coalesce("ratings_count", F.lit(0))
    title = F.coalesce("title_clean", F.lit(""))
    published = F.coalesce("publication_year", year - DEFAULT_BOOK_AGE)
    books = cleaned_books.where(F.col("book_id").isNotNull()).join(reading_times, "book_id", "left")
    return books.select(
        "book_id", title.alias("title_clean"),
        F.coalesce("average_rating", F.lit(0.0)).alias("average_rating"), votes.alias("ratings_count"),
        F.coalesce("text_reviews_count", F.lit(0)).alias("text_reviews_count"),
        F.log1p(votes).alias("log_ratings_count"),
        (votes + F.coalesce("text_reviews_count", F.lit(0))).alias("popularity_score"),
        F.length(title).alias("title_length_in_characters"), word_count(title).alias("title_length_in_words"),
        F.length(F.coalesce("description_clean", F.lit(""))).alias("description_length"),
        element_count(F.col("popular_shelves_flat")).alias("num_genres"),
        (element_count(F.col("series_flat")) > 0).alias("is_series"),
        F.coalesce("num_pages", F.lit(DEFAULT_PAGES)).alias("num_pages"), published.alias("publication_year"),
        (year - published).alias("book_age_years"),
        F.coalesce("avg_book_reading_time", F.lit(float(DEFAULT_READING_DAYS))).alias("avg_book_reading_time_days"),
        F.coalesce("num_readers_with_time", F.lit(0)).alias("num_readers_with_reading_time"),
        wilson_rating(F.col("average_rating"), F.col("ratings_count")).alias("adjusted_average_rating"),
    )


def rating_threshold(books: DataFrame, exact: bool = True) -> DataFrame:
    """One row: the adjusted rating that marks a great book."""
    if exact:
        return exact_percentiles(books, [], F.col("adjusted_average_rating"), {"rating_threshold": GREAT_QUANTILE}, "discrete")
    return books.agg(F.percentile_approx("adjusted_average_rating", GREAT_QUANTILE, 10000).alias("rating_threshold"))


def final_books(books: DataFrame, exact: bool = True) -> DataFrame:
    """Add the table-wide marks (great, scaled popularity) and the categories.

    The table-wide values are three aggregates, read as one row and put into the plan as constants: no window spans
    the table, and nothing is joined.
    """
    span = books.agg(F.min("popularity_score").alias("low"), F.max("popularity_score").alias("high"))
    facts = span.crossJoin(F.broadcast(rating_threshold(books, exact))).first()
    low, high, threshold = (facts["low"], facts["high"], facts["rating_threshold"]) if facts else (None, None, None)
    spread = None if low is None or high == low else high - low
    scaled = share(F.col("popularity_score") - F.lit(low), F.lit(spread))
    return books.withColumns({
        "great": F.coalesce(F.col("adjusted_average_rating") >= F.lit(threshold), F.lit(False)),
        "book_popularity_normalized": F.coalesce(scaled, F.lit(0.5)),
        "reading_pace_category": labels.reading_pace(F.col("avg_book_reading_time_days")),
        "book_length_category": labels.book_length(F.col("num_pages")),
        "avg_pages_per_day": F.coalesce(share(F.col("num_pages"), F.col("avg_book_reading_time_days")),
                                        F.lit(float(DEFAULT_PAGES_PER_DAY))),
        "book_era": labels.book_era(F.col("book_age_years")),
    })


def user_features(timed: DataFrame, as_of: dt.date) -> DataFrame:
    rating = F.col("rating")
    return timed.where(F.col("user_id_clean").isNotNull()).groupBy("user_id_clean").agg(
        F.count_if("is_read").alias("num_books_read"),
        F.coalesce(F.avg(F.when(rating > 0, rating)), F.lit(DEFAULT_RATING)).alias("avg_rating_given"),
        F.count("book_id").alias("user_activity_count"),
        days_since(as_of, F.max("_updated"), DEFAULT_RECENCY_DAYS).alias("recent_activity_days"),
        F.coalesce(F.avg("_days"), F.lit(float(DEFAULT_READING_DAYS))).alias("user_avg_reading_time_days"),
    )


def interaction_features(timed: DataFrame, as_of: dt.date) -> DataFrame:
    return timed.where(F.col("user_id_clean").isNotNull() & F.col("book_id").isNotNull()).select(
        "user_id_clean", "book_id", F.coalesce("rating", F.lit(0)).alias("rating"),
        F.coalesce("is_read", F.lit(False)).alias("is_read"),
        labels.lookup(F.col("interaction_type_clean"), INTERACTION_WEIGHTS, 0).alias("interaction_weight"),
        F.coalesce("_days", F.lit(DEFAULT_READING_DAYS)).alias("user_days_to_read"),
        days_since(as_of, F.col("_read"), DEFAULT_RECENCY_DAYS).alias("user_book_recency"),
    )


def cross_features() -> dict[str, Column]:
    return {
        "user_avg_rating_vs_book": F.coalesce(F.col("avg_rating_given") - F.col("adjusted_average_rating"), F.lit(0.0)),
        "user_reading_speed_ratio": F.coalesce(share(F.col("user_days_to_read"), F.col("avg_book_reading_time_days")), F.lit(1.0)),
        "user_pages_per_day_this_book": F.coalesce(share(F.col("num_pages"), F.col("user_days_to_read")),
                                                   F.lit(float(DEFAULT_PAGES_PER_DAY))),
    }


def eligible(as_of: dt.date) -> Column:
    c = F.col
    return ((c("num_books_read") > 0) & (c("ratings_count") > 0) & (c("num_pages") > 0)
            & (c("publication_year") > 1900) & (c("publication_year") <= as_of.year))


def merge_features(interactions: DataFrame, users: DataFrame, books: DataFrame) -> DataFrame:
    """Interaction x user x book, with the cross features; column order is that of the feature table."""
    merged = interactions.join(users, "user_id_clean").join(books, "book_id").withColumns(cross_features())
    return merged.select(*interactions.columns, *USER_FEATURES, *BOOK_FEATURES, *CROSS_FEATURES)


def build_features(cleaned_books: DataFrame, cleaned_interactions: DataFrame, as_of: dt.date, exact: bool = True,
                   iso_dates: bool = True) -> DataFrame:
    """The full 37-column feature table.

    The inputs should be stored tables: the interactions are read three times, each time for a few columns. The row
    filters on books and users run before the joins, so they shrink both sides of the shuffles.
    """
    timed = with_times(cleaned_interactions, iso_dates)
    base = stage(base_books(cleaned_books, book_reading_times(timed), as_of), "base_books")
    books = final_books(base, exact)
    merged = merge_features(interaction_features(timed, as_of), user_features(timed, as_of), books)
    return merged.where(eligible(as_of))


def log_transform(features: DataFrame) -> DataFrame:
    """Replace skewed counts by their rounded logarithm; non-positive reading days become NULL."""
    c = F.col

    def positive(name: str) -> Column:
        return F.when(c(name) > 0, log_step(c(name))).otherwise(c(name).cast("bigint")).alias(name)

    changed = {
        "popularity_score": log_step(c("popularity_score")), "user_activity_count": log_step(c("user_activity_count")),
        "description_length": log_step(c("description_length")), "num_books_read": positive("num_books_read"),
        "user_days_to_read": F.when(c("user_days_to_read") > 0, log_step(c("user_days_to_read"), 0)),
        "ratings_count": positive("ratings_count"), "num_pages": positive("num_pages"),
    }
    return features.withColumns(changed)


def centre_ratings(features: DataFrame) -> DataFrame:
    """Retype the rating to a double and subtract the user's mean."""
    return features.withColumn("rating", F.col("rating").cast("double") - F.col("avg_rating_given"))


def normalise(features: DataFrame) -> DataFrame:
    return centre_ratings(log_transform(features))


def split_bounds(train: float, validation: float, test: float) -> tuple[int, int]:
    """Bucket bounds: train below the first, test from the second on."""
    if abs(train + validation + test - 1.0) > 1e-9:
        raise ValueError("split ratios must sum to 1")
    return int(train * 100), int((train + validation) * 100)


def with_split(features: DataFrame, train: float = 0.7, validation: float = 0.15, test: float = 0.15) -> DataFrame:
    """Label each row train, val or test by its user's bucket: one pass, no user in two splits."""
    first, second = split_bounds(train, validation, test)
    bucket = split_bucket(F.col("user_id_clean"))
    return features.withColumn("split", F.when(bucket < first, "train").when(bucket < second, "val").otherwise("test"))


def model_inputs(columns: list[str]) -> list[str]:
    """Feature columns of a training table: everything but ids, the label and columns that leak it."""
    return [c for c in columns if c not in NOT_MODEL_INPUT]


def scoring_features(pairs: DataFrame, users: DataFrame, books: DataFrame) -> DataFrame:
    """Features of not-yet-read (user, book) pairs, with the scoring-time defaults."""
    return with_scoring_defaults(pairs.join(users, "user_id_clean").join(books, "book_id"))


def with_scoring_defaults(joined: DataFrame) -> DataFrame:
    """Defaults and cross features of rows that have user and book features."""
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in SCORING_DEFAULTS.items()
                                 if c not in ("avg_book_reading_time_days", "num_pages")})
    days = F.col("avg_book_reading_time_days")
    return filled.withColumns({
        "user_avg_rating_vs_book": F.col("avg_rating_given") - F.col("adjusted_average_rating"),
        "user_reading_speed_ratio": F.coalesce(share(F.lit(SCORING_READING_DAYS), F.nullif(days, F.lit(0.0))), F.lit(1.0)),
        "user_pages_per_day_this_book": F.coalesce(F.col("num_pages") / F.lit(SCORING_READING_DAYS), F.lit(25.0)),
        "avg_book_reading_time_days": F.coalesce(days, F.lit(SCORING_DEFAULTS["avg_book_reading_time_days"])),
        "num_pages": F.coalesce("num_pages", F.lit(SCORING_DEFAULTS["num_pages"])),
        "interaction_weight": F.lit(3),
    })


def distinct_users(features: DataFrame) -> DataFrame:
    return features.select("user_id_clean").distinct()


def distinct_user_features(features: DataFrame) -> DataFrame:
    return features.select("user_id_clean", *USER_FEATURES).distinct()


def distinct_book_features(features: DataFrame) -> DataFrame:
    return features.where(F.col("book_id").isNotNull()).select("book_id", *BOOK_FEATURES).distinct()
