"""Fixed values that results depend on. They are stated plainly and kept in one place."""

# ---- cleaning and quality bounds -------------------------------------------------------------
MIN_PAGES, MAX_PAGES = 10, 2000
MIN_YEAR, MAX_YEAR = 1900, 2025
UNKNOWN = "Unknown"
EVENT_TYPES = ("click", "view", "like", "add_to_list")

# ---- feature constants -------------------------------------------------------------------------
MIN_READING_DAYS, MAX_READING_DAYS = 1, 365
DEFAULT_PAGES = 300
DEFAULT_READING_DAYS = 14
DEFAULT_BOOK_AGE = 5
DEFAULT_RECENCY_DAYS = 365
DEFAULT_RATING = 3.0
DEFAULT_PAGES_PER_DAY = 25
WILSON_Z = 1.96
GREAT_QUANTILE = 0.8

# ---- weights and priorities ----------------------------------------------------------------------
INTERACTION_WEIGHTS = {"read": 5, "like": 4, "add_to_list": 3, "click": 1}
EVENT_PRIORITY = {"like": 3, "add_to_list": 2, "click": 1}

# ---- (upper bound, label) ladders; a value above the last bound takes the final label -------------
READING_PACE = ([(7, "quick_read"), (14, "moderate"), (30, "long_read")], "very_long")
BOOK_LENGTH = ([(200, "short"), (350, "medium"), (500, "long")], "very_long")
BOOK_ERA = ([(2, "new_release"), (5, "recent"), (10, "contemporary"), (20, "modern")], "classic")

# ---- scoring-time defaults (they differ from the training-time ones on purpose) ---------------------
SCORING_DEFAULTS = {
    "num_books_read": 0, "avg_rating_given": 3.0, "user_activity_count": 0, "recent_activity_days": 365,
    "user_avg_reading_time_days": 14.0, "title_clean": "", "average_rating": 0.0,
    "adjusted_average_rating": 0.0, "great": False, "ratings_count": 0, "log_ratings_count": 0.0,
    "popularity_score": 0, "book_popularity_normalized": 0.0, "num_genres": 0, "is_series": False,
    "title_length_in_characters": 0, "title_length_in_words": 0, "description_length": 0, "num_pages": 300,
    "publication_year": 2000, "book_age_years": 20, "book_length_category": "medium",
    "book_era": "contemporary", "avg_pages_per_day": 25.0, "avg_book_reading_time_days": 14.0,
    "num_readers_with_reading_time": 0, "reading_pace_category": "moderate",
}
SCORING_INTERACTION_WEIGHT = 3
SCORING_READING_DAYS = 14.0

USER_FEATURES = ["num_books_read", "avg_rating_given", "user_activity_count", "recent_activity_days",
                 "user_avg_reading_time_days"]
BOOK_FEATURES = ["title_clean", "average_rating", "adjusted_average_rating", "great", "ratings_count",
                 "log_ratings_count", "popularity_score", "book_popularity_normalized", "num_genres",
                 "is_series", "title_length_in_characters", "title_length_in_words", "description_length",
                 "num_pages", "publication_year", "book_age_years", "book_length_category", "book_era",
                 "avg_pages_per_day", "avg_book_reading_time_days", "num_readers_with_reading_time",
                 "reading_pace_category"]
CROSS_FEATURES = ["user_avg_rating_vs_book", "user_reading_speed_ratio", "user_pages_per_day_this_book"]
NOT_MODEL_INPUT = ["user_id_clean", "book_id", "rating", "is_read", "user_days_to_read", "user_book_recency"]
CATEGORY_FEATURES = ["book_era", "book_length_category", "reading_pace_category", "author_gender_group"]

# ---- audit thresholds --------------------------------------------------------------------------------
CV_MEDIUM, CV_HIGH, CV_ADVICE, MAE_RANGE_LIMIT = 0.15, 0.25, 0.2, 0.3
HIGH_RISK_FACTOR = 1.2
SEVERITY_PENALTY = {"high": 20, "medium": 10}

# ---- monitoring thresholds ---------------------------------------------------------------------------
CTR_THRESHOLD = 0.20
SLOW_REQUEST_MS = 1000.0
DECAY_RMSE_PCT, DECAY_R2_DROP = 10.0, 0.05
DRIFT_KS_P, DRIFT_PSI, DRIFT_MEAN_SHIFT = 0.05, 0.2, 2.0
PSI_BINS, PSI_EMPTY_SHARE, STD_FLOOR = 10, 0.0001, 0.001
RMSE_GATE = 3.0
