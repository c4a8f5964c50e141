"""The deterministic mean-deviation scorer, prediction tables and error metrics."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.numbers import share
from foliospark.functions.text import first_author_id
from foliospark.operators.ordered import exact_percentiles
from foliospark.settings import RMSE_GATE

SLICE_COLUMNS = ["book_popularity_normalized", "book_length_category", "book_era", "num_genres", "user_activity_count",
                 "reading_pace_category", "average_rating", "ratings_count", "num_pages", "publication_year"]


class MeanModel(NamedTuple):
    """Global mean (one row), mean per user and mean per book."""

    overall: DataFrame
    users: DataFrame
    books: DataFrame


def fit_means(ratings: DataFrame) -> MeanModel:
    rating = F.col("rating").cast("double")
    return MeanModel(
        ratings.agg(F.avg(rating).alias("mu")),
        ratings.groupBy("user_id_clean").agg(F.avg(rating).alias("user_mean")),
        ratings.groupBy("book_id").agg(F.avg(rating).alias("book_mean")),
    )


def score(rows: DataFrame, model: MeanModel) -> DataFrame:
    """``mu + (user mean - mu) + (book mean - mu)``; an unseen user or book deviates by nothing."""
    mu = F.col("mu")
    joined = (rows.join(model.users, "user_id_clean", "left").join(model.books, "book_id", "left")
              .crossJoin(F.broadcast(model.overall)))
    predicted = mu + F.coalesce(F.col("user_mean") - mu, F.lit(0.0)) + F.coalesce(F.col("book_mean") - mu, F.lit(0.0))
    return joined.withColumn("predicted_rating", predicted).drop("mu", "user_mean", "book_mean")


def author_group_of_books(cleaned_books: DataFrame, gender_map: DataFrame) -> DataFrame:
    """Book -> first author -> gender group."""
    authors = gender_map.select("author_id", "author_gender_group")
    return cleaned_books.select("book_id", first_author_id(F.col("authors_flat")).alias("author_id")).join(
        authors, "author_id", "left").select("book_id", "author_gender_group")


def prediction_table(scored: DataFrame, cleaned_books: DataFrame, gender_map: DataFrame) -> DataFrame:
    """Predictions with their errors and every slicing column."""
    actual, predicted = F.col("rating").cast("double"), F.col("predicted_rating")
    return scored.join(author_group_of_books(cleaned_books, gender_map), "book_id", "left").select(
        "user_id_clean", "book_id", actual.alias("actual_rating"), predicted.alias("predicted_rating"),
        F.abs(actual - predicted).alias("absolute_error"), (actual - predicted).alias("error"),
        *SLICE_COLUMNS, "author_gender_group")


def _complete(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("actual_rating").isNotNull() & F.col("predicted_rating").isNotNull())


def _aggregates() -> dict[str, Column]:
    a, p = F.col("actual_rating"), F.col("predicted_rating")
    e = a - p
    return {
        "num_predictions": F.count(F.lit(1)), "mae": F.avg(F.abs(e)), "rmse": F.sqrt(F.avg(e * e)),
        "mean_predicted": F.avg(p), "mean_actual": F.avg(a), "std_error": F.stddev_samp(e), "correlation": F.corr(a, p),
        "variance_actual": F.var_samp(a), "variance_predicted": F.var_samp(p),
        "within_0_5": F.count_if(F.abs(e) <= 0.5), "within_1_0": F.count_if(F.abs(e) <= 1.0),
        "within_1_5": F.count_if(F.abs(e) <= 1.5),
    }


def error_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, MAE, RMSE and the mean predicted and actual rating."""
    wanted = ["num_predictions", "mae", "rmse", "mean_predicted", "mean_actual"]
    aggregates = _aggregates()
    return _complete(predictions).groupBy(*by).agg(*[aggregates[w].alias(w) for w in wanted])


def extended_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``error_metrics`` with spread, squared correlation and the share of errors within three tolerances."""
    out = _complete(predictions).groupBy(*by).agg(*[c.alias(n) for n, c in _aggregates().items()])
    n = F.col("num_predictions")
    return out.withColumns({
        "r_squared": F.pow("correlation", F.lit(2)),
        **{f"accuracy_{w}_pct": share(F.col(w), n) * 100 for w in ("within_0_5", "within_1_0", "within_1_5")},
    })


def monitoring_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metrics kept in the history; an undefined correlation counts as 0."""
    m = extended_metrics(predictions, by)
    return m.select(*by, "num_predictions", "mae", "rmse", F.coalesce("r_squared", F.lit(0.0)).alias("r_squared"),
                    F.coalesce("correlation", F.lit(0.0)).alias("correlation"),
                    F.col("accuracy_within_0_5_pct").alias("accuracy_within_0_5"),
                    F.col("accuracy_within_1_0_pct").alias("accuracy_within_1_0"))


def regression_report(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, MSLE (rows above -1 only), median absolute error, R2 and explained variance."""
    rows = _complete(predictions)
    a, p = F.col("actual_rating"), F.col("predicted_rating")
    e = a - p
    loggable = (a > -1) & (p > -1)
    log_gap = F.when(loggable, F.log1p(F.when(loggable, a)) - F.log1p(F.when(loggable, p)))
    main = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_predictions"), F.avg(F.abs(e)).alias("mean_absolute_error"), F.avg(e * e).alias("mean_squared_error"),
        F.avg(log_gap * log_gap).alias("mean_squared_log_error"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(a))).alias("r2_score"),
        (1 - F.try_divide(F.var_pop(e), F.var_pop(a))).alias("explained_variance"))
    median = exact_percentiles(rows, by, F.abs(e), {"median_absolute_error": 0.5})
    return main.join(median, list(by)) if by else main.crossJoin(F.broadcast(median))


def validation_gate(report: DataFrame, threshold: float = RMSE_GATE) -> DataFrame:
    """Approve a model whose validation RMSE is within the threshold; one row."""
    rmse = F.sqrt(F.max(F.when(F.col("split") == "val", F.col("mean_squared_error"))))
    return report.agg(rmse.alias("validation_rmse")).withColumn(
        "approved", F.coalesce(F.col("validation_rmse") <= threshold, F.lit(False)))


def latest_models(registry: DataFrame) -> DataFrame:
    """Most recent model per name prefix."""
    return registry.groupBy("prefix").agg(F.max(F.struct("created", "model_name")).alias("_m")).select(
        "prefix", F.col("_m.model_name").alias("model_name"), F.col("_m.created").alias("created"))
