"""JSON catalogue, CSV samples and JSON reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CATALOGUE = ("book_id string, book_title string, title_clean string, title string, author_name string, authors_flat string, "
              "average_rating string, isbn string, isbn_clean string")


def _first_filled(*columns: str, default: str) -> Column:
    """First non-empty of several fields; the empty string counts as missing."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns], F.lit(default))


def catalogue(raw: DataFrame) -> DataFrame:
    """Book catalogue entries with their fallback chains resolved."""
    rating = F.nullif(F.col("average_rating").try_cast("double"), F.lit(0.0))
    return raw.select(
        F.coalesce("book_id", F.lit("")).alias("book_id"),
        _first_filled("book_title", "title_clean", "title", default="Unknown Title").alias("title"),
        _first_filled("author_name", "authors_flat", default="Unknown Author").alias("author"),
        F.coalesce(rating, F.lit(3.5)).alias("rating"),
        _first_filled("isbn", "isbn_clean", default="").alias("isbn"),
    )


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Line-delimited JSON catalogue."""
    return catalogue(spark.read.schema(_CATALOGUE).json(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_report(report: DataFrame, path: str) -> None:
    """Nested one-row report as JSON."""
    report.write.mode("overwrite").json(path)
