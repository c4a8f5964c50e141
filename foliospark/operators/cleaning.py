"""Schema-driven cleaning of raw books and interactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions.dates import any_time
from foliospark.functions.text import clean_text, json_elements
from foliospark.operators.ordered import latest_by
from foliospark.settings import MAX_PAGES, MAX_YEAR, MIN_PAGES, MIN_YEAR


def _cleaned(field: T.StructField) -> Column:
    col = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return clean_text(col).alias(f"{field.name}_clean")
    if isinstance(field.dataType, T.BooleanType):
        return F.coalesce(col, F.lit(False)).alias(field.name)
    if isinstance(field.dataType, T.ArrayType):
        return json_elements(col, field.dataType.elementType).alias(f"{field.name}_flat")
    return col


def clean_columns(df: DataFrame) -> DataFrame:
    """Clean every column by its type: text is trimmed, flags default to false, arrays become JSON texts."""
    return df.select(*[_cleaned(f) for f in df.schema.fields])


def clean_table(df: DataFrame, keep: Column | None = None) -> DataFrame:
    """Filter the raw rows, clean the columns and drop exact duplicates."""
    kept = df if keep is None else df.where(keep)
    return clean_columns(kept).distinct()


def plausible_book(max_year: int = MAX_YEAR) -> Column:
    """Page count and year in range; a NULL fails."""
    return F.col("num_pages").between(MIN_PAGES, MAX_PAGES) & F.col("publication_year").between(MIN_YEAR, max_year)


def clean_books(raw: DataFrame, max_year: int = MAX_YEAR) -> DataFrame:
    return clean_table(raw, plausible_book(max_year))


def without_views(raw: DataFrame) -> DataFrame:
    """Drop views, and rows of unknown type with them."""
    return raw.where(F.col("interaction_type") != "view")


def latest_interactions(raw: DataFrame, text_order: bool = False) -> DataFrame:
    """One row per (user, book): the most recently updated one.

    Recency follows the parsed update time, then its text; ``text_order`` compares the text alone.
    """
    text = F.col("date_updated")
    return latest_by(raw, ["user_id", "book_id"], [text] if text_order else [any_time(text), text])


def clean_interactions(raw: DataFrame, text_order: bool = False) -> DataFrame:
    return clean_table(latest_interactions(without_views(raw), text_order))


def of_known_books(interactions: DataFrame, cleaned_books: DataFrame, semi: bool = False) -> DataFrame:
    """Interactions whose book survived cleaning. The inner join repeats rows of duplicated books; ``semi`` does not."""
    books = cleaned_books.select("book_id")
    return interactions.join(books, "book_id", "left_semi" if semi else "inner").select(*interactions.columns)
