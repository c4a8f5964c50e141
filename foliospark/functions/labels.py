"""Category labels and audit slices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.settings import BOOK_ERA, BOOK_LENGTH, READING_PACE


def ladder(value: Column, steps: tuple[list[tuple[float, str]], str]) -> Column:
    """Label of the first step whose upper bound holds the value; otherwise (and for NULL) the last label."""
    bounds, last = steps
    out = None
    for bound, label in bounds:
        hit = value <= bound
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(last))


def from_top(value: Column, steps: list[tuple[float, str]], last: str) -> Column:
    """Label of the first lower bound that the value reaches."""
    out = None
    for bound, label in steps:
        hit = value >= bound
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(last))


def lookup(value: Column, table: dict[str, int], default: int) -> Column:
    out = None
    for key, mapped in table.items():
        hit = value == key
        out = F.when(hit, F.lit(mapped)) if out is None else out.when(hit, F.lit(mapped))
    return out.otherwise(F.lit(default))


def reading_pace(days: Column) -> Column:
    return ladder(days, READING_PACE)


def book_length(pages: Column) -> Column:
    return ladder(pages, BOOK_LENGTH)


def book_era(age: Column) -> Column:
    return ladder(age, BOOK_ERA)


def audit_slices() -> list[tuple[str, Column]]:
    """The eight audit dimensions over a prediction table."""
    c = F.col
    return [
        ("Popularity", from_top(c("book_popularity_normalized"), [(0.66, "High"), (0.33, "Medium")], "Low")),
        ("Book Length", c("book_length_category")),
        ("Book Era", c("book_era")),
        ("Genre Diversity", from_top(c("num_genres"), [(5, "Multi-genre"), (2, "Some genres")], "Single/No genre")),
        ("User Activity", from_top(c("user_activity_count"), [(50, "High"), (10, "Medium")], "Low")),
        ("Reading Pace", c("reading_pace_category")),
        ("Author Gender", c("author_gender_group")),
        ("Rating Range", from_top(c("actual_rating"), [(4.0, "High (4-5)"), (3.0, "Medium (3-4)")], "Low (1-3)")),
    ]


def feature_slices() -> list[tuple[str, Column]]:
    """The dimensions that need no prediction, for audits of the feature table itself."""
    return [s for s in audit_slices() if s[0] not in ("Author Gender", "Rating Range")]


DIMENSION_ORDER = [name for name in ("Popularity", "Book Length", "Book Era", "Genre Diversity", "User Activity",
                                     "Reading Pace", "Author Gender", "Rating Range")]


def dimension_rank(dimension: Column) -> Column:
    """Position of a dimension in the audit order; unknown dimensions come last."""
    position = F.array_position(F.array(*[F.lit(d) for d in DIMENSION_ORDER]), dimension)
    return F.when(position > 0, position).otherwise(F.lit(len(DIMENSION_ORDER) + 1))
