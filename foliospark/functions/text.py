"""Text, array and JSON column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.settings import UNKNOWN


def clean_text(col: Column) -> Column:
    """Trim; blank and NULL become the unknown label."""
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit(UNKNOWN))


def word_count(col: Column) -> Column:
    """Number of blank-separated pieces; double blanks count an empty piece, '' counts one."""
    return F.size(F.split(col, " "))


def element_count(col: Column) -> Column:
    return F.coalesce(F.size(col), F.lit(0))


def json_elements(col: Column, element: T.DataType) -> Column:
    """NULL-free array of the elements' JSON text; a NULL array becomes an empty one."""
    kept = F.filter(F.coalesce(col, F.array().cast(T.ArrayType(element))), lambda x: x.isNotNull())
    if isinstance(element, (T.StructType, T.ArrayType, T.MapType)):
        return F.transform(kept, lambda x: F.to_json(x))

    def scalar(x: Column) -> Column:
        # to_json takes no scalars: encode a one-element array and drop its brackets.
        wrapped = F.to_json(F.array(x))
        return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)

    return F.transform(kept, scalar)


def json_field(col: Column, field: str) -> Column:
    return F.get_json_object(col, f"$.{field}")


def first_author_id(authors_flat: Column) -> Column:
    """Id of the first author in a JSON-encoded author array, NULL when absent or not a number."""
    return json_field(F.get(authors_flat, F.lit(0)), "author_id").try_cast("bigint")


def masked_path(col: Column) -> Column:
    """Replace digit-only and long path segments by ``{id}``."""
    parts = F.split(F.trim(col, F.lit("/")), "/")
    masked = F.transform(parts, lambda p: F.when(p.rlike("^[0-9]+$") | (F.length(p) > 20), F.lit("{id}")).otherwise(p))
    return F.concat(F.lit("/"), F.array_join(masked, "/"))


def display_rating(col: Column) -> Column:
    """One decimal, or N/A when the text is missing or not a number."""
    value = col.try_cast("double")
    return F.when(value.isNull(), F.lit("N/A")).otherwise(F.format_string("%.1f", value))


def slug(label: str) -> str:
    """Column-safe form of a dimension label."""
    return "_".join("".join(ch if ch.isalnum() else " " for ch in label.lower()).split())
