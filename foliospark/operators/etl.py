"""Event migration, backfill and upserts of interactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.dates import activity_text, activity_time, any_time, instant_text
from foliospark.functions.labels import lookup
from foliospark.operators.ordered import latest_by
from foliospark.settings import EVENT_PRIORITY
from foliospark.sources.tables import stage

INTERACTION_COLUMNS = ["user_id", "book_id", "review_id", "date_added", "date_updated", "read_at", "started_at",
                       "is_read", "rating", "review_text_incomplete", "interaction_type"]


def priority(event_type: Column) -> Column:
    return lookup(event_type, EVENT_PRIORITY, 0)


def strongest_events(events: DataFrame) -> DataFrame:
    """One non-view event per (user, book): highest priority, then most recent. The book id is compared as written."""
    kept = events.where(F.col("event_type") != "view")
    return latest_by(kept, ["user_id", "book_id"], [priority(F.col("event_type")), F.col("event_timestamp")])


def to_interactions(events: DataFrame) -> DataFrame:
    """Events in the shape of the interaction table, with defaults in the fields that events lack."""
    seen = instant_text(F.col("event_timestamp"))
    blank = F.lit("")
    return events.select(
        "user_id", F.col("book_id").try_cast("bigint").alias("book_id"), blank.alias("review_id"),
        seen.alias("date_added"), seen.alias("date_updated"), blank.alias("read_at"), blank.alias("started_at"),
        F.lit(False).alias("is_read"), F.lit(0).cast("bigint").alias("rating"), blank.alias("review_text_incomplete"),
        F.col("event_type").alias("interaction_type"))


def migrate_events(events: DataFrame) -> DataFrame:
    return to_interactions(strongest_events(events))


def backfill_type(interactions: DataFrame) -> DataFrame:
    """Fill missing interaction types from the read flag and the rating."""
    guess = F.when(F.col("is_read"), "read").when(F.col("rating") > 0, "like").otherwise("add_to_list")
    return interactions.withColumn("interaction_type", F.coalesce(F.col("interaction_type"), guess))


def known_books_only(source: DataFrame, books: DataFrame) -> DataFrame:
    return source.join(books.select("book_id"), "book_id", "left_semi").select(*source.columns)


def upsert_reads(target: DataFrame, source: DataFrame) -> DataFrame:
    """Merge read marks (``user_id, book_id, rating, read_time``) into the interactions.

    A match on (user, book) sets six fields; a new pair is inserted with defaults. The source counts
    once per pair, its latest mark winning. Two joins in place of a full outer one: both let few marks be broadcast, so
    the large target is not shuffled, and both can split a hot key.
    """
    keys = ["user_id", "book_id"]
    marks = stage(latest_by(source.select(*keys, "rating", "read_time"), keys, [F.col("read_time")]).select(
        *keys, F.coalesce("rating", F.lit(0)).cast("bigint").alias("_rating"), activity_text(F.col("read_time")).alias("_now")), "marks")
    now = F.col("_now")
    changed = {
        "rating": F.col("_rating"), "date_updated": now, "read_at": now, "date_added": now,
        "is_read": F.lit(True), "interaction_type": F.lit("read"),
    }
    hit = now.isNotNull()
    updated = target.join(marks, keys, "left").select(
        *[F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in target.columns])
    matched = target.select(*keys).join(marks.select(*keys), keys, "left_semi").distinct()
    fresh = {**changed, "started_at": F.lit(""), "review_text_incomplete": F.lit("")}
    types = dict(target.dtypes)
    inserted = marks.join(matched, keys, "left_anti").select(
        *[F.col(c) if c in keys else fresh.get(c, F.lit(None)).cast(types[c]).alias(c) for c in target.columns])
    return updated.unionByName(inserted)


def from_event(interactions_type: Column, date_updated: Column) -> Column:
    """Whether a row was made from an event: it has an event's type and the migration's date text."""
    return interactions_type.isin(*EVENT_PRIORITY) & date_updated.isNotNull() & activity_time(date_updated).isNull() & date_updated.try_cast("timestamp").isNotNull()


def resolve(rows: DataFrame) -> DataFrame:
    """One row per (user, book). Rows made from events compete by priority, then time; the best of them replaces a stored interaction only if it
    happened later. Times are compared as times: the table holds two kinds of date text.
    """
    keys = ["user_id", "book_id"]
    event = from_event(F.col("interaction_type"), F.col("date_updated"))
    timed = rows.select(*INTERACTION_COLUMNS, F.coalesce(any_time(F.col("date_updated")), F.lit("0001-01-01").cast("timestamp")).alias("_at"), F.coalesce(event, F.lit(False)).alias("_event"))
    best = latest_by(timed, [*keys, "_event"], [F.when(F.col("_event"), priority(F.col("interaction_type"))).otherwise(0), F.col("_at")])
    return latest_by(best, keys, [F.col("_at"), ~F.col("_event")]).select(*INTERACTION_COLUMNS)


def merge_events(target: DataFrame, events: DataFrame) -> DataFrame:
    """The interaction table with migrated events in it."""
    return resolve(target.select(*INTERACTION_COLUMNS).unionByName(to_interactions(events).select(*INTERACTION_COLUMNS)))
