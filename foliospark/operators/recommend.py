"""Candidate lists, recommendations and catalogue queries, for all users at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.dates import activity_time, long_date
from foliospark.functions.text import json_field
from foliospark.operators.ordered import first_unseen, latest_by, positions, top_per_key
from foliospark.settings import UNKNOWN
from foliospark.sources.tables import stage

NO_AUTHOR = "Unknown Author"


def author_links(raw_books: DataFrame) -> DataFrame:
    """One row per (book, author id as text) of the raw author arrays."""
    return raw_books.select("book_id", F.explode("authors").alias("_a")).select("book_id", F.col("_a.author_id").cast("string").alias("author_key"))


def flat_author_links(cleaned_books: DataFrame) -> DataFrame:
    """The same from the JSON-encoded arrays of the cleaned table; ids that are no numbers become NULL."""
    return cleaned_books.select("book_id", F.explode("authors_flat").alias("_a")).select(
        "book_id", json_field(F.col("_a"), "author_id").try_cast("bigint").cast("string").alias("author_key"))


def _named(authors: DataFrame) -> DataFrame:
    return authors.select(F.col("author_id").cast("string").alias("author_key"), "name")


def author_names(links: DataFrame, authors: DataFrame) -> DataFrame:
    """All author names per book in one text, sorted, ``', '`` between them; books without a known author are absent."""
    joined = links.join(_named(authors), "author_key").where(F.col("name").isNotNull())
    return joined.groupBy("book_id").agg(F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("author_names"))


def book_author(links: DataFrame, authors: DataFrame) -> DataFrame:
    """One author per book: the first known name in text order, NULL when none is known."""
    return links.join(_named(authors), "author_key", "left").groupBy("book_id").agg(F.min("name").alias("author"))


def book_titles(raw_books: DataFrame) -> DataFrame:
    """One title per book id."""
    return raw_books.groupBy("book_id").agg(F.min("title").alias("title"))


def reads(interactions: DataFrame) -> DataFrame:
    return interactions.where("is_read").select("user_id", "book_id").distinct()


def asking(users: DataFrame, every: int = 20) -> DataFrame:
    """The users of the stated request: those whose number is divisible by ``every``."""
    return users.where(F.substring("user_id", 2, 20).cast("bigint") % every == 0)


def unread_counts(users: DataFrame, items: DataFrame, read: DataFrame) -> DataFrame:
    """How many candidates each user has: all items less those read. No pair is formed."""
    known = read.join(items.select("book_id"), "book_id", "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("_read"))
    total = items.agg(F.count(F.lit(1)).alias("_items"))
    return users.join(known, "user_id", "left").crossJoin(F.broadcast(total)).select(
        "user_id", (F.col("_items") - F.coalesce("_read", F.lit(0))).alias("candidates"))


def requested_pairs(requested: DataFrame, items: DataFrame, read: DataFrame, block: int = 8192) -> DataFrame:
    """Every unread (user, book) pair of the users in a request, whatever their number."""
    return unread_rows(requested.select("user_id").distinct(), items.select("book_id").distinct(), read, block).select("user_id", "book_id")


def unread_rows(users: DataFrame, books: DataFrame, read: DataFrame, block: int = 8192, shelf: int = 2048) -> DataFrame:
    """Every row of ``users`` (user_id and more) beside every row of ``books`` (book_id and more) that the user has not read.

    The books stand on shelves of about ``shelf``, and a user brings the places of the read ones by shelf. A task holds one shelf and a block of about ``block`` users stream past it: what is
    shuffled is users, books and reads, never a pair, and nothing passes through the driver. Few books to a task also keep its output small, as they come again for every user.
    """
    users, books = stage(users, "requested"), stage(books, "offered")
    n_users, n_books = users.count(), books.count()
    shelves = max(1, -(-n_books // shelf))
    least = -(-2 * users.sparkSession.sparkContext.defaultParallelism // shelves)
    blocks = max(1, -(-n_users // block), min(n_users, least))
    number = F.pmod(F.xxhash64(*books.columns), F.lit(shelves)).cast("int").alias("_shelf")
    shelved = stage(books.groupBy(number).agg(F.collect_list(F.struct(*books.columns)).alias("_books")), "shelves")
    places = shelved.select("_shelf", F.posexplode("_books").alias("_place", "_book")).select("_shelf", "_place", F.col("_book.book_id").alias("book_id"))
    seen = read.join(users.select("user_id"), "user_id", "left_semi").join(places, "book_id").groupBy("user_id", "_shelf").agg(F.collect_set("_place").alias("_places"))
    seen = seen.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("_shelf", "_places"))).alias("_seen"))
    asking = users.join(seen, "user_id", "left").repartition(blocks, "user_id")
    cells = asking.join(shelved.repartitionByRange(shelves, "_shelf").hint("shuffle_replicate_nl"), how="cross")
    every, taken = F.sequence(F.lit(0), F.size("_books") - 1), F.col("_seen")[F.col("_shelf")]
    free = cells.select(*users.columns, "_books", F.explode(F.when(taken.isNull(), every).otherwise(F.array_except(every, taken))).alias("_place"))
    return free.select(*users.columns, *[F.get("_books", F.col("_place"))[c].alias(c) for c in books.columns])


def ordered_items(items: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Items numbered along one shared order (unique per item)."""
    return stage(positions(items, [], order), "ordered_items")


def unread_in_order(users: DataFrame, read: DataFrame, items: DataFrame, order: Sequence[Column], k: int = 50) -> DataFrame:
    """First ``k`` unread items of every user along a shared order."""
    return first_unseen(users, read, ordered_items(items, order), "user_id", "book_id", k)


def with_details(ranked: DataFrame, titles: DataFrame, names: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach title, author names and mean rating to ranked rows."""
    return (ranked.join(titles, "book_id", "left").join(names, "book_id", "left").join(stats, "book_id", "left")
            .withColumn("author_names", F.coalesce("author_names", F.lit(NO_AUTHOR))))


def one_edition(ranked: DataFrame) -> DataFrame:
    """Keep the best-ranked edition per (user, title, authors).

    The list is already cut to each user's best rows, so a user's group is at most that long, and a row that leads
    its title there leads it everywhere.
    """
    best = ranked.groupBy("user_id", "title", "author_names").agg(F.min_by(F.struct(*ranked.columns), "rank").alias("_r"))
    return best.select("_r.*")


def mean_model_ranking(users: DataFrame, read: DataFrame, model, k: int = 50) -> DataFrame:
    """Top ``k`` unread books of every user under the mean-deviation scorer.

    Its prediction is a user term plus a book term, so every user ranks the books alike and the lists
    follow from one shared order. Exact for all users, with ``k`` rows per user.
    """
    order = [-F.col("book_mean"), F.col("book_id")]
    top = unread_in_order(users, read, model.books, order, k)
    user_means = model.users.withColumnRenamed("user_id_clean", "user_id")
    mu = F.col("mu")
    return top.join(user_means, "user_id", "left").crossJoin(F.broadcast(model.overall)).select(
        "user_id", "book_id", F.col("unseen_rank").alias("rank"),
        (mu + F.coalesce(F.col("user_mean") - mu, F.lit(0.0)) + (F.col("book_mean") - mu)).alias("predicted_rating"))


def rank_scored(scored: DataFrame, k: int = 50) -> DataFrame:
    """Top ``k`` rows per user of a scored pair table."""
    return top_per_key(scored, ["user_id"], [F.desc("predicted_rating"), F.col("book_id")], k)


def global_top(cleaned_books: DataFrame, author: DataFrame, k: int = 10) -> DataFrame:
    """Best books by rating, then votes, then id, with one author each."""
    best = cleaned_books.where(F.col("average_rating").isNotNull()).select(
        "book_id", "average_rating", "title_clean", "ratings_count").orderBy(
        F.desc("average_rating"), F.desc("ratings_count"), "book_id").limit(k)
    # The k chosen books pick their authors; the author table is not aggregated for the others.
    return best.join(author, "book_id", "left").withColumn("author", F.coalesce("author", F.lit(UNKNOWN)))


def embedded_author(cleaned_books: DataFrame) -> DataFrame:
    """Author name held inside the book row, where the source provides one."""
    return cleaned_books.select("book_id", json_field(F.get(F.col("authors_flat"), F.lit(0)), "author_name").alias("author"))


def cold_start_list(top: DataFrame) -> DataFrame:
    return top.select("book_id", F.col("average_rating").alias("predicted_rating"), F.col("title_clean").alias("title"),
                      F.coalesce("author", F.lit(UNKNOWN)).alias("author")).orderBy(F.desc("predicted_rating"), "book_id")


def served_lists(requested: DataFrame, known: DataFrame, personal: DataFrame, cold: DataFrame, k: int = 10) -> DataFrame:
    """Personal rows for known users, the global list for the others."""
    own = personal.join(requested, "user_id", "left_semi").where(F.col("rank") <= k).select(
        "user_id", "book_id", F.col("rating").alias("predicted_rating"), F.lit("personal").alias("source"))
    new = requested.join(known, "user_id", "left_anti")
    shared = cold.select("book_id", "predicted_rating").withColumn("source", F.lit("global"))
    # The cold-start list has at most ten rows, so it is sent whole to the tasks that hold the new users.
    return own.unionByName(new.crossJoin(F.broadcast(shared)).select("user_id", "book_id", "predicted_rating", "source"))


def books_read(interactions: DataFrame, raw_books: DataFrame, author: DataFrame, now: dt.datetime) -> DataFrame:
    """Read books of every user with author and written-out date, most recent (by text) first within a user."""
    fallback = F.lit(now - dt.timedelta(days=2))
    when = F.coalesce(activity_time(F.nullif(F.col("read_at"), F.lit(""))), fallback)
    rows = interactions.where("is_read").select("user_id", "book_id", "read_at", long_date(when).alias("date_read"))
    details = raw_books.select("book_id", "title", "average_rating", "ratings_count")
    return rows.join(details, "book_id", "left").join(author, "book_id", "left").select(
        "user_id", "book_id", "title", "average_rating", "ratings_count", "author", "date_read", "read_at")


def books_unread(users: DataFrame, interactions: DataFrame, cleaned_books: DataFrame, author: DataFrame, k: int = 50) -> DataFrame:
    """Best-rated unread books of every user with their author."""
    rated = cleaned_books.where(F.col("average_rating").isNotNull()).select("book_id", "title_clean", "average_rating", "ratings_count")
    one = latest_by(rated, ["book_id"], [F.col("average_rating")])
    top = unread_in_order(users, reads(interactions), one, [-F.col("average_rating"), F.col("book_id")], k)
    return top.join(author, "book_id", "left").select(
        "user_id", "unseen_rank", "book_id", F.col("title_clean").alias("title"), "average_rating", "ratings_count", "author")


def search(catalogue: DataFrame, query: str) -> DataFrame:
    """Case-insensitive substring search in title or author: 20 hits by id; an empty query lists the first 10."""
    if not query:
        return catalogue.orderBy("book_id").limit(10)
    needle = F.lit(query.lower())
    hit = F.lower("title").contains(needle) | F.lower("author").contains(needle)
    return catalogue.where(hit).orderBy("book_id").limit(20)


def known_users(requested: DataFrame, features: DataFrame) -> DataFrame:
    """Flag each requested user that has feature rows."""
    seen = features.select(F.col("user_id_clean").alias("user_id")).distinct().withColumn("_seen", F.lit(True))
    return requested.join(seen, "user_id", "left").select("user_id", F.coalesce("_seen", F.lit(False)).alias("user_exists"))


def author_gender_map(authors: DataFrame, genders: DataFrame) -> DataFrame:
    """Gender group per author from the first name, by a caller-supplied name table (lower-case names).

    Names that are empty, blank or hold a dot stay unknown; authors without a name are left out.
    """
    name = F.col("name")
    blank = F.trim(name) == ""
    first = F.when(~blank & ~name.contains("."), F.lower(F.get(F.split(F.trim(name), r"\s+"), F.lit(0))))
    group = (F.when(F.col("gender").isin("male", "mostly_male"), "Male")
             .when(F.col("gender").isin("female", "mostly_female"), "Female").otherwise(UNKNOWN))
    table = genders.select(F.col("first_name").alias("_first"), "gender")
    return authors.where(name.isNotNull()).withColumn("_first", first).join(table, "_first", "left").select(
        "author_id", "name", group.alias("author_gender_group"))
