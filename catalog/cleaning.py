"""Cleaning, projections and filters."""

from pyspark.sql import functions as F

from catalog.registry import on_tables, query
from foliospark.functions.text import clean_text, display_rating
from foliospark.operators import cleaning, features, recommend, search
from foliospark.session import work_folder
from foliospark.sources import adapters, files
from foliospark.settings import NOT_MODEL_INPUT

_BOOK_COLUMNS = """book_id, title_clean, description_clean, CAST(to_json(authors_flat) AS VARCHAR) AS authors_flat,
  CAST(to_json(series_flat) AS VARCHAR) AS series_flat, CAST(to_json(popular_shelves_flat) AS VARCHAR) AS popular_shelves_flat,
  publication_year, num_pages, r4(average_rating) AS average_rating, ratings_count, text_reviews_count, is_ebook"""


@on_tables("c1_clean_books", f"SELECT {_BOOK_COLUMNS} FROM cl_books")
def clean_books(d):
    return d.books


@on_tables("c2_clean_text", """
SELECT coalesce(nullif(trim(title), ''), 'Unknown') AS title_clean, count(*) AS row_count FROM fx_books GROUP BY 1""")
def text_rule(d):
    return d.raw.books.groupBy(clean_text(F.col("title")).alias("title_clean")).agg(F.count(F.lit(1)).alias("row_count"))


@on_tables("c3_clean_flags", "SELECT book_id, coalesce(is_ebook, FALSE) AS is_ebook FROM fx_books")
def flag_rule(d):
    return cleaning.clean_columns(d.raw.books.select("book_id", "is_ebook"))


@on_tables("c4_clean_arrays", """
SELECT book_id, list_transform(list_filter(series, lambda x: x IS NOT NULL), lambda x: CAST(to_json(x) AS VARCHAR)).array_to_string('|') AS series_flat,
  list_transform(popular_shelves, lambda x: CAST(to_json(x) AS VARCHAR)).array_to_string('|') AS shelves_flat FROM fx_books""")
def array_rule(d):
    out = cleaning.clean_columns(d.raw.books.select("book_id", "series", "popular_shelves"))
    return out.select("book_id", F.array_join("series_flat", "|").alias("series_flat"), F.array_join("popular_shelves_flat", "|").alias("shelves_flat"))


@on_tables("c5_pass_through", "SELECT book_id, coalesce(publication_year, -1) AS publication_year, num_pages, r4(average_rating) AS average_rating, ratings_count FROM fx_books")
def pass_through(d):
    out = cleaning.clean_columns(d.raw.books.select("book_id", "publication_year", "num_pages", "average_rating", "ratings_count"))
    return out.withColumn("publication_year", F.coalesce("publication_year", F.lit(-1)))


@on_tables("c6_exact_dedup", """
SELECT DISTINCT concat('u', o_custkey) AS user_id_clean, l_partkey AS book_id, CAST(l_linenumber % 6 AS BIGINT) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def exact_dedup(d):
    return cleaning.clean_table(d.raw.interactions.select("user_id", "book_id", "rating"))


@on_tables("c7_plausible_books", "SELECT book_id, num_pages, publication_year FROM fx_books WHERE num_pages BETWEEN 10 AND 2000 AND publication_year BETWEEN 1900 AND 2025")
def plausible(d):
    return d.raw.books.where(cleaning.plausible_book()).select("book_id", "num_pages", "publication_year")


@on_tables("c8_without_views", "SELECT interaction_type, count(*) AS row_count FROM fx_interactions WHERE interaction_type <> 'view' GROUP BY 1")
def no_views(d):
    return cleaning.without_views(d.raw.interactions).groupBy("interaction_type").agg(F.count(F.lit(1)).alias("row_count"))


@on_tables("c9_latest_interaction", "SELECT * FROM in_latest")
def latest(d):
    return cleaning.latest_interactions(cleaning.without_views(d.raw.interactions))


@on_tables("c9_latest_interaction_text_order", """
SELECT user_id, book_id, max(date_updated) AS date_updated FROM fx_interactions WHERE interaction_type <> 'view' GROUP BY 1, 2""")
def latest_by_text(d):
    return cleaning.latest_interactions(cleaning.without_views(d.raw.interactions), text_order=True).select("user_id", "book_id", "date_updated")


@on_tables("c10_known_books", "SELECT * FROM cl_interactions")
def known_books(d):
    return d.interactions


@on_tables("c10_known_books_semi", "SELECT user_id_clean, book_id, rating FROM cl_latest WHERE book_id IN (SELECT book_id FROM cl_books)")
def known_books_semi(d):
    return cleaning.of_known_books(cleaning.clean_interactions(d.raw.interactions), d.books, semi=True).select("user_id_clean", "book_id", "rating")


@on_tables("c11_null_defaults", """
SELECT book_id, coalesce(publication_year, 1997) AS publication_year, coalesce(num_pages, 300) AS num_pages,
  r4(coalesce(avg_book_reading_time, 14)) AS avg_book_reading_time_days, coalesce(num_readers_with_time, 0) AS num_readers_with_reading_time
FROM fx_books LEFT JOIN book_times USING (book_id)""")
def null_defaults(d):
    times = features.book_reading_times(features.with_times(d.interactions))
    books = cleaning.clean_columns(d.raw.books)
    return features.base_books(books, times, d.raw.as_of).select(
        "book_id", "publication_year", "num_pages", "avg_book_reading_time_days", "num_readers_with_reading_time")


@on_tables("c12_eligible_rows", "SELECT book_era, book_length_category, count(*) AS row_count FROM feats GROUP BY 1, 2")
def eligible_rows(d):
    return d.features.groupBy("book_era", "book_length_category").agg(F.count(F.lit(1)).alias("row_count"))


@on_tables("c13_drop_columns", """
SELECT user_id_clean, book_id, r4(actual_rating) AS actual_rating, book_era FROM
  (SELECT * EXCLUDE (predicted_rating, absolute_error, error) FROM preds)""")
def drop_columns(d):
    return d.predictions.drop("predicted_rating", "absolute_error", "error").select("user_id_clean", "book_id", "actual_rating", "book_era")


@on_tables("c14_model_inputs", f"""
SELECT column_name, count(*) AS filled FROM (UNPIVOT (SELECT COLUMNS(lambda c: c NOT IN ({", ".join(repr(c) for c in NOT_MODEL_INPUT)}))::VARCHAR FROM feats)
  ON COLUMNS(*) INTO NAME column_name VALUE v) GROUP BY 1""")
def model_input_columns(d):
    names = features.model_inputs(d.features.columns)
    filled = d.features.agg(*[F.count(c).alias(c) for c in names])
    return filled.unpivot([], names, "column_name", "filled")


@on_tables("c15_known_users", """
SELECT user_id, user_id IN (SELECT user_id_clean FROM feats) AS user_exists FROM users""")
def known_users(d):
    return recommend.known_users(d.raw.interactions.select("user_id").distinct(), d.features)


def _catalogue(d):
    author = recommend.book_author(recommend.author_links(d.raw.books), d.raw.authors)
    return d.raw.books.select("book_id", "title").join(author, "book_id", "left").select(
        "book_id", "title", F.coalesce("author", F.lit("Unknown")).alias("author"))


def _indexed_search(d, needle):
    spark = d.raw.books.sparkSession
    path = f"{work_folder(spark)}/search"
    search.build(_catalogue(d), path)
    return search.search(spark, path, needle)


@on_tables("c16_search_short_needle", """
SELECT b.book_id, b.title, coalesce(a.author, 'Unknown') AS author FROM fx_books b LEFT JOIN one_author a USING (book_id)
WHERE contains(lower(b.title), 'z') OR contains(lower(coalesce(a.author, 'Unknown')), 'z') ORDER BY b.book_id LIMIT 20""")
def search_short(d):
    return _indexed_search(d, "Z")


@on_tables("c16_search_phrase", """
SELECT b.book_id, b.title, coalesce(a.author, 'Unknown') AS author FROM fx_books b LEFT JOIN one_author a USING (book_id)
WHERE contains(lower(b.title), 'ed wid') OR contains(lower(coalesce(a.author, 'Unknown')), 'ed wid') ORDER BY b.book_id LIMIT 20""")
def search_phrase(d):
    return _indexed_search(d, "ed Wid")


@on_tables("c16_search_books", """
SELECT b.book_id, b.title, coalesce(a.author, 'Unknown') AS author FROM fx_books b LEFT JOIN one_author a USING (book_id)
WHERE contains(lower(b.title), 'wid') OR contains(lower(coalesce(a.author, 'Unknown')), 'wid') ORDER BY b.book_id LIMIT 20""")
def search_books(d):
    return _indexed_search(d, "WID")


@on_tables("c16_search_all_books", """
SELECT b.book_id, b.title, coalesce(a.author, 'Unknown') AS author FROM fx_books b LEFT JOIN one_author a USING (book_id) ORDER BY b.book_id LIMIT 10""")
def search_everything(d):
    return _indexed_search(d, "")


@on_tables("c17_display_rating", """
SELECT book_id, CASE WHEN book_id % 5 = 0 THEN 'N/A' ELSE printf('%.1f', CAST(book_id % 50 AS DOUBLE)) END AS shown FROM fx_books""")
def display(d):
    text = F.when(F.col("book_id") % 10 == 0, F.lit(None)).when(F.col("book_id") % 5 == 0, "n.a.").otherwise((F.col("book_id") % 50).cast("string"))
    return d.raw.books.select("book_id", display_rating(text).alias("shown"))


@query("i22_catalogue_fallbacks", """
SELECT CAST(book_id AS VARCHAR) AS book_id, CASE WHEN book_id % 3 = 0 THEN coalesce(nullif(title, ''), 'Unknown Title') WHEN book_id % 3 = 1 THEN 'clean ' || title ELSE 'Unknown Title' END AS title,
  CASE WHEN book_id % 2 = 0 THEN description ELSE 'Unknown Author' END AS author,
  r4(CASE WHEN book_id % 7 = 0 THEN 3.5 ELSE average_rating END) AS rating, CASE WHEN book_id % 4 = 0 THEN 'i' || book_id ELSE '' END AS isbn
FROM fx_books""")
def catalogue_fallbacks(spark, sf_dir):
    """Writes the books as line JSON with holes, and reads them back as a catalogue."""
    from foliospark.session import work_folder

    b = F.col("book_id")
    raw = adapters.books(spark, sf_dir).select(
        b.cast("string").alias("book_id"), F.when(b % 2 == 0, "").alias("book_title"),
        F.when(b % 3 == 1, F.concat(F.lit("clean "), "title")).when(b % 3 == 0, "").alias("title_clean"),
        F.when(b % 3 == 0, F.col("title")).alias("title"), F.when(b % 2 == 0, F.col("description")).otherwise("").alias("author_name"),
        F.when(b % 7 == 0, F.lit(0.0)).otherwise(F.col("average_rating")).cast("string").alias("average_rating"),
        F.when(b % 4 == 0, F.concat(F.lit("i"), "book_id")).otherwise("").alias("isbn"))
    path = f"{work_folder(spark)}/catalogue"
    raw.write.json(path)
    return files.read_catalogue(spark, path)
