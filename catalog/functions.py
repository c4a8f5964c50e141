"""Scalar functions, each over a whole table."""

from pyspark.sql import functions as F

from catalog.registry import on_tables, query
from foliospark.functions import labels
from foliospark.functions.dates import activity_time, any_time, instant_text, long_date, reading_days
from foliospark.functions.numbers import log_step, share, split_bucket, whole
from foliospark.functions.text import element_count, first_author_id, word_count
from foliospark.sources import adapters


@on_tables("s1_null_handling", """
SELECT book_id, trim(title) AS trimmed, nullif(trim(title), '') AS blank_to_null, coalesce(nullif(trim(title), ''), 'none') AS filled, CASE WHEN num_pages > 500 THEN 'thick' ELSE 'thin' END AS size_word FROM fx_books""")
def null_handling(d):
    t = F.trim("title")
    return d.raw.books.select("book_id", t.alias("trimmed"), F.nullif(t, F.lit("")).alias("blank_to_null"), F.ifnull(F.nullif(t, F.lit("")), F.lit("none")).alias("filled"),
                              F.when(F.col("num_pages") > 500, "thick").otherwise("thin").alias("size_word"))


@query("s2_text_length", "SELECT doc_id, length(text) AS n_characters FROM documents")
def text_length(spark, sf_dir):
    return adapters.table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n_characters"))


@query("s3_word_count", "SELECT doc_id, len(string_split(text, ' ')) AS n_words FROM documents")
def words(spark, sf_dir):
    return adapters.table(spark, sf_dir, "documents").select("doc_id", word_count(F.col("text")).alias("n_words"))


@on_tables("s4_array_length", "SELECT book_id, len(series) AS n_series, len(popular_shelves) AS n_shelves, len(series) > 0 AS is_series FROM fx_books")
def array_length(d):
    return d.raw.books.select("book_id", element_count(F.col("series")).alias("n_series"), element_count(F.col("popular_shelves")).alias("n_shelves"), (element_count(F.col("series")) > 0).alias("is_series"))


@on_tables("s5_parse_activity_time", """
SELECT review_id, strftime(try_strptime(replace(started_at, ' +0000', ''), '%a %b %d %H:%M:%S %Y'), '%Y-%m-%d %H:%M:%S.%f') AS started,
  strftime(try_strptime(replace(read_at, ' +0000', ''), '%a %b %d %H:%M:%S %Y'), '%Y-%m-%d %H:%M:%S.%f') AS finished FROM fx_interactions""")
def parse_time(d):
    return d.raw.interactions.select("review_id", activity_time(F.col("started_at")).alias("started"), activity_time(F.col("read_at")).alias("finished"))


@on_tables("s6_reading_days", """
SELECT review_id, CAST(CASE WHEN n BETWEEN 1 AND 365 THEN n ELSE 14 END AS BIGINT) AS days FROM (SELECT review_id, date_diff('day',
  CAST(try_strptime(replace(started_at, ' +0000', ''), '%a %b %d %H:%M:%S %Y') AS DATE), CAST(try_strptime(replace(read_at, ' +0000', ''), '%a %b %d %H:%M:%S %Y') AS DATE)) AS n FROM fx_interactions)""")
def span(d):
    days = reading_days(activity_time(F.col("started_at")), activity_time(F.col("read_at")))
    return d.raw.interactions.select("review_id", F.coalesce(days, F.lit(14)).alias("days"))


@on_tables("s7_recency", """
SELECT review_id, coalesce(date_diff('day', CAST(try_strptime(replace(read_at, ' +0000', ''), '%a %b %d %H:%M:%S %Y') AS DATE), DATE '2002-01-01'), 365) AS recency FROM fx_interactions""")
def recency(d):
    from foliospark.functions.dates import days_since

    return d.raw.interactions.select("review_id", days_since(d.raw.as_of, activity_time(F.col("read_at")), 365).alias("recency"))


@on_tables("s8_book_age", "SELECT book_id, 2002 - coalesce(publication_year, 2002 - 5) AS age FROM fx_books")
def age(d):
    year = F.year(F.lit(d.raw.as_of))
    return d.raw.books.select("book_id", (year - F.coalesce("publication_year", year - 5)).alias("age"))


@on_tables("s9_long_dates", """
SELECT review_id, strftime(coalesce(try_strptime(replace(nullif(read_at, ''), ' +0000', ''), '%a %b %d %H:%M:%S %Y'), TIMESTAMP '2024-01-29'), '%A, %B %d %Y') AS date_read FROM fx_interactions""")
def long_dates(d):
    when = F.coalesce(activity_time(F.nullif("read_at", F.lit(""))), F.lit(adapters.EVENTS_AS_OF) - F.expr("interval 2 days"))
    return d.raw.interactions.select("review_id", long_date(when).alias("date_read"))


@query("s10_casts", "SELECT event_id, TRY_CAST(book_id AS BIGINT) AS book_no, coalesce(TRY_CAST(event_type AS BIGINT), -1) AS not_a_number, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') || '+00' AS seen FROM fx_events")
def casts(spark, sf_dir):
    return adapters.events(spark, sf_dir).select("event_id", F.col("book_id").try_cast("bigint").alias("book_no"),
                                                 F.coalesce(F.col("event_type").try_cast("bigint"), F.lit(-1)).alias("not_a_number"), instant_text(F.col("event_timestamp")).alias("seen"))


@on_tables("s11_logarithms", "SELECT book_id, r4(ln(1 + ratings_count)) AS log_count, r4(ln(num_pages + 50)) AS log_pages FROM fx_books")
def logarithms(d):
    return d.raw.books.select("book_id", F.log1p("ratings_count").alias("log_count"), F.ln(F.col("num_pages") + 50).alias("log_pages"))


@query("s12_half_away_rounding", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(round(l_quantity / 2) AS BIGINT) AS up, CAST(round(-l_quantity / 2) AS BIGINT) AS down, CAST(round(ln(l_quantity + 1)) AS BIGINT) AS log_up FROM lineitem")
def rounding(spark, sf_dir):
    q = F.col("l_quantity")
    return adapters.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", whole(q / 2).alias("up"), whole(-q / 2).alias("down"), log_step(q).alias("log_up"))


@on_tables("s13_powers", "SELECT book_id, r4(pow(average_rating, 2)) AS squared, r4(sqrt(ratings_count)) AS root, r4(abs(average_rating - 3)) AS distance FROM fx_books")
def powers(d):
    r = F.col("average_rating")
    return d.raw.books.select("book_id", F.pow(r, F.lit(2)).alias("squared"), F.sqrt("ratings_count").alias("root"), F.abs(r - 3).alias("distance"))


@on_tables("s14_safe_division", "SELECT book_id, r4(CAST(num_pages AS DOUBLE) / nullif(ratings_count, 0)) AS pages_per_vote FROM fx_books")
def division(d):
    return d.raw.books.select("book_id", share(F.col("num_pages"), F.col("ratings_count")).alias("pages_per_vote"))


@on_tables("s15_hash_buckets", "SELECT user_id, CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % 100 AS bucket FROM users")
def buckets(d):
    return d.raw.interactions.select("user_id").distinct().select("user_id", split_bucket(F.col("user_id")).alias("bucket"))


@on_tables("s16_json", "SELECT book_id, authors_flat[1] AS first_author_json, authors_flat[1]->>'$.author_id' AS author_text, TRY_CAST(authors_flat[1]->>'$.author_id' AS BIGINT) AS author_id FROM cl_books")
def json_access(d):
    first = F.get("authors_flat", F.lit(0))
    return d.books.select("book_id", first.alias("first_author_json"), F.get_json_object(first, "$.author_id").alias("author_text"), first_author_id(F.col("authors_flat")).alias("author_id"))


@on_tables("s17_array_access", "SELECT book_id, authors[1].author_id AS first_author, authors[2].author_id AS second_author FROM fx_books")
def array_access(d):
    return d.raw.books.select("book_id", F.col("authors")[0]["author_id"].alias("first_author"), F.get("authors", F.lit(1))["author_id"].alias("second_author"))


@on_tables("s18_unnest", "SELECT book_id, author_key FROM links")
def unnest(d):
    return d.raw.books.select("book_id", F.explode("authors").alias("a")).select("book_id", F.col("a.author_id").alias("author_key"))


@query("s19_time_ranges", """
SELECT event_type, count(*) FILTER (WHERE event_timestamp >= TIMESTAMP '2024-01-30') AS last_day, count(*) FILTER (WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-24') AS baseline FROM fx_events GROUP BY 1""")
def time_ranges(spark, sf_dir):
    now, ts = F.lit(adapters.EVENTS_AS_OF), F.col("event_timestamp")
    return adapters.events(spark, sf_dir).groupBy("event_type").agg(
        F.count_if(ts >= now - F.expr("interval 24 hours")).alias("last_day"),
        F.count_if(ts.between(now - F.expr("interval 30 days"), now - F.expr("interval 7 days"))).alias("baseline"))


@on_tables("s20_case_ladders", """
SELECT book_id, CASE WHEN num_pages <= 200 THEN 'short' WHEN num_pages <= 350 THEN 'medium' WHEN num_pages <= 500 THEN 'long' ELSE 'very_long' END AS length_word,
  CASE WHEN average_rating >= 4 THEN 'high' WHEN average_rating >= 3 THEN 'mid' ELSE 'low' END AS rating_word FROM fx_books""")
def ladders(d):
    return d.raw.books.select("book_id", labels.book_length(F.col("num_pages")).alias("length_word"), labels.from_top(F.col("average_rating"), [(4, "high"), (3, "mid")], "low").alias("rating_word"))


@query("q2_either_date_format", "SELECT event_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM fx_events")
def either_format(spark, sf_dir):
    """The migrated form of a date text is understood like the activity form."""
    ts = F.col("event_timestamp")
    return adapters.events(spark, sf_dir).select("event_id", any_time(instant_text(ts)).alias("parsed"))
