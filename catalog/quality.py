"""Data-quality gates, statistics and profiles."""

from pyspark.sql import functions as F

from catalog.registry import on_tables, query
from foliospark.operators import quality
from foliospark.sources import adapters, tables


@on_tables("d1_non_empty", "SELECT 'books' AS dataset, count(*) AS row_count, count(*) > 0 AS passed FROM fx_books")
def non_empty(d):
    return quality.non_empty(d.raw.books, "books")


def _rules(dataset, table, rules):
    parts = [f"SELECT '{dataset}' AS dataset, 'table is not empty' AS rule, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations, count(*) > 0 AS passed FROM {table}"]
    parts += [f"SELECT '{dataset}', '{name}', count(*) FILTER (WHERE {bad}), count(*) FILTER (WHERE {bad}) = 0 FROM {table}" for name, bad in rules]
    return "\nUNION ALL ".join(parts)


_SOURCE_BOOKS = _rules("source books", "fx_books", [("null book_id", "book_id IS NULL"), ("null title", "title IS NULL")])
_CLEAN_BOOKS = _rules("cleaned books", "cl_books", [
    ("null title", "title_clean IS NULL"), ("publication_year range", "publication_year IS NULL OR publication_year < 1900 OR publication_year > 2025"),
    ("num_pages range", "num_pages IS NULL OR num_pages < 10 OR num_pages > 2000")])
_RAW_BOOKS = _rules("raw books", "fx_books", [
    ("null title", "title IS NULL"), ("publication_year range", "publication_year IS NULL OR publication_year < 1900 OR publication_year > 2025"),
    ("num_pages range", "num_pages IS NULL OR num_pages < 10 OR num_pages > 2000")])
_SOURCE_INTER = _rules("source interactions", "fx_interactions", [
    ("null user_id", "user_id IS NULL"), ("null book_id", "book_id IS NULL"), ("null interaction_type", "interaction_type IS NULL")])
_CLEAN_INTER = _rules("cleaned interactions", "cl_interactions", [
    ("null user_id", "user_id_clean IS NULL"), ("null book_id", "book_id IS NULL"), ("rating range", "rating < 0 OR rating > 5"),
    ("null or view interaction_type", "interaction_type_clean IS NULL OR interaction_type_clean = 'view'")])


@on_tables("d2_rule_suite", f"{_SOURCE_BOOKS} UNION ALL {_RAW_BOOKS} UNION ALL {_SOURCE_INTER}")
def rule_suite(d):
    raw = d.raw.books.withColumnRenamed("title", "title_clean")
    return (quality.rule_report(d.raw.books, "source books", quality.source_book_rules())
            .unionByName(quality.rule_report(raw, "raw books", quality.cleaned_book_rules()))
            .unionByName(quality.rule_report(d.raw.interactions, "source interactions", quality.source_interaction_rules())))


@on_tables("d3_source_book_rules", _SOURCE_BOOKS)
def source_books(d):
    return quality.rule_report(d.raw.books, "source books", quality.source_book_rules())


@on_tables("d4_cleaned_book_rules", _CLEAN_BOOKS)
def cleaned_books(d):
    return quality.rule_report(d.books, "cleaned books", quality.cleaned_book_rules())


@on_tables("d5_source_interaction_rules", _SOURCE_INTER)
def source_interactions(d):
    return quality.rule_report(d.raw.interactions, "source interactions", quality.source_interaction_rules())


@on_tables("d6_cleaned_interaction_rules", _CLEAN_INTER)
def cleaned_interactions(d):
    return quality.rule_report(d.interactions, "cleaned interactions", quality.cleaned_interaction_rules())


@on_tables("d7_quality_gate", _CLEAN_BOOKS)
def gate(d):
    return quality.gate(quality.rule_report(d.books, "cleaned books", quality.cleaned_book_rules()))


@on_tables("d8_table_structure", """
SELECT CAST(column_index + 1 AS BIGINT) AS ordinal, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' ELSE 'boolean' END AS data_type
FROM (SELECT row_number() OVER () - 1 AS column_index, column_name, column_type AS data_type FROM (DESCRIBE SELECT * FROM fx_interactions))""")
def structure(d):
    return tables.structure(d.raw.interactions)


_STATS = """SELECT count(*) AS total_rows, count(DISTINCT user_id_clean) AS unique_users, count(DISTINCT book_id) AS unique_books,
  round(avg(num_books_read), 2) AS avg_books_per_user, round(avg(avg_book_reading_time_days), 2) AS avg_reading_time_days,
  round(avg(num_pages), 0) AS avg_pages, round(avg(rating), 2) AS avg_rating FROM feats"""


@on_tables("d9_feature_stats", _STATS)
def feature_stats(d):
    return quality.feature_stats(d.features)


@on_tables("d10_stat_alarms", f"SELECT total_rows = 0 AS no_rows, avg_rating < 1.0 OR avg_rating > 5.0 AS rating_out_of_range, unique_users < 1 AS no_users FROM ({_STATS})")
def stat_alarms(d):
    return quality.stat_alarms(quality.feature_stats(d.features))


def _profile(table, columns):
    rows = []
    for i, (name, kind) in enumerate(columns, 1):
        numeric = kind in ("bigint", "double")
        stats = [f"{f}(CAST({name} AS DOUBLE))" if numeric else "CAST(NULL AS DOUBLE)" for f in ("avg", "stddev_samp", "min", "max")]
        rows.append(f"""SELECT CAST({i} AS BIGINT) AS ordinal, '{name}' AS column_name, '{kind}' AS data_type, r4(100.0 * count(*) FILTER (WHERE {name} IS NULL) / count(*)) AS missing_pct,
  r4({stats[0]}) AS mean_value, r4({stats[1]}) AS std_value, r4({stats[2]}) AS min_value, r4({stats[3]}) AS max_value, count(DISTINCT {name}) AS distinct_count FROM {table}""")
    return "\nUNION ALL ".join(rows)


_PROFILED = [("book_id", "bigint"), ("title", "string"), ("publication_year", "bigint"), ("num_pages", "bigint"), ("average_rating", "double"),
             ("ratings_count", "bigint"), ("is_ebook", "boolean")]


@on_tables("d11_column_profile", _profile("fx_books", _PROFILED))
def profile(d):
    return quality.column_profile(d.raw.books.select(*[c for c, _ in _PROFILED]))


@on_tables("d11_column_profile_sketch")
def profile_sketch(d):
    return quality.column_profile(d.raw.books, exact=False)


@on_tables("d11_sketch_against_exact", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, TRUE AS sketch_is_close FROM fx_books" for c, _ in _PROFILED))
def sketch_against_exact(d):
    """Distinct counts of the sketched profile within three standard errors of the exact ones."""
    books = d.raw.books.select(*[c for c, _ in _PROFILED])
    exact = quality.column_profile(books).select("column_name", F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"))
    rough = quality.column_profile(books, exact=False).select("column_name", F.col("distinct_count").alias("_rough"))
    return exact.join(rough, "column_name").select("column_name", "distinct_count", (F.abs(F.col("_rough") - F.col("distinct_count")) <= 0.15 * F.col("distinct_count")).alias("sketch_is_close"))


def _hist(name, expr, bins):
    return f"""SELECT '{name}' AS measure, bin, r4(lo + (hi - lo) / {bins} * (bin - 1)) AS bin_start, count(*) AS row_count FROM (
  SELECT least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS BIGINT) + 1, {bins}) AS bin, lo, hi FROM (SELECT CAST({expr} AS DOUBLE) AS v FROM fx_books)
  CROSS JOIN (SELECT min(CAST({expr} AS DOUBLE)) AS lo, max(CAST({expr} AS DOUBLE)) AS hi FROM fx_books)) GROUP BY bin, lo, hi"""


@on_tables("d12_histograms", "\nUNION ALL ".join([_hist("average_rating", "average_rating", 20), _hist("ratings_count", "ratings_count", 10),
                                                 _hist("title_words", "len(string_split(title, ' '))", 30)]))
def histograms(d):
    b = d.raw.books
    return (quality.histogram(b, F.col("average_rating"), 20, "average_rating")
            .unionByName(quality.histogram(b, F.col("ratings_count"), 10, "ratings_count"))
            .unionByName(quality.histogram(b, F.size(F.split("title", " ")), 30, "title_words")))


@on_tables("d13_training_stats", """
SELECT count(DISTINCT user_id_clean) AS num_users, count(DISTINCT book_id) AS num_books, count(*) AS num_interactions, r4(avg(rating)) AS avg_rating, r4(stddev_samp(rating)) AS std_rating,
  r4(min(rating)) AS min_rating, r4(max(rating)) AS max_rating, r4(quantile_disc(rating, 0.25)) AS q25, r4(quantile_disc(rating, 0.5)) AS q50, r4(quantile_disc(rating, 0.75)) AS q75
FROM split_feats WHERE split = 'train' AND rating IS NOT NULL""")
def training_stats(d):
    return quality.training_stats(d.split.where(F.col("split") == "train"))


@on_tables("d14_cold_start", """
SELECT count(*) FILTER (WHERE cnt < 5) AS users_with_few_ratings, count(*) AS total_users, r4(count(*) FILTER (WHERE cnt < 5) / count(*)) AS cold_start_ratio
FROM (SELECT user_id_clean, count(*) AS cnt FROM split_feats WHERE split = 'train' GROUP BY 1)""")
def cold_start(d):
    return quality.cold_start(d.split.where(F.col("split") == "train"))


@query("d15_event_validity", """
SELECT event_type, event_type IN ('click', 'view', 'like', 'add_to_list') AS is_valid, count(*) AS event_count FROM fx_events GROUP BY 1, 2""")
def event_validity(spark, sf_dir):
    return quality.event_validity(adapters.events(spark, sf_dir))


@on_tables("d16_scoring_ready", "SELECT count(rating) AS rated_rows, count(rating) > 0 AS ready FROM split_feats WHERE split = 'test'")
def scoring_ready(d):
    return quality.scoring_ready(d.split.where(F.col("split") == "test"))
