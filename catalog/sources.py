"""Sources, sinks and table maintenance."""

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import on_tables, query
from foliospark.operators import bias, etl, monitoring, scoring
from foliospark.plans import audit
from foliospark.session import work_folder
from foliospark.sources import adapters, buckets, files, histories, tables

_NOW = adapters.EVENTS_AS_OF


def _stamp():
    return F.lit(_NOW)


@query("i1_table_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, r4(o_totalprice) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.000000') AS o_orderdate, o_orderpriority FROM orders")
def table_scan(spark, sf_dir):
    return adapters.table(spark, sf_dir, "orders")


@on_tables("i2_row_counts", "SELECT 'books' AS table_type, count(*) AS record_count FROM part UNION ALL SELECT 'interactions', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def row_counts(d):
    return tables.row_counts({"books": d.raw.books, "interactions": d.raw.interactions})


@on_tables("i3_overwrite", "SELECT author_id, name FROM fx_authors")
def overwrite(d):
    path = f"{work_folder(d.raw.authors.sparkSession)}/authors"
    tables.replace(d.raw.authors.limit(1), path)
    return tables.replace(d.raw.authors, path)


@on_tables("i4_overwrite_from_self", "SELECT i.user_id, i.book_id, i.rating FROM fx_interactions i JOIN cl_books b ON i.book_id = b.book_id")
def overwrite_from_self(d):
    spark = d.raw.books.sparkSession
    path = f"{work_folder(spark)}/interactions"
    stored = tables.replace(d.raw.interactions.select("user_id", "book_id", "rating"), path)
    return tables.replace_from_self(stored.join(d.books.select("book_id"), "book_id").select("user_id", "book_id", "rating"), path)


@query("i5_append", """
SELECT interaction_type, count(*) AS row_count FROM (
  SELECT interaction_type FROM fx_interactions UNION ALL
  SELECT event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, book_id ORDER BY CASE event_type WHEN 'like' THEN 3 WHEN 'add_to_list' THEN 2 WHEN 'click' THEN 1 ELSE 0 END DESC, event_timestamp DESC) AS rn
    FROM fx_events WHERE event_type <> 'view') WHERE rn = 1) GROUP BY 1""")
def append(spark, sf_dir):
    path = f"{work_folder(spark)}/interactions"
    tables.replace(adapters.interactions(spark, sf_dir), path)
    both = tables.append(etl.migrate_events(adapters.events(spark, sf_dir)), path)
    return both.groupBy("interaction_type").agg(F.count(F.lit(1)).alias("row_count"))


@query("i7_day_partitioned_events", "SELECT strftime(event_timestamp, '%Y-%m-%d') AS date, count(*) AS events FROM fx_events WHERE event_timestamp >= TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1")
def partitioned_events(spark, sf_dir):
    root = work_folder(spark)
    histories.set_up(spark, root)
    events = adapters.events(spark, sf_dir).withColumn("book_id", F.col("book_id").try_cast("bigint"))
    histories.append_dated(events, f"{root}/user_events", "event_timestamp")
    since = dt.datetime(2024, 1, 20, 12, tzinfo=dt.timezone.utc)
    recent = histories.read_since(spark, f"{root}/user_events", "event_timestamp", since)
    return recent.groupBy("date").agg(F.count(F.lit(1)).alias("events"))


@query("i8_history_tables", "SELECT 'model_metrics_history' AS table_name, count(*) AS row_count FROM fx_history UNION ALL SELECT 'data_drift_history', count(*) FROM fx_history WHERE metric_name = 'mae'")
def history_tables(spark, sf_dir):
    root = work_folder(spark)
    histories.set_up(spark, root)
    histories.set_up(spark, root)
    metrics = histories.append_dated(adapters.metric_history(spark, sf_dir), f"{root}/model_metrics_history", "timestamp")
    drift = histories.append_dated(adapters.drift_log(spark, sf_dir), f"{root}/data_drift_history", "timestamp")
    return tables.row_counts({"model_metrics_history": metrics, "data_drift_history": drift}).select(
        F.col("table_type").alias("table_name"), F.col("record_count").alias("row_count"))


_MARKS = """(SELECT user_id, TRY_CAST(book_id AS BIGINT) AS book_id, CAST(CASE WHEN CAST(event_id AS BIGINT) % 4 = 0 THEN NULL ELSE CAST(event_id AS BIGINT) % 6 END AS BIGINT) AS rating, event_timestamp AS read_time,
    row_number() OVER (PARTITION BY user_id, book_id ORDER BY event_timestamp DESC, CASE WHEN CAST(event_id AS BIGINT) % 4 = 0 THEN NULL ELSE CAST(event_id AS BIGINT) % 6 END DESC NULLS LAST) AS rn
  FROM fx_events WHERE event_type = 'like')"""


def _marks(spark, sf_dir):
    n = F.col("event_id").cast("bigint")
    return adapters.events(spark, sf_dir).where(F.col("event_type") == "like").select(
        "user_id", F.col("book_id").try_cast("bigint").alias("book_id"), F.when(n % 4 != 0, n % 6).alias("rating"), F.col("event_timestamp").alias("read_time"))


_UPSERTED = f"""
SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.book_id, s.book_id) AS book_id, t.review_id,
  CASE WHEN s.user_id IS NOT NULL THEN now ELSE t.date_added END AS date_added, CASE WHEN s.user_id IS NOT NULL THEN now ELSE t.date_updated END AS date_updated,
  CASE WHEN s.user_id IS NOT NULL THEN now ELSE t.read_at END AS read_at, CASE WHEN t.user_id IS NULL THEN '' ELSE t.started_at END AS started_at,
  CASE WHEN s.user_id IS NOT NULL THEN TRUE ELSE t.is_read END AS is_read, CASE WHEN s.user_id IS NOT NULL THEN s.r ELSE t.rating END AS rating,
  CASE WHEN t.user_id IS NULL THEN '' ELSE t.review_text_incomplete END AS review_text_incomplete,
  CASE WHEN s.user_id IS NOT NULL THEN 'read' ELSE t.interaction_type END AS interaction_type
FROM fx_interactions t FULL OUTER JOIN (
  SELECT user_id, book_id, coalesce(rating, 0) AS r, strftime(read_time, '%a %b %d %H:%M:%S +0000 %Y') AS now FROM {_MARKS} WHERE rn = 1) s
ON t.user_id = s.user_id AND t.book_id = s.book_id"""


@query("i9_upsert_stored", _UPSERTED)
def upsert_stored(spark, sf_dir):
    """The same upsert into a stored table in folders by user: only the folders of users with marks are rewritten."""
    path = f"{work_folder(spark)}/interactions"
    buckets.lay_out(adapters.interactions(spark, sf_dir), path, "user_id", 16)
    buckets.change(path, _marks(spark, sf_dir), etl.upsert_reads, "user_id", 16)
    return buckets.read(spark, path)


@query("i9_upsert_reads", _UPSERTED)
def upsert_reads(spark, sf_dir):
    return etl.upsert_reads(adapters.interactions(spark, sf_dir), _marks(spark, sf_dir))


@query("i10_reject_unknown_books", f"SELECT count(*) AS marks, count(DISTINCT book_id) AS books FROM {_MARKS} WHERE book_id IN (SELECT book_id FROM cl_books)")
def reject_unknown(spark, sf_dir):
    from catalog.base import derived

    kept = etl.known_books_only(_marks(spark, sf_dir), derived(spark, sf_dir).books)
    return kept.agg(F.count(F.lit(1)).alias("marks"), F.count_distinct("book_id").alias("books"))


@on_tables("i11_add_missing_column", "SELECT user_id, book_id, CAST(NULL AS VARCHAR) AS interaction_type FROM fx_interactions")
def add_column(d):
    old = d.raw.interactions.select("user_id", "book_id")
    return tables.add_missing_column(tables.add_missing_column(old, "interaction_type"), "interaction_type")


@on_tables("i12_backfill_table", """
SELECT coalesce(interaction_type, CASE WHEN is_read THEN 'read' WHEN rating > 0 THEN 'like' ELSE 'add_to_list' END) AS interaction_type, count(*) AS row_count
FROM fx_interactions GROUP BY 1""")
def backfill_table(d):
    path = f"{work_folder(d.raw.books.sparkSession)}/interactions"
    stored = tables.replace(d.raw.interactions.select("user_id", "book_id", "is_read", "rating", "interaction_type"), path)
    filled = tables.replace_from_self(etl.backfill_type(stored), path)
    return filled.groupBy("interaction_type").agg(F.count(F.lit(1)).alias("row_count"))


@on_tables("i14_promote_staging", "SELECT 'books' AS table_name, count(*) AS row_count FROM cl_books UNION ALL SELECT 'interactions', count(*) FROM cl_interactions")
def promote(d):
    spark = d.raw.books.sparkSession
    root = work_folder(spark)
    pairs = {}
    for name, df in (("books", d.books), ("interactions", d.interactions)):
        tables.replace(df, f"{root}/{name}_staging")
        pairs[f"{root}/{name}_staging"] = f"{root}/{name}"
    done = tables.promote(spark, pairs)
    return done.select(F.regexp_extract("production", "([^/]+)$", 1).alias("table_name"), "row_count")


@on_tables("i15_retype_rating", "SELECT user_id, book_id, r4(rating) AS rating FROM fx_interactions")
def retype(d):
    return d.raw.interactions.select("user_id", "book_id", F.col("rating").cast("double").alias("rating"))


@on_tables("i16_feature_metadata", "SELECT 'features' AS table_name, count(*) AS row_count, CAST(37 AS BIGINT) AS columns FROM feats")
def feature_metadata(d):
    listing = tables.metadata(d.features, "features", _stamp())
    return listing.groupBy("table_name").agg(F.max("row_count").alias("row_count"), F.count(F.lit(1)).alias("columns"))


@on_tables("i16_feature_columns")
def feature_columns(d):
    return tables.metadata(d.features, "features", _stamp())


@on_tables("i17_sample_export", "SELECT TRUE AS within_limit, CAST(0 AS BIGINT) AS unknown_rows, CAST(37 AS BIGINT) AS columns")
def sample_export(d):
    """A random export has no fixed rows, so what must hold of any is returned: its bound, its origin and its columns."""
    path = f"{work_folder(d.raw.books.sparkSession)}/sample"
    sample = tables.replace(tables.system_sample(d.features, 0.001, 1000), path)
    known = d.features.select("user_id_clean", "book_id").distinct()
    unknown = sample.join(known, ["user_id_clean", "book_id"], "left_anti").agg(F.count(F.lit(1)).alias("unknown_rows"))
    return sample.agg((F.count(F.lit(1)) <= 1000).alias("within_limit")).crossJoin(F.broadcast(unknown)).withColumn("columns", F.lit(len(sample.columns)))


@on_tables("i18_random_rows", """
SELECT user_id_clean, book_id, r4(actual_rating) AS actual_rating, r4(predicted_rating) AS predicted_rating, r4(absolute_error) AS absolute_error, r4(error) AS error,
  r4(book_popularity_normalized) AS book_popularity_normalized, book_length_category, book_era, num_genres, user_activity_count, reading_pace_category, r4(average_rating) AS average_rating,
  ratings_count, num_pages, publication_year, author_gender_group FROM preds WHERE predicted_rating IS NOT NULL AND actual_rating IS NOT NULL
ORDER BY md5(concat_ws('/', user_id_clean, book_id, 42)), user_id_clean, book_id LIMIT 1000""")
def random_rows(d):
    rows = d.predictions.where(F.col("predicted_rating").isNotNull() & F.col("actual_rating").isNotNull())
    return tables.hashed_sample(rows, ["user_id_clean", "book_id"], 1000)


@on_tables("i19_stored_slice_metrics", """
SELECT slice_name, slice_dimension, slice_value, n AS "count", r4(mae) AS mae, r4(rmse) AS rmse, r4(mean_predicted) AS mean_predicted, r4(mean_actual) AS mean_actual,
  r4(mean_error) AS mean_error, r4(std_error) AS std_error, 'mean_deviation' AS model_name, 'test' AS dataset, '2024-01-31 00:00:00.000000' AS analysis_timestamp FROM slices""")
def stored_slices(d):
    rows = bias.labelled_metrics(bias.slice_metrics(d.predictions), "mean_deviation", "test", _stamp())
    return tables.replace(rows, f"{work_folder(d.raw.books.sparkSession)}/bias_metrics")


@on_tables("i20_metric_rows", """
SELECT '2024-01-31 00:00:00.000000' AS timestamp, 'mean_deviation' AS model_name, 'v1' AS model_version, metric_name, r4(metric_value) AS metric_value, n AS predictions_count, 'test' AS evaluation_dataset
FROM (UNPIVOT (SELECT count(*) AS n, avg(abs(error)) AS mae, sqrt(avg(error * error)) AS rmse, pow(corr(actual_rating, predicted_rating), 2) AS r_squared,
  corr(actual_rating, predicted_rating) AS correlation, 100.0 * count(*) FILTER (WHERE abs(error) <= 0.5) / count(*) AS accuracy_within_0_5,
  100.0 * count(*) FILTER (WHERE abs(error) <= 1.0) / count(*) AS accuracy_within_1_0 FROM preds)
  ON mae, rmse, r_squared, correlation, accuracy_within_0_5, accuracy_within_1_0 INTO NAME metric_name VALUE metric_value)""")
def metric_rows(d):
    wide = scoring.monitoring_metrics(d.predictions).withColumn("model_name", F.lit("mean_deviation"))
    return monitoring.metric_rows(wide, _stamp(), "v1", "test")


@on_tables("i21_parameterised_query", "SELECT user_id_clean, book_id, rating FROM cl_interactions WHERE rating >= 3 AND interaction_type_clean = 'read'")
def parameterised(d):
    spark = d.raw.books.sparkSession
    return spark.sql("SELECT user_id_clean, book_id, rating FROM {t} WHERE rating >= :low AND interaction_type_clean = :kind", t=d.interactions,
                     args={"low": 3, "kind": "read"})


@on_tables("i23_csv_sample", "SELECT book_id, title, num_pages FROM fx_books")
def csv_sample(d):
    spark = d.raw.books.sparkSession
    path = f"{work_folder(spark)}/csv"
    files.write_csv(d.raw.books.select("book_id", "title", "num_pages"), path)
    return spark.read.csv(path, header=True, schema="book_id bigint, title string, num_pages bigint", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@on_tables("i24_detection_report", """
SELECT 'mean_deviation' AS model_name, 'test' AS dataset, (SELECT count(*) FROM slices) AS slices, (SELECT count(*) FROM dims) AS dimensions,
  CAST(to_json(coalesce((SELECT list({'position': position, 'recommendation': recommendation} ORDER BY position) FROM advice), [{'position': 99, 'recommendation': 'No significant bias detected across analyzed dimensions.'}])) AS VARCHAR) AS recommendations""")
def detection_report(d):
    """Nested one-row JSON report, written and read back."""
    spark = d.raw.books.sparkSession
    path = f"{work_folder(spark)}/report"
    report = audit.detection_report(audit.detect(d.predictions), "mean_deviation", "test")
    files.write_report(report, path)
    back = spark.read.schema(report.schema).json(path)
    return back.select("model_name", "dataset", F.size("slice_metrics").alias("slices"), F.size("summary").alias("dimensions"), "recommendations")
