"""Book-shaped inputs derived from the supplied star-schema tables. All rows are used."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.dates import activity_text

AS_OF = dt.date(2002, 1, 1)
EVENTS_AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS book_id",
        "CASE WHEN p_partkey % 97 = 0 THEN '  ' ELSE p_name END AS title",
        "concat(p_brand, ' ', p_type) AS description",
        """CASE WHEN p_partkey % 4 = 0
             THEN array(named_struct('author_id', cast(p_partkey % 100 AS string)),
                        named_struct('author_id', cast((p_partkey * 3 + 1) % 100 AS string)))
             ELSE array(named_struct('author_id', cast(p_partkey % 100 AS string))) END AS authors""",
        "CASE WHEN p_size % 3 = 0 THEN array('s1', cast(NULL AS string)) ELSE cast(array() AS array<string>) END AS series",
        """transform(CASE WHEN p_size % 7 = 0 THEN cast(array() AS array<int>) ELSE sequence(1, p_size % 7) END,
             i -> named_struct('count', cast(i AS string), 'name', concat('g', i))) AS popular_shelves""",
        "cast(CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE 1880 + (p_partkey % 125) END AS bigint) AS publication_year",
        "cast(p_size AS bigint) * 45 - 40 AS num_pages",
        "cast(1.0 + (p_partkey % 401) / 100.0 AS double) AS average_rating",
        "cast((p_partkey * 7) % 500 AS bigint) AS ratings_count",
        "cast(p_partkey % 40 AS bigint) AS text_reviews_count",
        "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_partkey % 2 = 0 END AS is_ebook",
    )


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS author_id",
        """CASE WHEN s_suppkey % 13 = 5 THEN NULL WHEN s_suppkey % 11 = 3 THEN '   '
             WHEN s_suppkey % 7 = 2 THEN concat('J. ', s_name) ELSE concat(s_name, ' Jr') END AS name""",
    )


def name_genders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "lower(s_name) AS first_name",
        """CASE s_nationkey % 5 WHEN 0 THEN 'male' WHEN 1 THEN 'mostly_male' WHEN 2 THEN 'female'
             WHEN 3 THEN 'mostly_female' ELSE 'andy' END AS gender""",
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    shipped, ordered = activity_text(F.col("l_shipdate")), activity_text(F.col("o_orderdate"))
    line = F.col("l_linenumber")
    flag = F.col("l_returnflag")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("u"), "o_custkey").alias("user_id"),
        F.col("l_partkey").alias("book_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        ordered.alias("date_added"),
        shipped.alias("date_updated"),
        F.when(line == 7, F.lit("")).otherwise(shipped).alias("read_at"),
        F.when(line == 6, F.lit("junk")).otherwise(ordered).alias("started_at"),
        (flag == "R").alias("is_read"),
        (line % 6).cast("bigint").alias("rating"),
        F.lit("").alias("review_text_incomplete"),
        F.when(line == 5, F.lit(None).cast("string")).when(flag == "R", "read").when(flag == "A", "like")
        .when(F.col("l_linestatus") == "F", "add_to_list").otherwise("view").alias("interaction_type"),
    )


def events_of(raw: DataFrame) -> DataFrame:
    """Works on the batch table and on a stream of it."""
    kind = F.col("event_type")
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("u"), "user_id").alias("user_id"),
        F.get_json_object("props", "$.k").alias("book_id"),
        F.lit(None).cast("string").alias("book_title"),
        F.when(kind == "purchase", "like").when(kind == "signup", "add_to_list").otherwise(kind).alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw event table as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def requests_of(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("ts").cast("timestamp").alias("ts"), F.lit("GET").alias("method"),
        F.concat(F.lit("/"), "event_type", F.lit("/"), "user_id").alias("path"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("failed "), "event_id")).alias("error_message"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_of(table(spark, sf_dir, "events"))


def log_lines_of(raw: DataFrame) -> DataFrame:
    """Log lines in the shapes that services write: JSON, two bracketed forms, and free text."""
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    plain = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    text = F.concat(F.lit("user "), "user_id", F.lit(" did "), "event_type")
    as_json = F.to_json(F.struct(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), F.lit("INFO").alias("level"),
        F.lit("api").alias("logger"), text.alias("message"), F.lit("events").alias("module"),
        F.lit("record").alias("function"), (F.col("event_id") % 90).alias("line")))
    message = (
        F.when(kind == "click", as_json)
        .when(kind == "view", F.concat(F.lit("["), plain, F.lit(",123] {flow.py:load} INFO - "), text))
        .when(kind == "error", F.concat(F.lit("["), plain, F.lit("] ERROR - "), text))
        .otherwise(text)
    )
    return raw.select(message.alias("message"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines_of(table(spark, sf_dir, "events"))


def frontend_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One browser metrics payload per event, as JSON text, with its arrival time."""
    value, kind = F.col("value"), F.col("event_type")
    payload = F.to_json(F.struct(
        F.concat(F.lit("s"), "user_id").alias("sessionId"),
        F.struct(
            F.when(kind == "signup", F.array().cast("array<struct<latency:double>>"))
            .otherwise(F.array(F.struct(value.alias("latency")), F.struct((value * 2).alias("latency")))).alias("apiCalls"),
            F.when(kind == "error", F.array(F.concat(F.lit("e"), F.col("event_id")))).otherwise(
                F.array().cast("array<string>")).alias("errors"),
            F.struct(
                (F.col("event_id") % 3 * value).alias("lcp"), F.when(kind == "click", value).alias("inp"),
                (F.col("event_id") % 2).cast("double").alias("cls"), value.alias("fcp"),
                F.lit(None).cast("double").alias("ttfb")).alias("webVitals"),
        ).alias("metrics")))
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("received_at"), payload.alias("payload"))


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly metric rows per event type, in the layout of the metric history. One type gets worse in the last week."""
    value = F.col("value")
    hourly = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("timestamp"), F.col("event_type").alias("model_name")).agg(
        (F.avg(value) / 3).alias("mae"), F.sqrt(F.avg(value * value)).alias("rmse"), F.avg(F.when(value < 30, 1.0).otherwise(0.0)).alias("r_squared"),
        F.count(F.lit(1)).alias("predictions_count"))
    worse = (F.col("model_name") == "click") & (F.col("timestamp") >= F.lit(dt.datetime(2024, 1, 24, tzinfo=dt.timezone.utc)))
    hourly = hourly.withColumn("rmse", F.when(worse, F.col("rmse") * 1.5).otherwise(F.col("rmse")))
    return hourly.unpivot(["timestamp", "model_name", "predictions_count"], ["mae", "rmse", "r_squared"], "metric_name", "metric_value").select(
        "timestamp", "model_name", F.lit("v1").alias("model_version"), "metric_name", "metric_value", "predictions_count",
        F.lit("test").alias("evaluation_dataset"))


def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rows in the layout of the drift history."""
    v = F.col("metric_value")
    return metric_history(spark, sf_dir).where(F.col("metric_name") == "mae").select(
        "timestamp", F.col("model_name").alias("feature_name"), v.alias("baseline_mean"), (v / 2).alias("baseline_std"), (v + 1).alias("current_mean"),
        (v / 3).alias("current_std"), F.lit(0.1).alias("ks_statistic"), F.lit(0.2).alias("ks_pvalue"), (v / 7).alias("psi_score"), (v > 7).alias("drift_detected"))


def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_type AS prefix", "concat(p_type, '_', p_partkey) AS model_name",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(p_partkey % 1000 AS int), 0) AS created",
        "p_brand AS display_name", "p_partkey AS version", "p_partkey % 10 = 3 AS is_default")


def version_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").selectExpr(
        "CASE WHEN p_partkey % 50 = 7 THEN concat('lost ', p_brand) ELSE p_brand END AS display_name", "p_partkey AS version",
        "p_size / 10.0D AS mae", "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_retailprice / 1000.0D END AS rmse",
        "(p_partkey % 7) / 10.0D AS r_squared")


def order_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before and from 1998 on: the two sides of a drift check. The later customer keys are doubled, which is the drift."""
    orders = table(spark, sf_dir, "orders").select("o_totalprice", "o_custkey", "o_orderdate")
    cut = F.lit(dt.datetime(1998, 1, 1, tzinfo=dt.timezone.utc))
    later = orders.where(F.col("o_orderdate") >= cut).withColumn("o_custkey", F.col("o_custkey") * 2)
    return orders.where(F.col("o_orderdate") < cut), later
