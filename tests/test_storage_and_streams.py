"""Table maintenance, streaming replay safety, models, and the plan shapes that matter at scale."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from foliospark.functions.labels import audit_slices
from foliospark.operators import bias, etl, models, recommend
from foliospark.session import work_folder
from foliospark.sources import adapters, files, histories, tables
from foliospark.streaming import events as event_stream
from foliospark.streaming import sinks
from tests.conftest import SF


def test_replace_from_self(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = tables.replace(spark.range(10), path)
    out = tables.replace_from_self(stored.where("id < 4"), path)
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2, 3]
    assert not tables.exists(spark, path + "__next") and not tables.exists(spark, path + "__old")


def test_promote_drops_staging_only_after_the_copy(spark, tmp_path):
    tables.replace(spark.range(3), str(tmp_path / "s"))
    report = tables.promote(spark, {str(tmp_path / "s"): str(tmp_path / "p")}).first()
    assert report["row_count"] == 3 and not tables.exists(spark, str(tmp_path / "s")) and tables.read(spark, str(tmp_path / "p")).count() == 3


def test_set_up_is_idempotent_and_partitioned(spark, tmp_path):
    assert {r["created"] for r in histories.set_up(spark, str(tmp_path)).collect()} == {True}
    assert {r["created"] for r in histories.set_up(spark, str(tmp_path)).collect()} == {False}
    days = [dt.datetime(2024, 1, d, 12, tzinfo=dt.timezone.utc) for d in range(1, 11)]
    rows = spark.createDataFrame([(d, "m", "v", "rmse", 1.0, 5, "test") for d in days], histories.METRICS)
    histories.append_dated(rows, str(tmp_path / "model_metrics_history"), "timestamp")
    recent = histories.read_since(spark, str(tmp_path / "model_metrics_history"), "timestamp", days[7])
    assert recent.count() == 3
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(1000)
    a, b = (sorted(r["id"] for r in tables.hashed_sample(df.repartition(n), ["id"], 50).collect()) for n in (2, 7))
    assert a == b and len(a) == 50


def test_catalogue_fallbacks(spark, tmp_path):
    path = tmp_path / "books.json"
    path.write_text('{"book_id": "1", "book_title": "", "title": "T", "average_rating": "0"}\n{"authors_flat": "A", "average_rating": "4.5", "isbn_clean": "9"}\n')
    got = [tuple(r) for r in files.read_catalogue(spark, str(path)).orderBy("book_id").collect()]
    assert got == [("", "Unknown Title", "A", 4.5, "9"), ("1", "T", "Unknown Author", 3.5, "")]


def test_work_folder_follows_the_session_setting(spark):
    def session(setting, master="local[2]"):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master, _jvm=spark.sparkContext._jvm)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context)

    shared = session("hdfs://shared/work/", "spark://cluster")
    assert work_folder(shared).startswith("hdfs://shared/work/foliospark-") and work_folder(shared) != work_folder(shared)
    assert work_folder(session(None)).startswith("/tmp/run-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(session(None, "spark://cluster"))


def test_replayed_batches_change_nothing(spark, tmp_path):
    """The same micro-batch twice, and again under a new id, leaves one row per pair."""
    sink = event_stream.append_sink(str(tmp_path / "t"), str(tmp_path / "bad"))
    batch = adapters.events(spark, SF).where("event_id < 400")
    for batch_id in (0, 0, 1):
        sink(batch, batch_id)
    rest = adapters.events(spark, SF).where("event_id >= 400")
    sink(rest, 2)
    want = etl.migrate_events(adapters.events(spark, SF).where("event_type IN ('click', 'like', 'add_to_list')"))
    for got in (event_stream.current(spark, str(tmp_path / "t")), event_stream.compact(spark, [str(tmp_path / "t")], str(tmp_path / "whole"))):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_events_against_stored_rows(spark):
    """A stored read outlives an older click, a later event wins over text order, and events compete by strength first."""
    columns = etl.INTERACTION_COLUMNS
    row = lambda user, book, text, kind, rating: (user, book, "r", text, text, text, "", kind == "read", rating, "", kind)
    stored = spark.createDataFrame([
        row("a", 1, "Sat Nov 01 12:00:00 +0000 2025", "read", 5), row("b", 1, "Wed Dec 31 12:00:00 +0000 2025", "like", 4), row("c", 1, "2025-01-01 00:00:00.000000+00", "like", 0),
        row("d", 1, None, "read", 3)], ", ".join(f"{c} {dict(book_id='bigint', is_read='boolean', rating='bigint').get(c, 'string')}" for c in columns))
    events = spark.createDataFrame([("1", "a", "1", "click", "2020-05-05 00:00:00"), ("2", "b", "1", "like", "2026-06-01 00:00:00"), ("3", "c", "1", "click", "2026-01-01 00:00:00"),
                                    ("4", "d", "1", "click", "2026-01-01 00:00:00"), ("5", "e", "x", "like", "2026-01-01 00:00:00")],
                                   "event_id string, user_id string, book_id string, event_type string, t string").withColumn("event_timestamp", F.col("t").cast("timestamp"))
    got = {r["user_id"]: (r["interaction_type"], r["is_read"], r["rating"]) for r in etl.merge_events(stored, events).collect()}
    assert got == {"a": ("read", True, 5), "b": ("like", False, 0), "c": ("like", False, 0), "d": ("click", False, 0), "e": ("like", False, 0)}


def test_batch_folder_overwrites_its_own_batch(spark, tmp_path):
    write = sinks.batch_folder(str(tmp_path / "t"))
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(2), 1)
    assert tables.read(spark, str(tmp_path / "t")).count() == 7


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [(f"u{u}", b, float(1 + (u * 7 + b * 3) % 5)) for u in range(30) for b in range(25) if (u + b) % 3]
    return spark.createDataFrame(rows, "user_id_clean string, book_id bigint, rating double").cache()


def test_factor_recommendations_are_the_exact_top(spark, ratings):
    fitted = models.fit_factors(ratings, rank=4, iterations=4)
    read = spark.createDataFrame([("u0", b) for b in range(24)] + [("u1", 3), ("u2", 99)], "user_id string, book_id bigint")
    got = {}
    for r in models.factor_recommendations(fitted, read, k=3).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["book_id"], r["predicted_rating"]))
    pairs = ratings.select("user_id_clean").distinct().crossJoin(ratings.select("book_id").distinct())
    scores = {}
    for r in models.score_factors(pairs, fitted).collect():
        scores.setdefault(r["user_id_clean"], {})[r["book_id"]] = r["predicted_rating"]
    assert len(got["u0"]) == 1 and got["u0"][0][1] == 24
    for user, rows in got.items():
        seen = {b for u, b in [tuple(x) for x in read.collect()] if u == user}
        best = sorted((s for b, s in scores[user].items() if b not in seen), reverse=True)[:3]
        assert [p for _, _, p in sorted(rows)] == pytest.approx(best, abs=1e-4)


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "book_era string")
    codes = models.category_codes(df)
    assert sorted(r["book_era"] for r in models.with_codes(df, codes).collect()) == [-1, 0, 1, 1]


# ---- plan shapes --------------------------------------------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_slices_read_the_predictions_once(spark, tmp_path):
    cols = "actual_rating double, predicted_rating double, book_popularity_normalized double, book_length_category string, book_era string, num_genres int, user_activity_count bigint, reading_pace_category string, author_gender_group string, other string"
    df = tables.replace(spark.createDataFrame([], cols), str(tmp_path / "p"))
    plan = plan_of(bias.slice_metrics(df, audit_slices()))
    assert plan.count("FileScan") == 1 and "other" not in plan.split("ReadSchema")[1]


def test_top_list_is_not_a_full_sort(spark, tmp_path):
    books = tables.replace(spark.range(100).select(F.col("id").alias("book_id"), F.rand().alias("average_rating"), F.lit("t").alias("title_clean"), F.lit(1).alias("ratings_count")), str(tmp_path / "b"))
    author = spark.createDataFrame([(1, "A")], "book_id bigint, author string")
    assert "TakeOrderedAndProject" in plan_of(recommend.global_top(books, author))


def test_latest_by_combines_before_the_shuffle(spark):
    from foliospark.operators.ordered import latest_by

    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(latest_by(df, ["k"], [F.col("id")]))
    assert "partial_max" in plan and "Window" not in plan


def test_filters_reach_the_scan(spark):
    df = adapters.table(spark, SF, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    plan = plan_of(df)
    assert "EqualTo(o_orderstatus,F)" in plan and "o_totalprice" not in plan.split("ReadSchema")[1]
