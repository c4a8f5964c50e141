import datetime as dt

import pytest
from pyspark.sql import functions as F

from foliospark.functions import dates, labels, numbers, text
from foliospark.operators import cleaning


def values(spark, ddl, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_clean_text(spark):
    got = values(spark, "s string", [("  a ",), ("   ",), ("",), (None,)], text.clean_text(F.col("s")))
    assert got == [("a",), ("Unknown",), ("Unknown",), ("Unknown",)]


def test_word_count_counts_empty_pieces(spark):
    assert values(spark, "s string", [("",), ("a b",), ("a  b",)], text.word_count(F.col("s"))) == [(1,), (2,), (3,)]


@pytest.mark.parametrize("path,masked", [
    ("/books/12345678901234567890/details", "/books/{id}/details"), ("/books/7", "/books/{id}"), ("/", "/"), ("", "/"), ("/a/", "/a"),
    ("/x/" + "y" * 21, "/x/{id}"), ("/x/" + "y" * 20, "/x/" + "y" * 20)])
def test_masked_path(spark, path, masked):
    assert values(spark, "p string", [(path,)], text.masked_path(F.col("p"))) == [(masked,)]


def test_display_rating(spark):
    got = values(spark, "r string", [("4.26",), ("N/A",), (None,), ("x",), ("3",)], text.display_rating(F.col("r")))
    assert got == [("4.3",), ("N/A",), ("N/A",), ("N/A",), ("3.0",)]


def test_activity_time(spark):
    rows = [("Sat Nov 01 12:30:00 +0000 2025",), ("Sat Nov 01 12:30:00 -0700 2025",), ("junk",), ("",), (None,), ("Xyz Nov 01 12:30:00 +0000 2025",)]
    got = [r[0] for r in values(spark, "s string", rows, F.date_format(dates.activity_time(F.col("s")), "yyyy-MM-dd HH:mm"))]
    assert got == ["2025-11-01 12:30", "2025-11-01 19:30", None, None, None, None]


def test_any_time_reads_its_own_instant_text(spark):
    ts = F.lit(dt.datetime(2024, 1, 2, 3, 4, 5, 678901, tzinfo=dt.timezone.utc))
    row = spark.range(1).select((dates.any_time(dates.instant_text(ts)) == ts).alias("same")).first()
    assert row["same"]


def test_reading_days_range(spark):
    d = lambda y, m, day: dt.datetime(y, m, day, tzinfo=dt.timezone.utc)
    rows = [(d(2020, 1, 1), d(2020, 1, 1)), (d(2020, 1, 1), d(2020, 1, 2)), (d(2020, 1, 1), d(2020, 12, 31)), (d(2020, 1, 1), d(2021, 1, 1)), (d(2020, 1, 2), d(2020, 1, 1))]
    got = values(spark, "a timestamp, b timestamp", rows, dates.reading_days(F.col("a"), F.col("b")))
    assert got == [(None,), (1,), (365,), (None,), (None,)]


def test_whole_rounds_halves_away_from_zero(spark):
    assert values(spark, "x double", [(2.5,), (-2.5,), (1.4,), (1.5,)], numbers.whole(F.col("x"))) == [(3,), (-3,), (1,), (2,)]


def test_wilson_rating(spark):
    rows = [(4.0, 0), (None, None), (5.0, 1000000), (4.0, 10), (0.0, 100)]
    got = [r[0] for r in values(spark, "a double, n bigint", rows, numbers.wilson_rating(F.col("a"), F.col("n")))]
    assert got[:2] == [3.0, 3.0]
    assert got[2] == pytest.approx(5.0, abs=1e-4)
    assert 1.0 < got[3] < 4.0
    assert got[4] == got[4]  # a rating below the scale gives no NaN


def test_split_bucket_range(spark):
    got = [r[0] for r in spark.range(500).select(numbers.split_bucket(F.col("id"))).collect()]
    assert min(got) >= 0 and max(got) < 100 and len(set(got)) > 80


@pytest.mark.parametrize("days,label", [(7, "quick_read"), (7.5, "moderate"), (14, "moderate"), (30, "long_read"), (31, "very_long"), (None, "very_long")])
def test_reading_pace_steps(spark, days, label):
    assert values(spark, "d double", [(None if days is None else float(days),)], labels.reading_pace(F.col("d"))) == [(label,)]


def test_cleaner_dispatches_by_type(spark):
    df = spark.createDataFrame([(5, " t ", ["a", None, 'q"'], None, [("1", "n")])], "n bigint, s string, tags array<string>, ok boolean, shelves array<struct<count:string,name:string>>")
    row = cleaning.clean_columns(df).first()
    assert row.asDict() == {"n": 5, "s_clean": "t", "tags_flat": ['"a"', '"q\\""'], "ok": False, "shelves_flat": ['{"count":"1","name":"n"}']}


def test_cleaner_turns_missing_arrays_into_empty_ones(spark):
    assert cleaning.clean_columns(spark.createDataFrame([(None,)], "tags array<int>")).first()["tags_flat"] == []


def test_clean_table_drops_exact_duplicates_after_cleaning(spark):
    df = spark.createDataFrame([(1, "a "), (1, " a"), (2, "b")], "id int, s string")
    assert cleaning.clean_table(df).count() == 2


def test_slug():
    assert text.slug("Book Era") == "book_era"
