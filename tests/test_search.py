"""Indexed search against looking at every text."""

import random

import pytest

from foliospark.operators import recommend, search
from foliospark.session import work_folder

ROWS = [(1, "The Red Widget", "Ann Lee"), (2, "a", None), (3, None, "Bo"), (4, "", ""), (5, "ab", "ba"), (6, "ananas banana", "Ana Nan"), (7, "ÄÖ 😀x😀y", "ß中文字"), (8, "x" * 3000, "end"), (1, "The Red Widget", "Ann Lee"),
        (9, "A. B. (C) *.* [d]%_\\", "O'Neil"), (10, "tail \x00", "￿"), (None, "no id widget", "n")]


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(2)
    rows = ROWS + [(100 + i, "".join(rng.choices("abC ", k=rng.randrange(12))), rng.choice(["Ab Ca", "cab", None])) for i in range(300)]
    frame = spark.createDataFrame(rows, "book_id int, title string, author string").repartition(4)
    path = f"{work_folder(spark)}/search"
    search.build(frame, path, buckets=16)
    return rows, frame, path


def brute(rows, needle, k=20):
    hit = [r for r in rows if any(f is not None and needle.lower() in f.lower() for f in r[1:])]
    return sorted(hit, key=lambda r: (r[0] is not None, r[0] or 0, str(r)))[:k]


@pytest.mark.parametrize("needle", ["wid", "RED WIDGET", "a", "ab", "ana", "anana", "abca", "b c", "😀x", "中文", "ß", "[d]%_\\", "*.*", "zzz", "xxxx", "x" * 40, "é", "the red widget!", "\x00", "￿", "l \x00"])
def test_same_rows(spark, world, needle):
    rows, _, path = world
    got = [tuple(r) for r in search.search(spark, path, needle, hits=1000, buckets=16).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, needle, 1000)))
    first = [r[0] for r in search.search(spark, path, needle, buckets=16).collect()]
    assert first == [r[0] for r in brute(rows, needle)]


def test_empty_needle(spark, world):
    rows, frame, path = world
    assert [r[0] for r in search.search(spark, path, "", buckets=16).collect()] == [r["book_id"] for r in recommend.search(frame, "").collect()]


def test_plan_reads_few_postings(spark, world):
    _, _, path = world
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = search.matches(spark, path, "red widget", buckets=16)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans and all("/postings" in s and "bucket" in s.split("PartitionFilters")[1].split("]")[0] and "EqualTo(gram" in s for s in scans)
    assert "/rows" not in plan


def test_empty_catalogue(spark, world):
    _, frame, _ = world
    path = f"{work_folder(spark)}/search"
    search.build(frame.limit(0), path)
    assert search.search(spark, path, "wid").count() == 0 and search.search(spark, path, "").count() == 0
