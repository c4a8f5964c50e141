"""Day sketches against the rows they were made from."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from foliospark.operators import sketches
from foliospark.session import work_folder

MARKS = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
FIRST = dt.date(2024, 1, 1)


def rows_of(days, seed):
    rng = random.Random(seed)
    return [(FIRST + dt.timedelta(d), rng.choice("ab"), rng.choice([rng.expovariate(0.1), float(rng.randrange(5)), None]), f"m{rng.randrange(700)}") for d in days for _ in range(1500)]


@pytest.fixture(scope="module")
def world(spark):
    rows, path = rows_of(range(6), 1), f"{work_folder(spark)}/sketches"
    frame = spark.createDataFrame(rows, "day date, key string, value double, member string")
    sketches.add_days(made(frame), path)
    return rows, frame, path


def made(frame):
    return sketches.of_days(frame, ["key"], F.col("value"), F.col("member"), F.col("day"))


@pytest.mark.parametrize("low, high", [(0, 5), (2, 2), (1, 4)])
def test_ranges(spark, world, low, high):
    rows, frame, path = world
    first, last = FIRST + dt.timedelta(low), FIRST + dt.timedelta(high)
    found = sketches.merged(sketches.read_range(spark, path, first, last), ["key"], MARKS)
    got = {r["key"]: r for r in found.collect()}
    for key in "ab":
        mine = [r for r in rows if r[1] == key and first <= r[0] <= last]
        values = sorted(r[2] for r in mine if r[2] is not None)
        r = got[key]
        assert (r["n"], r["n_values"], r["low"], r["high"]) == (len(mine), len(values), values[0], values[-1]) and abs(r["mean"] - sum(values) / len(values)) < 1e-9
        assert abs(r["members"] - len({x[3] for x in mine})) <= 0.06 * len({x[3] for x in mine})
    some = frame.where(F.col("day").between(F.lit(first), F.lit(last)))
    checks = sketches.within_rank(some, ["key"], F.col("value"), found.select("key", *MARKS), MARKS).collect()
    assert len(checks) == 2 and all(all(c[f"{m}_within"] for m in MARKS) for c in checks)


def test_a_day_is_added_and_replaced_alone(spark, world):
    rows, frame, _ = world
    path = f"{work_folder(spark)}/sketches"
    files = lambda: {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    sketches.add_days(made(frame), path)
    before = files()
    day = FIRST + dt.timedelta(3)
    sketches.add_days(made(frame.where(F.col("day") == F.lit(day)).limit(100)), path)
    after = files()
    assert {f for f in before if f"date={day}" not in f} == {f for f in after if f"date={day}" not in f} and all(after[f] == before[f] for f in after if f"date={day}" not in f)
    assert spark.read.parquet(path).where(F.col("date") == F.lit(day)).agg(F.sum("n")).first()[0] == 100
    sketches.add_days(made(spark.createDataFrame(rows_of([9], 2), frame.schema)), path)
    assert spark.read.parquet(path).agg(F.sum("n")).first()[0] == 5 * 1500 + 100 + 1500


def test_no_values(spark, world):
    _, frame, _ = world
    only = made(frame.where("value IS NULL"))
    r = sketches.merged(only, [], MARKS).first()
    assert r["n"] > 0 and r["n_values"] == 0 and r["p50"] is None and r["mean"] is None
    assert sketches.merged(made(frame.limit(0)), ["key"], MARKS).count() == 0
