"""Ranks, running totals and percentiles against brute force, with a hot group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.operators import ordered


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    hot = [("hot", float(rng.choice([rng.random() * 100, 7.0]))) for _ in range(3000)]
    rest = [(f"k{rng.randrange(20)}", round(rng.gauss(0, 5), 2)) for _ in range(3000)]
    return hot + rest + [(None, 1.0), (None, 3.0), ("one", 4.5)]


@pytest.mark.parametrize("splits", [1, 7, 64])
def test_running_totals(spark, rows, splits):
    counts = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["k"], r["v"]): (r["n_before"], r["n_total"]) for r in ordered.running_totals(counts, ["k"], "v", ["n"], splits).collect()}
    values = {}
    for k, v in rows:
        values.setdefault(k, []).append(v)
    want = {(k, v): (sum(x < v for x in vs), len(vs)) for k, vs in values.items() for v in set(vs)}
    assert got == want


@pytest.mark.parametrize("method", ["linear", "discrete"])
def test_percentiles_per_key(spark, rows, method):
    df = spark.createDataFrame([r for r in rows if r[0]], "k string, v double")
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["k"]: r for r in ordered.exact_percentiles(df, ["k"], F.col("v"), probs, method, splits=16).collect()}
    values = {}
    for k, v in rows:
        if k:
            values.setdefault(k, []).append(v)
    for k, vs in values.items():
        for name, p in probs.items():
            want = np.quantile(vs, p, method="linear" if method == "linear" else "inverted_cdf")
            assert got[k][name] == pytest.approx(want)


def test_percentiles_of_whole_table(spark):
    df = spark.range(1, 10001).select(F.col("id").cast("double").alias("v"))
    got = ordered.exact_percentiles(df, [], F.col("v"), {"p80": 0.8}, "discrete").first()
    assert got["p80"] == 8000.0


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert ordered.exact_percentiles(df, [], F.col("v"), {"p50": 0.5}).first()["p50"] is None


def test_positions_are_dense_and_follow_the_order(spark):
    df = spark.range(2000).select("id", (F.col("id") * 7919 % 101).alias("score"))
    got = ordered.positions(df, [], [-F.col("score"), F.col("id")], splits=32).collect()
    want = sorted(((-r["score"], r["id"]) for r in got))
    assert [(-r["score"], r["id"]) for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, 2001))


def test_latest_by_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "z"), ("b", 0, "w")], "k string, t int, v string")
    got = {r["k"]: (r["t"], r["v"]) for r in ordered.latest_by(df, ["k"], [F.col("t")]).collect()}
    assert got == {"a": (2, "y"), "b": (0, "w")}


@pytest.mark.parametrize("k", [1, 3, 50])
def test_first_unseen_matches_brute_force(spark, k):
    rng = random.Random(k)
    items = list(range(40))
    seen = [(f"u{u}", rng.choice(items)) for u in range(12) for _ in range(rng.randrange(60))]
    seen += [("all", i) for i in items] + [("head", i) for i in range(25)] + [("head", 999)]
    users = sorted({u for u, _ in seen} | {"new"})
    order = spark.createDataFrame([(i, i + 1) for i in items], "book_id int, position bigint")
    got = ordered.first_unseen(spark.createDataFrame([(u,) for u in users], "user_id string"), spark.createDataFrame(seen, "user_id string, book_id int"),
                               order, "user_id", "book_id", k).collect()
    read = {u: {i for v, i in seen if v == u} for u in users}
    want = {(u, n, i) for u in users for n, i in enumerate([i for i in items if i not in read[u]][:k], 1)}
    assert {(r["user_id"], r["unseen_rank"], r["book_id"]) for r in got} == want


def test_top_per_key_trims_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    top = ordered.top_per_key(df, ["k"], [F.desc("id")], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in top.collect()) == [994, 995, 996, 997, 998, 999]
