"""Periodic runs against every lag and place."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliospark.llm import periodic
from foliospark.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.conftest import LONG, ROWS


def brute(words):
    """Every maximal stretch of every lag; of equal stretches the smallest lag."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def got(words):
    return [tuple(r) for r in periodic.runs_of(np.array(words, dtype=np.int64)).tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=70))
def test_binary_words(words):
    assert got(words) == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=9), st.integers(2, 9), st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), min_size=1, max_size=4), st.integers(1, 8))
def test_nested_repeats(unit, times, gap, other, again):
    words = gap + unit * times + gap + other * again + (unit * 2 + other) * times
    assert got(words) == brute(words)


def test_long_periods_and_grams_that_come_twice_in_a_period():
    rng = random.Random(5)
    for _ in range(40):
        unit = [rng.randrange(2) for _ in range(rng.randrange(1, 90))]
        words = [rng.randrange(3) for _ in range(rng.randrange(30))] + (unit * 6)[:rng.randrange(len(unit) * 3, len(unit) * 6)] + [rng.randrange(3) for _ in range(30)]
        assert got(words) == brute(words)


def test_one_word_over_and_over_is_linear():
    assert got([7] * 400_000) == [(0, 400_000, 1)]
    assert got(list(range(500)) * 400) == [(0, 200_000, 500)]


def expected(doc_id, text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    number = {}
    runs = brute([number.setdefault(w, len(number)) for w in words])
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = None
    for s, m, q in runs:
        if best is None or m * best[2] > best[1] * q:
            best = (s, m, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_every_lag(ready_spark):
    short = {r["doc_id"]: r["text"] for r in ready_spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r["text"] or "") < 9_000}
    out = QUERIES["op12_periodic_runs"](ready_spark, SF)
    assert [t for c, t in out.dtypes if c in ("doc_id", *COLUMNS[:5])] == ["bigint"] * 6
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in out.collect()}
    assert len(rows) == ready_spark.read.parquet(f"{SF}/documents.parquet").count()
    assert {d: rows[d] for d in short} == {d: expected(d, t) for d, t in short.items()}
    assert sum(r[0] for r in rows.values()) > 10


def test_edges(edge, empty):
    rows = periodic.find(edge).collect()
    assert len(rows) == len(ROWS) and periodic.find(empty).count() == 0
    of = {r["doc_id"]: r for r in rows}
    assert (of[3]["n_words"], of[3]["runs"], of[3]["collapsed"]) == (0, [], "") and of[4]["n_words"] == of[8]["n_words"] == 0
    assert [tuple(r) for r in of[5]["runs"]] == [(0, len(LONG.split()), 5)] and of[5]["collapsed"] == "lorem ipsum dolor sit amet"
    assert of[7]["collapsed"].split(" ")[-3:] == ["\x00", "\u2028", "end"] and sum(r["doc_id"] is None for r in rows) == 2


@pytest.mark.parametrize("words", [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4])
def test_least_lengths(words):
    assert got([ord(w) for w in words]) == ([(0, 6, 1)] if words == ["a"] * 6 else [(0, 8, 2)] if len(words) == 8 else [])
