"""Small hand-made frames and properties for the operators."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.operators import bias, etl, features, mitigation, monitoring, ordered, quality, recommend, relational, requests, selection
from foliospark.plans import audit

UTC = dt.timezone.utc


# ---- quality ------------------------------------------------------------------------------------------

def test_gate_raises_with_the_failed_rules(spark):
    books = spark.createDataFrame([(1, "a"), (None, "b")], "book_id int, title string")
    report = quality.rule_report(books, "books", quality.source_book_rules())
    with pytest.raises(quality.QualityError, match="null book_id"):
        quality.gate(report)


def test_empty_table_fails_the_gate(spark):
    books = spark.createDataFrame([], "book_id int, title string")
    got = {r["rule"]: r["passed"] for r in quality.rule_report(books, "books", quality.source_book_rules()).collect()}
    assert got == {"table is not empty": False, "null book_id": True, "null title": True}


def test_events_split_into_valid_and_rejected(spark):
    now = dt.datetime(2024, 1, 1, tzinfo=UTC)
    rows = [("1", "u", 1, "click", now), ("2", None, 1, "click", now), ("3", "u", 1, "purchase", now), ("4", "u", 1, None, now)]
    good, bad = quality.split_events(spark.createDataFrame(rows, "event_id string, user_id string, book_id bigint, event_type string, event_timestamp timestamp"))
    assert [r["event_id"] for r in good.collect()] == ["1"] and bad.count() == 3


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    got = {r["bin"]: r["row_count"] for r in quality.histogram(df, F.col("v"), 10, "v").collect()}
    assert got == {**{b: 1 for b in range(1, 10)}, 10: 2}


# ---- etl ----------------------------------------------------------------------------------------------

def test_event_priority_wins_over_recency(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h, tzinfo=UTC)
    rows = [("1", "u", "7", "like", t(1)), ("2", "u", "7", "click", t(9)), ("3", "u", "7", "view", t(10)), ("4", "v", "8", "click", t(1)), ("5", "v", "8", "click", t(2))]
    df = spark.createDataFrame(rows, "event_id string, user_id string, book_id string, event_type string, event_timestamp timestamp")
    assert {r["event_id"] for r in etl.strongest_events(df).collect()} == {"1", "5"}
    assert {r["interaction_type"] for r in etl.migrate_events(df).collect()} == {"like", "click"}


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([("a", 1, "r1", "d", "d", "", "s", False, 2, "t", "click"), ("b", 2, "r2", "d", "d", "", "s", False, 3, "t", "like")],
                                   "user_id string, book_id bigint, review_id string, date_added string, date_updated string, read_at string, started_at string, "
                                   "is_read boolean, rating bigint, review_text_incomplete string, interaction_type string")
    when = dt.datetime(2025, 11, 1, 12, 30, tzinfo=UTC)
    source = spark.createDataFrame([("a", 1, None, when), ("a", 1, 5, when - dt.timedelta(days=1)), ("c", 3, 4, when)], "user_id string, book_id bigint, rating int, read_time timestamp")
    got = {r["user_id"]: r for r in etl.upsert_reads(target, source).collect()}
    assert len(got) == 3
    assert (got["a"]["rating"], got["a"]["is_read"], got["a"]["interaction_type"], got["a"]["started_at"], got["a"]["read_at"]) == (0, True, "read", "s", "Sat Nov 01 12:30:00 +0000 2025")
    assert got["b"]["interaction_type"] == "like"
    assert (got["c"]["review_id"], got["c"]["started_at"], got["c"]["rating"]) == (None, "", 4)


def test_backfill_priority(spark):
    df = spark.createDataFrame([(True, 0, None), (False, 3, None), (False, 0, None), (None, None, None), (True, 5, "click")], "is_read boolean, rating bigint, interaction_type string")
    assert [r["interaction_type"] for r in etl.backfill_type(df).collect()] == ["read", "like", "add_to_list", "add_to_list", "click"]


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "k int")
    assert [r["k"] for r in relational.not_in(left, frame([1]), "k").collect()] == [2]
    assert relational.not_in(left, frame([1, None]), "k").count() == 0
    assert relational.not_in(left, frame([]), "k").count() == 3


# ---- features ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("ratios,bounds", [((0.7, 0.15, 0.15), (70, 85)), ((0.6, 0.2, 0.2), (60, 80)), ((0.8, 0.1, 0.1), (80, 90))])
def test_split_bounds(ratios, bounds):
    assert features.split_bounds(*ratios) == bounds


def test_split_is_complete_and_keeps_users_together(spark):
    df = spark.range(4000).select(F.concat(F.lit("u"), F.col("id") % 900).alias("user_id_clean"))
    got = features.with_split(df)
    assert got.count() == 4000
    assert got.groupBy("user_id_clean").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    shares = {r["split"]: r["count"] / 4000 for r in got.groupBy("split").count().collect()}
    assert abs(shares["train"] - 0.7) < 0.08 and set(shares) == {"train", "val", "test"}


def test_bad_split_ratios_are_refused():
    with pytest.raises(ValueError):
        features.split_bounds(0.5, 0.1, 0.1)


def test_model_inputs_leave_out_leaky_columns():
    assert features.model_inputs(["user_id_clean", "book_id", "rating", "num_pages", "is_read", "user_book_recency"]) == ["num_pages"]


# ---- bias and mitigation ----------------------------------------------------------------------------------

def metrics(spark, rows):
    return spark.createDataFrame([(f"{d}={v}", d, v, m, m) for d, v, m in rows], "slice_name string, slice_dimension string, slice_value string, mae double, rmse double").withColumn("count", F.lit(10))


def test_single_slice_dimensions_are_skipped(spark):
    assert bias.disparities(metrics(spark, [("Book Era", "x", 1.0)])).count() == 0


def test_high_cv_is_flagged(spark):
    flags = bias.flagged(bias.disparities(metrics(spark, [("Book Era", "a", 0.3), ("Book Era", "b", 0.9)]))).collect()
    assert [(f["slice_dimension"], f["severity"]) for f in flags] == [("Book Era", "high")]


def test_high_risk_slice(spark):
    risks = bias.high_risk(metrics(spark, [("Book Era", "a", 0.5), ("Book Era", "b", 1.0)])).collect()
    assert [r["slice"] for r in risks] == ["Book Era=b"]
    assert risks[0]["mae_deviation_pct"] == pytest.approx(100 / 3)


def test_zero_mean_gives_zero_cv(spark):
    row = bias.disparities(metrics(spark, [("Book Era", "a", 0.0), ("Book Era", "b", 0.0)])).first()
    assert row["mae_cv"] == 0.0 and row["max_mae_slice"] == "a"


@pytest.mark.parametrize("high,medium,score", [(3, 0, 40), (1, 1, 70), (6, 0, 0), (0, 0, 100)])
def test_fairness_score(spark, high, medium, score):
    rows = [("high",)] * high + [("medium",)] * medium
    assert bias.fairness_score(spark.createDataFrame(rows, "severity string")).first()["fairness_score"] == score


def test_no_findings_give_one_line(spark):
    m = metrics(spark, [("Book Era", "a", 1.0), ("Book Era", "b", 1.0)])
    s = bias.disparities(m)
    lines = bias.recommendations(s, bias.flagged(s), bias.high_risk(m)).collect()
    assert [r["recommendation"] for r in lines] == ["No significant bias detected across analyzed dimensions."]


@pytest.fixture(scope="module")
def gaps(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aabbbc"), rng.gauss(0, 1), rng.randrange(6), rng.random() < 0.5) for _ in range(600)]
    return spark.createDataFrame(rows, "g string, user_avg_rating_vs_book double, rating bigint, is_read boolean").cache()


@pytest.mark.parametrize("strength", [0.0, 0.5, 1.0])
def test_shrinkage_keeps_the_mean_and_scales_the_variance(spark, gaps, strength):
    out = mitigation.shrink(gaps, "Some Group", F.col("g"), strength)
    before = mitigation.group_metrics(gaps, F.col("g"))
    after = mitigation.group_metrics(out, F.col("g"), "rating_debiased")
    means = out.agg(F.avg("user_avg_rating_vs_book"), F.avg("rating_debiased")).first()
    assert means[0] == pytest.approx(means[1])
    var = mitigation.variance_reduction(before, after).first()
    assert var["variance_after"] == pytest.approx((1 - strength) ** 2 * var["variance_before"], abs=1e-12)


def test_reweighting_sums(spark, gaps):
    inverse = mitigation.reweight(gaps, "G", F.col("g")).agg(F.sum("sample_weight")).first()[0]
    balanced = mitigation.reweight(gaps, "G", F.col("g"), "balanced").agg(F.sum("sample_weight")).first()[0]
    assert inverse == pytest.approx(600 * 3) and balanced == pytest.approx(600)


def test_offsets_leave_ungrouped_rows(spark):
    df = spark.createDataFrame([("a", 4.0, 3.0), ("a", 5.0, 3.0), (None, 5.0, 1.0)], "g string, actual_rating double, predicted_rating double")
    out = {(r["g_group"], r["predicted_rating"]) for r in mitigation.apply_offsets(df, "G", F.col("g")).collect()}
    assert out == {("a", 4.5), (None, 1.0)}


def test_slice_metrics_match_direct_aggregates(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["x", "y", None]), rng.choice("pq"), rng.random() * 5, rng.random() * 5) for _ in range(500)] + [("x", "p", None, 1.0), ("solo", "p", 2.0, 1.0)]
    df = spark.createDataFrame(rows, "a string, b string, actual_rating double, predicted_rating double")
    got = {(r["slice_dimension"], r["slice_value"]): r for r in bias.slice_metrics(df, [("A", F.col("a")), ("B", F.col("b"))]).collect()}
    for dim, i in (("A", 0), ("B", 1)):
        for value in {r[i] for r in rows if r[i]}:
            e = np.array([r[2] - r[3] for r in rows if r[i] == value and r[2] is not None])
            r = got[(dim, value)]
            assert r["count"] == len(e) and r["mae"] == pytest.approx(np.abs(e).mean()) and r["rmse"] == pytest.approx(math.sqrt((e * e).mean()))
            assert r["std_error"] == pytest.approx(e.std(ddof=1) if len(e) > 1 else 0.0)
    assert len(got) == 5


# ---- selection ---------------------------------------------------------------------------------------------

def candidates(spark, rows):
    return spark.createDataFrame(rows, "model_name string, mae double, rmse double, fairness_score int, disparities_count bigint, high_severity_count bigint")


def test_two_models_score_by_percent_worse(spark):
    got = {r["model_name"]: r["performance_score"] for r in selection.performance_scores(candidates(spark, [("a", 1.0, 2.0, 70, 1, 1), ("b", 1.5, 2.0, 90, 0, 0)])).collect()}
    assert got == {"a": 100.0, "b": 75.0}


def test_equal_models_score_full_marks(spark):
    rows = [(n, 1.0, 1.0, 70, 0, 0) for n in "abc"]
    assert {r["performance_score"] for r in selection.performance_scores(candidates(spark, rows)).collect()} == {100.0}


def test_fairness_floor(spark):
    scored = selection.combined_scores(selection.performance_scores(candidates(spark, [("fast", 1.0, 1.0, 40, 3, 3), ("fair", 1.2, 1.2, 80, 1, 0)])))
    ranked = {r["model_name"]: r for r in selection.select_model(scored).collect()}
    assert ranked["fair"]["recommendation"] == "SELECTED"
    assert ranked["fast"]["recommendation"].endswith("Below fairness threshold")
    t = selection.trade_offs(selection.select_model(scored)).first()
    assert t["performance_sacrifice"] == pytest.approx(20.0) and t["fairness_gain"] == 40.0 and t["rationale"] == "fair: leads=fairness; fairness=high; open=medium; mae +20.0%, fairness +40.0"


def test_without_a_fair_model_the_fairest_wins(spark):
    scored = selection.combined_scores(selection.performance_scores(candidates(spark, [("a", 1.0, 1.0, 20, 3, 3), ("b", 2.0, 2.0, 30, 3, 3)])))
    assert selection.select_model(scored).where("selection_rank = 1").first()["model_name"] == "b"


def test_weights_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        selection.combined_scores(candidates(spark, []).withColumn("performance_score", F.lit(1.0)), 0.9, 0.4)


@pytest.mark.parametrize("new,current,promote", [((0.5, 0.5, 0.4), (0.6, 0.6, 0.4), True), ((0.7, 0.7, 0.4), (0.5, 0.5, 0.4), False), ((0.7, 0.5, 0.4), (0.6, 0.6, 0.4), False),
                                                 ((0.5, 0.5, 0.2), (0.6, 0.6, 0.4), False)])
def test_promotion(spark, new, current, promote):
    frame = lambda m: spark.createDataFrame([m], "mae double, rmse double, r_squared double")
    assert selection.promotion(frame(new), frame(current), []).first()["promote"] is promote


# ---- monitoring --------------------------------------------------------------------------------------------

def drift_reference(base, cur, bins=10):
    values = np.unique(np.concatenate([base, cur]))
    ks = max(abs((base <= v).mean() - (cur <= v).mean()) for v in values)
    edges = np.histogram(base, bins=bins)[1]
    b, c = np.histogram(base, edges)[0] / len(base), np.histogram(cur, edges)[0] / len(cur)
    b, c = np.where(b == 0, 1e-4, b), np.where(c == 0, 1e-4, c)
    return ks, float(np.sum((c - b) * np.log(c / b))), abs(cur.mean() - base.mean()) / max(base.std(), 0.001)


def test_drift_matches_numpy(spark):
    rng = np.random.default_rng(4)
    base = {"x": rng.normal(0, 1, 900).round(2), "flat": np.full(900, 3.0), "same": rng.integers(0, 5, 900).astype(float)}
    cur = {"x": rng.normal(0.6, 1.4, 700).round(2), "flat": rng.choice([3.0, 3.2, 9.0], 700), "same": base["same"][:700]}
    frame = lambda d: spark.createDataFrame([tuple(float(v) for v in r) for r in zip(*d.values())], "x double, flat double, same double")
    got = {r["feature_name"]: r for r in monitoring.data_drift(frame(base), frame(cur), list(base)).collect()}
    for name in base:
        ks, psi, shift = drift_reference(base[name], cur[name])
        assert got[name]["ks_statistic"] == pytest.approx(ks) and got[name]["psi_score"] == pytest.approx(psi) and got[name]["mean_shift_std"] == pytest.approx(shift)
    assert got["x"]["drift_detected"] and got["x"]["ks_pvalue"] < 0.001


def test_no_drift_against_itself(spark):
    df = spark.range(300).select((F.col("id") % 17).cast("double").alias("v"))
    r = monitoring.data_drift(df, df, ["v"]).first()
    assert (r["ks_statistic"], r["ks_pvalue"], r["psi_score"], r["mean_shift_std"], r["drift_detected"]) == (0.0, 1.0, 0.0, 0.0, False)


def test_unknown_drift_features_are_refused(spark):
    with pytest.raises(ValueError, match="nope"):
        monitoring.value_counts(spark.range(1), spark.range(1), ["nope"])


NOW = dt.datetime(2024, 2, 1, tzinfo=UTC)


def history(spark, rows):
    return spark.createDataFrame([(NOW - dt.timedelta(days=d), "m", n, v) for d, n, v in rows], "timestamp timestamp, model_name string, metric_name string, metric_value double")


@pytest.mark.parametrize("rows,detected,reason", [
    ([(20, "rmse", 1.0), (1, "rmse", 1.2)], True, "compared"), ([(20, "rmse", 1.0), (1, "rmse", 1.05)], False, "compared"),
    ([(20, "r_squared", 0.5), (1, "r_squared", 0.4)], True, "compared"), ([(1, "rmse", 9.0)], False, "insufficient_data"), ([(20, "rmse", 1.0)], False, "insufficient_data")])
def test_decay(spark, rows, detected, reason):
    r = monitoring.model_decay(monitoring.window_stats(history(spark, rows), NOW)).first()
    assert (r["decay_detected"], r["reason"]) == (detected, reason)


def test_daily_average_does_not_depend_on_the_order(spark):
    """Shares whose mean is 0.46875, a tie at four digits: added up as doubles some orders give 0.46874999999999994."""
    shares, rows, rng = [1 / 3] * 9 + [2 / 3] * 9 + [0.375] * 6, [], random.Random(5)
    for day in range(1, 26):
        rows += [(day, "r_squared", v) for v in rng.sample(shares, len(shares))]
    rows += [(day, "mae", v) for day in (1, 2) for v in (1e16, 1.0, -1e16)] + [(1, "rmse", math.inf), (2, "rmse", None), (3, "rmse", math.nan), (4, "rmse", -1e-30)]
    got = monitoring.metric_history(history(spark, rows).coalesce(1), NOW).collect()
    assert {r["avg_value"] for r in got if r["metric_name"] == "r_squared"} == {0.46875}
    assert {r["avg_value"] for r in got if r["metric_name"] == "mae"} == {1 / 3}
    assert [str(r["avg_value"]) for r in got if r["metric_name"] == "rmse"] == ["inf", "None", "nan", "-1e-30"]


@pytest.mark.parametrize("views,clicks,status", [(100, 1, "decay"), (10, 5, "healthy"), (10, 0, "no_data"), (0, 3, "no_data")])
def test_click_through_status(spark, views, clicks, status):
    rows = [("u", "view", NOW)] * views + [("u", "click", NOW)] * clicks + [("old", "click", NOW - dt.timedelta(days=3))]
    events = spark.createDataFrame(rows, "user_id string, event_type string, event_timestamp timestamp")
    assert monitoring.click_through(events, NOW).first()["status"] == status


def test_alerts_only_for_findings(spark):
    decay = monitoring.model_decay(monitoring.window_stats(history(spark, [(20, "rmse", 1.0), (1, "rmse", 2.0)]), NOW))
    drift = spark.createDataFrame([("f", 0.5, 0.0, 0.0, False)], "feature_name string, ks_pvalue double, psi_score double, mean_shift_std double, drift_detected boolean")
    assert [(r["alert_type"], r["subject"]) for r in monitoring.alerts(decay, drift).collect()] == [("MODEL_DECAY", "m")]


# ---- requests and recommendations --------------------------------------------------------------------------

def test_endpoint_percentiles_interpolate(spark):
    rows = [(NOW, "GET", "/a/1", 200, float(i), None) for i in range(1, 11)] + [(NOW, "GET", "/a/2", 500, 2000.0, "x")]
    df = spark.createDataFrame(rows, "ts timestamp, method string, path string, status_code int, latency_ms double, error_message string")
    r = requests.endpoint_stats(df).first()
    lat = [*range(1, 11), 2000]
    assert r["endpoint"] == "GET /a/{id}" and r["status_codes"] == "200:10,500:1" and r["slow_requests"] == 1
    assert r["p95_latency_ms"] == pytest.approx(np.percentile(lat, 95)) and r["p50_latency_ms"] == 6.0


def test_requests_name_few_users(spark):
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    items = spark.createDataFrame([(1,), (2,)], "book_id int")
    read = spark.createDataFrame([("a", 1)], "user_id string, book_id int")
    assert {tuple(r) for r in recommend.requested_pairs(users, items, read).collect()} == {("a", 2), ("b", 1), ("b", 2)}
    assert recommend.requested_pairs(users, items, read, block=1).count() == 3  # in blocks


def test_unread_rows_keep_every_column_and_shuffle_no_pair(spark):
    users = spark.createDataFrame([(f"u{i}", i * 1.5) for i in range(9)] + [(None, 0.0)], "user_id string, mean double")
    books = spark.createDataFrame([(i, f"t{i}") for i in range(40)] + [(7, "again"), (None, "no id")], "book_id bigint, title string")
    read = spark.createDataFrame([("u1", 7), ("u1", 8), ("u2", 3), ("u2", 3), ("u3", 999), ("gone", 4), (None, 5), ("u4", None)] + [("u5", i) for i in range(40)], "user_id string, book_id bigint")
    seen = {tuple(r) for r in read.collect() if None not in tuple(r)}
    want = sorted((str(u[0]), u[1], str(b[0]), b[1]) for u in users.collect() for b in books.collect() if (u[0], b[0]) not in seen)
    for block, shelf in ((8192, 2048), (2, 5)):
        rows = recommend.unread_rows(users, books, read, block, shelf)
        assert sorted((str(r["user_id"]), r["mean"], str(r["book_id"]), r["title"]) for r in rows.collect()) == want
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[:plan.index("CartesianProduct")] and "BroadcastNestedLoopJoin" not in plan  # above the pairs nothing is shuffled
    assert recommend.unread_rows(users.limit(0), books, read).count() == 0 and recommend.unread_rows(users, books.limit(0), read).count() == 0


def test_author_gender_rules(spark):
    authors = spark.createDataFrame([(1, "Ann Lee"), (2, "J. Doe"), (3, "   "), (4, None), (5, "BOB"), (6, "Zed Q")], "author_id int, name string")
    genders = spark.createDataFrame([("ann", "mostly_female"), ("bob", "male"), ("j.", "male")], "first_name string, gender string")
    got = {r["author_id"]: r["author_gender_group"] for r in recommend.author_gender_map(authors, genders).collect()}
    assert got == {1: "Female", 2: "Unknown", 3: "Unknown", 5: "Male", 6: "Unknown"}


def test_top_list_row(spark):
    books = spark.createDataFrame([(10, 4.9, "T", 5), (11, 4.9, "U", 9), (12, None, "V", 99)], "book_id int, average_rating double, title_clean string, ratings_count int")
    author = spark.createDataFrame([(10, "A")], "book_id int, author string")
    got = [(r["book_id"], r["author"]) for r in recommend.cold_start_list(recommend.global_top(books, author, 2)).collect()]
    assert sorted(got) == [(10, "A"), (11, "Unknown")]


def test_search(spark):
    books = spark.createDataFrame([(i, f"Title {i}", "Ann" if i % 2 else "Bob") for i in range(50)], "book_id int, title string, author string")
    assert recommend.search(books, "").count() == 10
    assert [r["book_id"] for r in recommend.search(books, "aNN").orderBy("book_id").collect()] == list(range(1, 41, 2))


def test_unknown_mitigation_is_refused(spark):
    with pytest.raises(ValueError, match="magic"):
        audit.mitigate(spark.range(1), None, spark.range(0), ["magic"])


def test_featured_lists_carry_only_their_columns(spark, derived_once):
    """What the lists do not show is not carried through the joins and the choice of editions."""
    from __spark_entry__ import queries
    from tests.conftest import SF

    plan = queries()["m9_featured_recommendations"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "description_length" not in plan and "book_era" in plan
