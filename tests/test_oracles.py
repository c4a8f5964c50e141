"""Every registered query with an oracle gives the oracle's rows on the smallest data folder."""

import pytest

from tests.conftest import SF

from __spark_entry__ import oracle_sql, queries
from tools.compare import connect, difference

QUERIES, ORACLES = queries(), oracle_sql()

# Run by default; the others carry the "slow" mark (python -m pytest -m slow).
QUICK = {
    "a4_rating_quantile", "a10_extended_metrics", "a12_metric_history", "b1_slice_metrics", "b6_recommendations", "b13_prediction_shrinkage", "b21_select_model",
    "b24_equity_index", "b27_full_audit", "c1_clean_books", "c9_latest_interaction", "c10_known_books", "d2_rule_suite", "d11_column_profile", "d12_histograms",
    "f13_feature_table", "f14_log_transform", "f16_user_split", "f18_scoring_features", "i4_overwrite_from_self", "i8_history_tables", "i9_upsert_reads", "j7_not_in",
    "k1_global_top10", "m5_report_by_split", "m8_mean_recommendations", "m10_served_lists", "m13_books_unread", "n3_data_drift", "n8_alerts", "n11_promotion_decisions",
    "s5_parse_activity_time", "t1_migrate_events", "t3_event_stream_etl", "t5_endpoint_stats", "t10_frontend_metrics", "t11_parse_logs", "w4_one_edition",
    "x2_sliding_click_through", "x3_minute_timeline_stream", "x5_unique_events",
}


def _cases(names):
    return [n if n in QUICK else pytest.param(n, marks=pytest.mark.slow) for n in sorted(names)]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", _cases(ORACLES))
def test_same_rows(spark, duck, derived_once, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert difference(got, duck.execute(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", _cases(set(QUERIES) - set(ORACLES)))
def test_runs(spark, derived_once, name):
    out = QUERIES[name](spark, SF)
    assert len(set(out.columns)) == len(out.columns)
    assert out.count() >= 0


def test_names():
    assert set(ORACLES) <= set(QUERIES) and QUICK <= set(ORACLES)
