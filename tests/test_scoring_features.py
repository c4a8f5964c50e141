"""The scoring-time features cover every user and every unread book."""

from pyspark.sql import functions as F

from __spark_entry__ import queries
from foliospark.sources import adapters
from tests.conftest import SF


def test_every_user_gets_every_unread_book(spark, derived_once):
    got = {tuple(r) for r in queries()["f18_scoring_features"](spark, SF).select("user_id_clean", "book_id").collect()}
    users = {r[0] for r in queries()["f10_user_features"](spark, SF).select("user_id_clean").collect()}
    books = {r[0] for r in queries()["f13_feature_table"](spark, SF).select("book_id").distinct().collect()}
    read = {tuple(r) for r in adapters.interactions(spark, SF).where(F.col("is_read")).select("user_id", "book_id").distinct().collect()}
    assert {u for u, _ in got} == users and got == {(u, b) for u in users for b in books} - read


def test_pairs_are_not_shuffled(spark, derived_once):
    """All pairs are formed above the last exchange and go straight to the output."""
    for name in ("f18_scoring_features", "j5_unread_pairs"):
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan[:plan.index("CartesianProduct")]
