"""Registration of catalogue queries: name -> (Spark query, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.base import derived, oracle, present
from foliospark.plans.tables import Derived
from foliospark.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query that takes (spark, data folder)."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return present(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register


def on_tables(name: str, sql: str | None = None):
    """Register a query over the derived tables."""
    def register(fn: Callable[[Derived], DataFrame]):
        query(name, sql)(lambda spark, sf_dir: fn(derived(spark, sf_dir)))
        return fn

    return register
