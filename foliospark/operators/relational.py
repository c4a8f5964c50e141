"""Relational steps that Spark plans badly when written literally."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left.key NOT IN (SELECT key FROM right)`` with its NULL rules.

    Written literally, Spark must send the whole right side to every task. The same rows follow from a plain anti join
    and a one-row check: a NULL on the right leaves nothing, an empty right side leaves everything.
    """
    facts = right.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(key).isNull()).alias("_nulls"))
    rest = left.join(right.select(key), key, "left_anti").crossJoin(F.broadcast(facts))
    keep = (F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(key).isNotNull())
    return rest.where(keep).select(*left.columns)
