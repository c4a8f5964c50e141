"""Pieces the operators of this subpackage share."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.session import RUNTIME_CONF
from foliospark.sources.tables import stage

T = TypeVar("T")
BROADCAST_ROWS = 200_000
BATCH_BYTES = 8 << 20

_HELD: dict[object, object] = {}


def held(name: object, make: Callable[[], T]) -> T:
    """What a Python worker keeps from one task to the next. It keeps the latest only, so workers that serve many jobs do not grow."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def small(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the counted ``rows`` are few; otherwise leave the join to the optimizer."""
    return F.broadcast(df) if rows <= most else df


def written(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The staged table and its number of rows."""
    table = stage(df, label)
    return table, table.count()


def hash60(digest: Column) -> Column:
    """The first 60 bits of a hex digest as a non-negative bigint."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def row_digest(df: DataFrame, keys: list[str]) -> Column:
    """MD5 of the listed columns; nulls differ from every text."""
    return F.md5(F.concat_ws("\x01", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\x02")) for k in keys]))


def ready(spark: SparkSession) -> None:
    """The settings these operators count on, and the package on the workers."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, RUNTIME_CONF[key])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")  # texts are long
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship(spark)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; Spark's file server carries it to the executors."""
    context = spark.sparkContext
    name = "foliospark-workers.zip"
    if any(f.endswith(name) for f in context.listFiles):
        return
    top = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="run-")) / name
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(top.rglob("*.py")):
            out.write(f, f.relative_to(top.parent))
    context.addPyFile(str(path))


def keeps_columns(operator):
    """For operators that hand on the input's further columns: names that start with ``_`` are theirs while they work."""

    @functools.wraps(operator)
    def run(rows: DataFrame, *args, **kwargs) -> DataFrame:
        aside = {c: f"input{i}{c}" for i, c in enumerate(rows.columns) if c.startswith("_")}
        out = operator(rows.withColumnsRenamed(aside), *args, **kwargs)
        return out.withColumnsRenamed({v: k for k, v in aside.items()})

    return run
