"""Shards by extendible hashing.

A directory is indexed by the leading bits of a row's hash. It starts as one bucket; only buckets over the byte limit are
split on their next bit, until each fits. A shard is named by its bits, so rows and shards are the same on every run.

The hash is the MD5 of the key columns, all columns unless some are named. Rows that no bit can part are handled apart: a row
larger than the limit is a shard of its own, and equal rows that together exceed it are dealt out in runs that fit (``<bits>.<run>``).
Null texts and empty texts have no bytes and still get a shard; very long texts count with all their bytes. An empty table gives no rows. The columns this adds replace input
columns of the same name. Equal rows are interchangeable, which needs columns that can be grouped (no maps).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import hash60, keeps_columns, row_digest, small, written

BITS = 60
LIMIT_BYTES = 1 << 20
EXTRA_BITS = 4  # levels below the even depth that one round looks at
ADDED = ("hash", "bytes", "shard", "depth", "shard_bytes")


def _lead(h: Column, bits: int | Column) -> Column:
    """The first ``bits`` bits of a 60-bit hash."""
    return F.shiftright(h, BITS - bits) if isinstance(bits, int) else F.call_function("shiftright", h, F.lit(BITS) - bits)


def _name(prefix: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, "0"))


def _round(cells: DataFrame, base: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame, int, int]:
    """Buckets found between two depths, and the prefixes at ``depth`` that are still too large."""
    hist = cells.groupBy(_lead(F.col("hash"), depth).alias("_p")).agg(F.sum("bytes").alias("_b"))
    sums = (hist.select(F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth"), "_p", "_b")
            .groupBy("depth", F.call_function("shiftright", F.col("_p"), F.lit(depth) - F.col("depth")).alias("prefix"))
            .agg(F.sum("_b").alias("shard_bytes")))
    sums, _ = written(sums, "sums")
    large = sums.where(F.col("shard_bytes") > limit)
    fits = sums.where(F.col("shard_bytes") <= limit)
    parents = large.select((F.col("depth") + 1).alias("_d"), F.col("prefix").alias("_up"))
    buckets = fits.join(parents, (F.col("depth") == F.col("_d")) & (F.shiftright("prefix", 1) == F.col("_up")), "left_semi")
    if base == 0:
        buckets = buckets.unionByName(fits.where(F.col("depth") == 0))
    slots = buckets.select(
        F.explode(F.sequence(F.call_function("shiftleft", F.col("prefix"), F.lit(depth) - F.col("depth")),
                             F.call_function("shiftleft", F.col("prefix") + 1, F.lit(depth) - F.col("depth")) - 1)).alias("slot"),
        _name(F.col("prefix"), F.col("depth")).alias("shard"), "depth", "shard_bytes")
    slots, n = written(slots, "slots")
    deeper = large.where(F.col("depth") == depth).select("prefix")
    return slots, deeper, n, deeper.count()


def directory(cells: DataFrame, limit: int) -> list[tuple[int, DataFrame, int]]:
    """The directory by rounds: (bits of the slots, slots with their shard, number of slots)."""
    total = cells.agg(F.sum("bytes")).first()[0] or 0
    base, out = 0, []
    depth = min(BITS, max(0, math.ceil(math.log2(max(total, 1) / limit))) + EXTRA_BITS)
    while True:
        slots, deeper, n, left = _round(cells, base, depth, limit)
        out.append((depth, slots, n))
        if not left or depth == BITS:
            return out
        deeper = small(deeper, left)
        cells = cells.join(deeper, _lead(F.col("hash"), depth) == F.col("prefix"), "left_semi")
        base, depth = depth, min(BITS, depth + EXTRA_BITS)


@keeps_columns
def shard(rows: DataFrame, size: Column | None = None, limit: int = LIMIT_BYTES, keys: list[str] | None = None) -> DataFrame:
    """The rows with ``hash``, ``bytes``, ``shard``, ``depth`` and ``shard_bytes``. ``size`` defaults to the bytes of ``text``."""
    rows = rows.drop(*ADDED)
    columns = rows.columns
    size = F.octet_length(F.col("text")) if size is None else size
    rows = rows.withColumns({"hash": hash60(row_digest(rows, keys or columns)), "bytes": F.coalesce(size, F.lit(0)).cast("bigint")})
    cells = rows.groupBy("hash").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("_n"))
    cells, _ = written(cells, "cells")
    whole, n_whole = written(cells.where(F.col("bytes") > limit).withColumn("_run", F.greatest(F.lit(1), F.floor(limit / (F.col("bytes") / F.col("_n")))).cast("bigint")), "whole")
    out = rows
    if n_whole:
        out = rows.join(small(whole.select("hash"), n_whole), "hash", "left_anti")
    cells = cells.where(F.col("bytes") <= limit)
    shard_of, depth_of, bytes_of, drops = [], [], [], []
    for i, (bits, slots, n) in enumerate(directory(cells, limit)):
        named = slots.toDF(f"_slot{i}", f"_shard{i}", f"_depth{i}", f"_bytes{i}")
        out = out.join(small(named, n), _lead(F.col("hash"), bits) == F.col(f"_slot{i}"), "left")
        shard_of.append(F.col(f"_shard{i}"))
        depth_of.append(F.col(f"_depth{i}"))
        bytes_of.append(F.col(f"_bytes{i}"))
        drops += named.columns
    out = out.withColumns({"shard": F.coalesce(*shard_of), "depth": F.coalesce(*depth_of), "shard_bytes": F.coalesce(*bytes_of)}).drop(*drops)
    if n_whole:
        out = out.unionByName(_runs(rows, whole, n_whole, columns))
    return out


def _runs(rows: DataFrame, whole: DataFrame, n_whole: int, columns: list[str]) -> DataFrame:
    """Rows of hashes that exceed the limit by themselves: equal rows are counted, then dealt out a shard at a time."""
    chosen = rows.join(small(whole.select("hash", "_run"), n_whole), "hash")
    counted = chosen.groupBy("hash", "bytes", "_run", *[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    runs = counted.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / F.col("_run")))))
    runs = runs.withColumn("_in", F.least("_run", F.col("_n") - F.col("_k") * F.col("_run")))
    spread = runs.repartition("hash", "_k").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_in"))))
    several = F.col("_n") > F.col("_run")
    return spread.select(
        *[F.col(f"`{c}`") for c in columns], "hash", "bytes",
        F.concat(_name(F.col("hash"), F.lit(BITS)), F.when(several, F.concat(F.lit("."), F.col("_k").cast("string"))).otherwise(F.lit(""))).alias("shard"),
        F.lit(BITS).alias("depth"), (F.col("_in") * F.col("bytes")).alias("shard_bytes"))
