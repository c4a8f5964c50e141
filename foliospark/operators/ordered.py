"""Order-dependent results without a single-task sort.

Ranks, running totals and exact percentiles of a whole table need a global order. An unpartitioned
window would pull every row into one task, and a window over a hot group would do the same for that group.
Here each group is cut at value split points into many ordered parts: totals of the parts give each part its
offset, and only the rows inside one part are ever sorted together.

The split points come from the data by hashing alone (one representative value per hash class), so they
are the same in every branch of the plan and in every re-run of a lost task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.sources.tables import stage

PART_ROWS = 65_536  # rows a part should hold
LEAST_SPLITS = 16


def _split_points(rows: DataFrame, keys: Sequence[str], value: str, splits: int) -> DataFrame:
    """Per key: the sorted split points, in chunks so that a lookup reads two short arrays."""
    hash_class = F.pmod(F.xxhash64(F.col(value)), F.lit(splits))
    picked = rows.groupBy(*keys, hash_class.alias("_class")).agg(
        F.max_by(F.col(value), F.xxhash64(F.col(value), F.lit(7))).alias("_point")
    )
    points = picked.groupBy(*keys).agg(F.sort_array(F.collect_set("_point")).alias("_points"))
    chunk = _chunk(splits)
    n_chunks = F.ceil(F.size("_points") / chunk).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), n_chunks - 1), lambda i: F.slice("_points", i * chunk + 1, chunk))
    with_chunks = points.where(F.size("_points") > 0).select(*keys, chunks.alias("_chunks"))
    return with_chunks.select(*keys, "_chunks", F.transform("_chunks", lambda c: F.get(c, F.lit(0))).alias("_heads"))


def _chunk(splits: int) -> int:
    """As many points to a chunk as there are chunks, so a lookup reads twice the root of their number."""
    return max(1, math.isqrt(splits))


def _part_of(value: Column, splits: int) -> Column:
    """Number of split points at or below the value."""
    chunk = F.size(F.filter("_heads", lambda h: h <= value))
    inside = F.size(F.filter(F.get(F.col("_chunks"), chunk - 1), lambda p: p <= value))
    return F.when(chunk == 0, F.lit(0)).otherwise((chunk - 1) * _chunk(splits) + inside)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; without keys the right side must be one row."""
    if not keys:
        return left.crossJoin(F.broadcast(right))
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        match = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = match if condition is None else condition & match
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def running_totals(rows: DataFrame, keys: Sequence[str], value: str, weights: Sequence[str],
                   splits: int | None = None) -> DataFrame:
    """Add ``<weight>_before`` (sum over smaller values of the same key) and ``<weight>_total`` (sum over the key).

    ``rows`` must hold each (key, value) once, with a non-NULL orderable value. The number of split points follows that of the rows unless it is given.
    """
    keys = list(keys)
    rows = stage(rows, "ordered")  # read up to four times below
    over_key = Window.partitionBy(*keys)
    if splits is None:
        splits = max(LEAST_SPLITS, -(-rows.count() // PART_ROWS) * 2)
    placed = null_safe_join(rows, _split_points(rows, keys, value, splits), keys)
    placed = placed.withColumn("_part", _part_of(F.col(value), splits)).drop("_chunks", "_heads")

    # At most `splits + 1` rows per key, so these windows stay small however large the key is.
    parts = placed.groupBy(*keys, "_part").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    earlier = over_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *keys, "_part",
        *[F.coalesce(F.sum(f"_sum_{w}").over(earlier), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(f"_sum_{w}").over(over_key).alias(f"{w}_total") for w in weights],
    )
    joined = null_safe_join(placed, offsets, [*keys, "_part"])
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumns({
        f"{w}_before": F.col(f"_off_{w}") + F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights
    }).drop("_part", *[f"_off_{w}" for w in weights])


def positions(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "position",
              splits: int | None = None) -> DataFrame:
    """Number the rows 1, 2, ... per key in the given ascending order, which must be unique per key."""
    ordered = rows.withColumns({"_order": F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]), "_one": F.lit(1).cast("bigint")})
    out = running_totals(ordered, keys, "_order", ["_one"], splits)
    return out.withColumn(name, F.col("_one_before") + 1).drop("_order", "_one", "_one_before", "_one_total")


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: Column, probs: dict[str, float],
                      method: str = "linear", splits: int | None = None) -> DataFrame:
    """Exact percentiles per key, one column per entry of ``probs``.

    ``linear`` interpolates between the two neighbouring ranks; ``discrete`` takes the smallest value whose
    cumulative share reaches the probability. Equal values are counted before anything is ordered.
    """
    keys = list(keys)
    counts = df.select(*keys, value.alias("_v")).where(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counts, keys, "_v", ["_n"], splits)
    n, start, stop = F.col("_n_total"), F.col("_n_before"), F.col("_n_before") + F.col("_n")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= start) & (rank < stop), F.col("_v")))

    aggregates, columns = [], []
    for name, p in probs.items():
        if method == "discrete":
            aggregates.append(at(F.greatest(F.ceil(F.lit(p) * n), F.lit(1)) - 1).alias(name))
            columns.append(F.col(name))
        else:
            place = (n - 1) * F.lit(p)
            low = F.floor(place)
            aggregates += [at(low).alias(f"_lo_{name}"), at(F.least(low + 1, n - 1)).alias(f"_hi_{name}"),
                           F.max(place - low).alias(f"_w_{name}")]
            columns.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_w_{name}")).alias(name))
    return ranked.groupBy(*keys).agg(*aggregates).select(*keys, *columns)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest ``order`` per key; ties fall to the greatest remaining columns, NULL lowest.

    An aggregate, not a window: each task keeps one row per key before the shuffle, so hot keys cost nothing.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *rest)
    best = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows per key. Spark trims each task to ``k`` rows per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def first_unseen(users: DataFrame, seen: DataFrame, ordered: DataFrame, user: str, item: str, k: int) -> DataFrame:
    """For every user, the first ``k`` items of one shared order that the user has not seen. Exact.

    ``ordered`` has ``item`` and ``position`` 1..N. The m-th unseen item of a user sits at position
    ``m + (number of seen items ahead of it)``, and a seen item with j-th smallest position p is ahead of the m-th
    unseen one when ``p - j < m``. So a user's seen items reduce to at most ``k`` counters and only ``k``
    rows per user are emitted: users and items are never paired off.
    """
    positions_seen = seen.select(user, item).where(F.col(user).isNotNull()).distinct().join(
        ordered.select(item, "position"), item)
    nth = F.row_number().over(Window.partitionBy(user).orderBy("position"))
    counters = (
        positions_seen.select(user, (F.col("position") - nth).alias("gap")).where(F.col("gap") < k)
        .groupBy(user, "gap").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(user).agg(F.collect_list(F.struct("gap", "n")).alias("_ahead"))
    )
    m = F.col("unseen_rank").cast("bigint")
    ahead = F.aggregate(F.filter("_ahead", lambda a: a["gap"] < m), F.lit(0).cast("bigint"), lambda s, a: s + a["n"])
    slots = (
        users.select(user).where(F.col(user).isNotNull()).distinct().join(counters, user, "left")
        .withColumn("unseen_rank", F.explode(F.sequence(F.lit(1), F.lit(k))))
        .select(user, "unseen_rank", (m + F.coalesce(ahead, F.lit(0))).alias("position"))
    )
    return slots.join(ordered, "position")
