"""Approximate nearest neighbours by learned partitions.

On a sample of at most ``SAMPLE`` vectors a neighbour graph is cut into balanced parts with few edges between them; a small network learns in which part a vector lies, another
which parts hold a query's neighbours (``routing``). Every vector is filed under its part; parts over twice ``LEAF`` vectors are cut once more by a sample of their own.
A query is compared with all vectors of its most probable leaves, as many as make up a probability that is calibrated on the data: for ``CALIBRATE`` queries the true neighbours
are found by a scan of all vectors, and the bound is set so that the leaves within it hold ``RECALL`` of them. So recall is measured, at every size, and not assumed.

Equal vectors are one item with its k + 1 smallest ids, which is all that a list of k can show of them, so a large group of copies costs a row. A leaf's items are dealt in blocks of about
``BLOCK`` and its queries in shares of about ``QUERIES``; a block is held in memory while its queries stream past.

Nearness is the largest inner product of the vectors as given, in double precision; ties go to the smaller id. Rows whose id is null, or whose vector is null, zero, holds a null or non-finite component, or
has not the commonest length (of equally common ones the smallest), take no part. A repeated row is a candidate each time, and a query is no candidate of itself only. Fewer candidates than k give all of them;
an empty table gives none. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from foliospark.llm.common import small, written
from foliospark.llm.routing import Partitioner, Tree

K = 20
SAMPLE, SAMPLE_BYTES = 8192, 64 << 20
LEAF, FAN_OUT = 8192, 64
TREE_BYTES = 64 << 20
CALIBRATE, RECALL = 256, 0.95
BLOCK, QUERIES = 8192, 8192
AT_ONCE = 256


def vectors(table: DataFrame, is_query: Column, column: str = "embedding") -> DataFrame:
    """(id, vector, asks) of the rows that take part."""
    rows = table.select(F.col("vec_id").cast("bigint").alias("id"), F.col(f"`{column}`").cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("vector") == (common[0]["d"] if common else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sampled(items: DataFrame, sizes: dict[int, int], dims: int) -> DataFrame:
    """At most ``SAMPLE`` items of each part in ``sizes``, by hash. A cut of the hash leaves little more than that, so few rows meet."""
    most = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * dims)))
    cut = F.lit(None).cast("bigint")
    for part, n in sizes.items():
        share = min(1.0, (1.2 * most + 100) / n)
        cut = F.when(F.col("part") == part, F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))).otherwise(cut)
    first = Window.partitionBy("part").orderBy("hash", "item")
    return items.where(F.col("hash") <= cut).withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= most).select("part", "vector")


def _fitted(items: DataFrame, sizes: dict[int, int], dims: int) -> dict[int, bytes]:
    """A partitioner for each part, fitted in one task each on its sample, for leaves of about ``LEAF``."""
    parts = {p: max(2, min(FAN_OUT, -(-n // LEAF))) for p, n in sizes.items()}

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["vector"].to_numpy())
        return pd.DataFrame({"part": [key[0]], "data": [Partitioner.fitted(x, min(parts[key[0]], len(x) // 2)).to_bytes()]})

    return {r["part"]: r["data"] for r in _sampled(items, sizes, dims).groupBy("part").applyInPandas(fit, "part int, data binary").collect()}


def _filed(items: DataFrame, tree: Tree, name: str) -> DataFrame:
    """The items with the leaf (or part) in which the tree files them."""
    shared, columns = items.sparkSession.sparkContext.broadcast(tree), [c for c in items.columns if c != name]

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                leaf = pa.array(shared.value.leaf(_matrix(batch.column("vector"))).astype(np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=[*batch.schema.names, name])

    rows = items.select(*columns)
    return rows.mapInArrow(file, StructType([*rows.schema.fields, StructField(name, IntegerType())]))


def _index(items: DataFrame, n: int, dims: int) -> tuple[DataFrame, Tree]:
    """All items with their leaf, and the tree."""
    blobs: dict[int, bytes] = {}
    if n > LEAF:
        blobs = _fitted(items.withColumn("part", F.lit(-1)), {-1: n}, dims)
    tree = Tree(blobs, FAN_OUT)
    if n > FAN_OUT * LEAF:
        filed, _ = written(_filed(items, tree, "leaf").withColumn("part", (F.col("leaf") / FAN_OUT).cast("int")), "filed")
        sizes = {r["part"]: r["count"] for r in filed.groupBy("part").count().collect()}
        large = {p: c for p, c in sizes.items() if c > 2 * LEAF}
        if (len(large) + 1) * len(blobs[-1]) <= TREE_BYTES:
            tree = Tree(blobs | _fitted(filed, large, dims), FAN_OUT)
        items = filed.drop("part", "leaf")
    filed, _ = written(_filed(items, tree, "leaf"), "items")
    return filed, tree


def _best(score: np.ndarray, q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, item, exact score) of the ``k`` best items per query, ties by ``first``."""
    if score.shape[1] > k:
        least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        query, item = np.nonzero(score >= (least - 1e-9 * np.abs(least))[:, None])
    else:
        query, item = np.nonzero(np.ones(score.shape, dtype=bool))
    exact = np.einsum("ij,ij->i", q[query], x[item])
    order = np.lexsort((first[item], -exact, query))
    query, item, exact = query[order], item[order], exact[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], item[place < k], exact[place < k]


def _bound(items: DataFrame, asking: DataFrame, tree: Tree, k: int, recall: float) -> float:
    """The probability that the visited leaves must make up to hold ``recall`` of the true neighbours of some queries."""
    if tree.root is None:
        return 2.0
    some = asking.orderBy("hash", "item").limit(CALIBRATE).select("item", "vector").collect()
    if not some:
        return 2.0
    own, q = np.array([r["item"] for r in some]), np.array([r["vector"] for r in some])
    shared = items.sparkSession.sparkContext.broadcast((own, q))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        top, leaf_of = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, dtype=np.int64)
        for batch in batches:
            if len(batch):
                score = q @ _matrix(batch.column("vector")).T
                item, leaf = batch.column("item").to_numpy(), batch.column("leaf").to_numpy()
                score[own[:, None] == item[None, :]] = -np.inf
                every, leaves = np.concatenate([top, score], axis=1), np.concatenate([leaf_of, np.broadcast_to(leaf, score.shape)], axis=1)
                at = np.argpartition(-every, k - 1, axis=1)[:, :k]
                top, leaf_of = np.take_along_axis(every, at, 1), np.take_along_axis(leaves, at, 1)
        query, place = np.nonzero(np.isfinite(top))
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(leaf_of[query, place], pa.int64()), pa.array(top[query, place], pa.float64())], names=["q", "leaf", "score"])

    found = items.select("item", "leaf", "vector").mapInArrow(scan, "q bigint, leaf bigint, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "leaf"))
    rows = found.withColumn("_r", rank).where(F.col("_r") <= k).select("q", "leaf").collect()
    if not rows:
        return 2.0
    mass, column = tree.mass_before(q), {leaf: i for i, leaf in enumerate(tree.leaves.tolist())}
    return float(np.quantile([mass[r["q"], column[r["leaf"]]] for r in rows], recall, method="higher"))


def _routed(asking: DataFrame, tree: Tree, bound: float) -> DataFrame:
    """A row per query item and leaf to visit."""
    shared = asking.sparkSession.sparkContext.broadcast(tree)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            if len(batch):
                query, leaf = np.nonzero(tree.mass_before(_matrix(batch.column("vector"))) <= bound)
                yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(query)), pa.array(tree.leaves[leaf].astype(np.int32), pa.int32())], names=["item", "leaf"])

    return asking.select("item", "vector").mapInArrow(route, "item bigint, leaf int")


def _searched(cells: DataFrame, k: int) -> DataFrame:
    """(query, item, score, ids) of the best items of each cell's queries. Of a cell first its items come, then its queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, x = None, [], None
        for batch in batches:
            keys, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(keys)]
            for low, high in zip(cuts, cuts[1:]):
                part = batch.slice(low, high - low)
                if high > low and keys[low] != cell:
                    cell, held, x = keys[low], [], None
                if high > low and kinds[low] == 0:
                    held.append(part)
                    x = None
                elif high > low and held:
                    if x is None:
                        x, items = np.concatenate([_matrix(h.column("vector")) for h in held]), pa.concat_arrays([h.column("item") for h in held])
                        ids = pa.concat_arrays([h.column("ids") for h in held])
                        first = np.concatenate([h.column("first").to_numpy() for h in held])
                    asked, q = part.column("item"), _matrix(part.column("vector"))
                    for at in range(0, len(q), AT_ONCE):
                        some = q[at:at + AT_ONCE]
                        query, item, score = _best(some @ x.T, some, x, first, k)
                        yield pa.RecordBatch.from_arrays([asked.take(pa.array(query + at)), items.take(pa.array(item)), pa.array(score), ids.take(pa.array(item))], names=["query", "item", "score", "ids"])

    return cells.mapInArrow(search, "query bigint, item bigint, score double, ids array<bigint>")


def nearest(table: DataFrame, is_query: Column, k: int = K, column: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for which ``is_query`` holds."""
    rows, n_rows = written(vectors(table, is_query, column), "vectors")
    hashed = rows.withColumn("hash", F.xxhash64("vector"))
    same = Window.partitionBy("hash", "vector").orderBy("id")
    groups = hashed.withColumn("_r", F.row_number().over(same)).where(F.col("_r") <= k + 1).groupBy("hash", "vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    # The numbers hold once the table is written.
    items, n = written(groups.withColumn("item", F.monotonically_increasing_id()), "groups")
    dims = len(rows.select("vector").first()[0]) if n_rows else 1
    asks, n_asks = written(hashed.where("asks").select("id", "hash", "vector").join(items.select("hash", "vector", "item"), ["hash", "vector"]).select(F.col("id").alias("query_id"), "item"), "asks")
    filed, tree = _index(items, n, dims)
    asked = asks.select("item").distinct()
    asking, _ = written(filed.join(small(asked, n_asks), "item", "left_semi").select("item", "hash", "vector"), "asking")
    visits, _ = written(_routed(asking, tree, _bound(filed, asking, tree, k, recall)), "visits")

    # Leaves are few (bounded by the tree).
    deal = filed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).join(
        visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("shares")), "leaf")
    deal = F.broadcast(deal)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = filed.join(deal, "leaf").withColumn("share", every("shares")).withColumn("block", F.pmod(F.col("hash"), F.col("blocks")).cast("int"))
    held = held.select("leaf", "block", "share", F.lit(0).alias("kind"), "item", "vector", "ids", F.get("ids", F.lit(0)).alias("first"))
    sent = visits.join(asking, "item").join(deal, "leaf").withColumn("block", every("blocks")).withColumn("share", F.pmod(F.xxhash64("item"), F.col("shares")).cast("int"))
    sent = sent.select("leaf", "block", "share", F.lit(1).alias("kind"), "item", "vector", F.lit(None).cast("array<bigint>").alias("ids"), F.lit(None).cast("bigint").alias("first"))
    cells = held.unionByName(sent).withColumn("cell", F.xxhash64("leaf", "block", "share"))
    cells = cells.repartition("cell").sortWithinPartitions("cell", "leaf", "block", "share", "kind").select("cell", "kind", "item", "vector", "ids", "first")

    better = Window.partitionBy("query").orderBy(F.desc("score"), F.get("ids", F.lit(0)))
    top = _searched(cells, k + 1).withColumn("_r", F.row_number().over(better)).where(F.col("_r") <= k + 1)
    ids = top.select("query", "item", (-F.col("score")).alias("minus"), F.explode("ids").alias("id"))
    lists = ids.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("minus", "id", "item"))), 1, k + 1).alias("near"))
    own = F.struct(F.col("query_id").alias("id"), F.col("query").alias("item"))
    at = F.array_position(F.transform("near", lambda n: F.struct(n["id"].alias("id"), n["item"].alias("item"))), own)
    others = F.slice(F.filter("near", lambda n, i: i + 1 != F.col("at")), 1, k)
    out = asks.select("query_id", F.col("item").alias("query")).join(lists, "query").withColumn("at", at).select("query_id", F.posexplode(others).alias("rank", "near"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("near.id").alias("vec_id"), (-F.col("near.minus")).alias("score"))
