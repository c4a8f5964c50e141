"""Nearest vectors against the scan of all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import nearest, routing
from foliospark.llm.queries import QUERIES
from tests.conftest import SF

SCHEMA = "vec_id bigint, embedding array<double>, label int, id bigint, leaf string, vector int"


def asks():
    return F.col("vec_id") % 20 == 0


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "x", 7) for i, v in rows], SCHEMA)


def brute(rows, k=20):
    rows = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    out = []
    for a, (i, v) in enumerate(rows):
        if i % 20 == 0:
            near = sorted((-float(np.einsum("i,i->", v, w)), j) for b, (j, w) in enumerate(rows) if b != a)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def recall(found, true):
    want, have = {(q, v) for q, _, v, _ in true}, {(q, v) for q, _, v, _ in found}
    return len(want & have) / len(want)


def test_small_tables_are_exact(ready_spark):
    out = QUERIES["op13_nearest_vectors"](ready_spark, SF)
    assert dict(out.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    rows = [(r["vec_id"], r["embedding"]) for r in ready_spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert [x[:3] for x in got(out)] == [x[:3] for x in brute(rows)]
    assert np.allclose([x[3] for x in got(out)], [x[3] for x in brute(rows)], rtol=1e-12)


def clustered(n, seed, norms=False):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, 16))
    x = centres[rng.integers(0, 12, n)] + 0.6 * rng.standard_normal((n, 16))
    x[: n // 3] = centres[0] + 0.05 * rng.standard_normal((n // 3, 16))  # a third of all in one tight group
    if norms:
        return x * rng.uniform(0.2, 3, (n, 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("norms, leaf, fan_out", [(False, 200, 64), (True, 200, 64), (False, 60, 8)])
def test_recall_of_learned_partitions(ready_spark, monkeypatch, norms, leaf, fan_out):
    monkeypatch.setattr(nearest, "LEAF", leaf)
    monkeypatch.setattr(nearest, "FAN_OUT", fan_out)
    monkeypatch.setattr(nearest, "BLOCK", 150)
    monkeypatch.setattr(nearest, "QUERIES", 20)
    x = clustered(3000, 4, norms)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = frame(ready_spark, rows).repartition(5)
    found, true = got(nearest.nearest(table, asks())), brute(rows)
    assert recall(found, true) >= 0.9
    per = {}
    for q, r, v, s in found:
        per.setdefault(q, []).append((r, s, v))
        assert v != q and np.isclose(s, x[q] @ x[v], rtol=1e-12)
    assert len(per) == 150
    for some in per.values():
        some.sort()
        assert [r for r, _, _ in some] == list(range(1, 21)) and [(-s, v) for _, s, v in some] == sorted((-s, v) for _, s, v in some)


def test_parts_are_balanced_and_cut_few_edges():
    x = clustered(2000, 6)
    graph = routing.neighbour_graph(x, routing.GRAPH)
    label = routing.balanced_parts(graph, x, 7)
    sizes = np.bincount(label)
    assert len(sizes) == 7 and sizes.max() - sizes.min() <= 7
    rng = np.random.default_rng(1)
    cut, chance = (label[:, None] != label[graph]).mean(), (rng.permutation(label)[:, None] != label[graph]).mean()
    assert cut < 0.6 * chance


def test_copies_ties_and_rows_that_take_no_part(ready_spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(60)] + [(100 + i, [float(i % 3), 1.0, 0.0]) for i in range(30)]
    rows += [(200, [0.0, 0.0, 0.0]), (220, None), (240, [1.0, None, 0.0]), (260, [float("nan"), 1.0, 1.0]), (280, [float("inf"), 0.0, 0.0]), (None, [9.0, 9.0, 9.0]), (-20, [-1.0, 2.0, 0.5]), (40, [1.0, 0.0, 0.0]), (300, [2.0, 0.0, 0.0])]
    assert got(nearest.nearest(frame(ready_spark, rows + [(320, [1.0, 1.0]), (340, [])]), asks())) == brute(rows)


def test_few_candidates_and_empty_tables(ready_spark):
    rows = [(0, [1.0, 2.0]), (3, [2.0, 1.0]), (20, [0.5, 0.5])]
    assert got(nearest.nearest(frame(ready_spark, rows), asks())) == brute(rows)
    assert got(nearest.nearest(frame(ready_spark, rows[:1]), asks())) == []
    assert nearest.nearest(frame(ready_spark, rows).limit(0), asks()).count() == 0
