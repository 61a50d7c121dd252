"""Blocks compared in tiles: trees, nearest points, components, powers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import vectors as vx
from tessera.operators import density, spanning, validity


def _prim(ids, w):
    """Edges of the spanning tree of a dense matrix, ordered by (w, ids)."""
    n = len(ids)
    inside, out = {0}, []
    while len(inside) < n:
        e = min((w[i, j], min(ids[i], ids[j]), max(ids[i], ids[j]), j) for i in inside for j in range(n) if j not in inside)
        inside.add(e[3])
        out.append((int(e[1]), int(e[2]), float(e[0])))
    return sorted(out)


@pytest.mark.parametrize("metric, same, grid", [("euclidean", True, True), ("euclidean", False, True), ("euclidean", False, False), ("cosine", True, False)])
@pytest.mark.parametrize("n", [40, 90])
def test_tile_forest_is_the_tree(metric, same, grid, n):
    rng = np.random.default_rng(n)
    vec = rng.integers(0, 4, (n, 2)).astype(float) if grid else rng.normal(size=(n, 5))
    vec = spanning.unit_rows(vec) if metric == "cosine" else vec
    ids, core, m = rng.permutation(500)[:n], rng.random(n) * 0.2, n if same else n // 3
    w = np.maximum(spanning.distances(vec, vec, metric), np.maximum(core[:, None], core[None, :]))
    if not same:
        w[:m, :m], w[m:, m:] = np.inf, np.inf
    left, right = np.arange(m), np.arange(n) if same else np.arange(m, n)
    i, j, got = spanning.tile_forest(ids, vec, core, left, right, same, metric)
    edges = sorted(zip(np.minimum(ids[i], ids[j]).tolist(), np.maximum(ids[i], ids[j]).tolist(), got.tolist()))
    assert edges == _prim(ids, w)


@pytest.mark.parametrize("run_edges", [1 << 20, 5])
def test_tree_by_rounds_and_by_one_group(spark, monkeypatch, run_edges):
    monkeypatch.setattr(spanning, "RUN_EDGES", run_edges)
    rng = np.random.default_rng(3)
    vec, core = rng.normal(size=(50, 3)), rng.random(50) * 0.3
    df = spark.createDataFrame([(i, v.tolist(), float(c)) for i, (v, c) in enumerate(zip(vec, core))], "id long, vec array<double>, core double")
    got = sorted((r.src, r.dst, r.w) for r in spanning.spanning_tree(df, chunk_rows=20).collect())
    w = np.maximum(spanning.distances(vec, vec, "euclidean"), np.maximum(core[:, None], core[None, :]))
    assert got == _prim(np.arange(50), w)


def test_a_row_is_copied_a_bounded_number_of_times(spark):
    copies = lambda n: spark.range(n).agg(spanning.n_chunks(spanning.CHUNK_ROWS).alias("k")).first().k
    assert [copies(n) for n in (0, 1, 2048, 10_000, 200_000)] == [0, 1, 1, 5, 16]


def test_roots_join():
    root = np.arange(9)
    density.join_roots(root, np.array([8, 7, 1]), np.array([7, 3, 2]))
    density.join_roots(root, np.array([3, 5]), np.array([2, 5]))
    assert root.tolist() == [0, 1, 1, 1, 4, 5, 6, 1, 1]


def test_power():
    x = np.array([[0.0, 0.3, 1.0]])
    for e in (1, 5, 32, 2.5):
        assert np.allclose(validity.powered(x, e), x ** e, rtol=1e-12)


def test_norm_is_computed_once_a_row(spark):
    rows = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<float>")
    assert [r.u for r in rows.select(vx.l2_normalize(F.col("v")).alias("u")).collect()] == [[0.6, 0.8], [0.0, 0.0], None]
    nested = str(vx.l2_normalize(F.col("v")))
    assert nested.count("SQRT") + nested.count("sqrt") == 1
