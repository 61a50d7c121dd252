"""Neighbour search over pivot cells against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cells as pivot_cells
from tessera.operators import neighbours
from tessera.operators.cells import Cells, straight
from tessera.operators.spanning import true_at

SCHEMA = "id long, vec array<double>"


def points(seed, n=160, dims=3, spread=0.3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 4, (6, dims))
    rows = [(i, [float(x) for x in centre[i % 6] + rng.normal(0, spread, dims)]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(12)] + [(2000, [0.0] * dims), (2001, [0.0] * dims)]
    return rows


def matrix(rows, metric):
    m = np.array([v for _, v in rows])
    if metric == "cosine":
        n = np.linalg.norm(m, axis=1, keepdims=True)
        m = np.divide(m, n, out=np.zeros_like(m), where=n > 0)
        return 1 - m @ m.T
    return np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1))


@pytest.mark.parametrize("metric, eps, chunk", [("euclidean", 0.4, 16), ("cosine", 0.01, 16), ("cosine", 1.2, 30), ("euclidean", 0.4, 4096)])
def test_pairs_within_a_distance(spark, metric, eps, chunk):
    rows = points(1)
    d = matrix(rows, metric)
    ids = [i for i, _ in rows]
    want = {(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in zip(*np.nonzero(np.triu(d <= eps - 1e-9, 1)))}
    got = [(r["src"], r["dst"]) for r in neighbours.eps_edges(spark.createDataFrame(rows, SCHEMA), "id", "vec", eps, metric, chunk).collect()]
    assert len(got) == len(set(got)) and set(got) >= want
    assert len(got) == int(np.triu(d <= eps + 1e-9, 1).sum())


@pytest.mark.parametrize("metric, k, chunk", [("euclidean", 4, 16), ("cosine", 7, 20), ("euclidean", 30, 25), ("cosine", 3, 4096)])
def test_nearest(spark, metric, k, chunk):
    rows = points(2)
    d = matrix(rows, metric)
    np.fill_diagonal(d, np.inf)
    got = {}
    for r in neighbours.topk_neighbours(spark.createDataFrame(rows, SCHEMA), "id", "vec", k, metric, chunk).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["nb"], r["dist"]))
    assert set(got) == {i for i, _ in rows}
    at = {i: p for p, (i, _) in enumerate(rows)}
    for i, found in got.items():
        found = sorted(found)
        assert [r for r, _, _ in found] == list(range(1, k + 1))
        assert np.allclose([x for _, _, x in found], np.sort(d[at[i]])[:k], atol=1e-6)
        assert np.allclose([x for _, _, x in found], [d[at[i], at[j]] for _, j, _ in found], atol=1e-6)


def test_bounds_leave_out_pairs(spark):
    """Clustered points: far fewer pairs than all are compared."""
    rows = [r for r in points(3, 600, 3, 0.1) if r[0] < 1000]
    cells = Cells(spark.createDataFrame(rows, SCHEMA), "euclidean", 30)
    n = len(rows)
    assert cells.compared(cells.visitors(0.2, upward=True)) < n * (n - 1) / 2 / 2
    one = Cells(spark.createDataFrame(rows, SCHEMA), "euclidean", 4096)
    assert one.compared(one.visitors(0.2)) == n * (n - 1) // 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert neighbours.eps_edges(none, "id", "vec", 0.5).collect() == []
    assert neighbours.topk_neighbours(none, "id", "vec", 3).collect() == []
    assert none.agg(F.count("*")).first()[0] == 0 and straight(0.5, "cosine") == 1.0


@pytest.mark.parametrize("metric, dims", [("cosine", 12), ("euclidean", 5)])
def test_nearest_over_pairs_of_chunks(spark, monkeypatch, metric, dims):
    """Without clusters no cell can be left out; still no row is copied per cell."""

    def no_copies(*a):
        raise AssertionError("a row is copied per visited cell")

    monkeypatch.setattr(pivot_cells, "copies", no_copies)
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, dims)]) for i in rng.permutation(400)]
    rows += [(500 + i, rows[3][1]) for i in range(9)] + [(7, rows[11][1]), (7, rows[12][1])]  # equal vectors, an id of three rows
    df = spark.createDataFrame(rows + [(None, rows[0][1])], SCHEMA)
    d = matrix(rows, metric)
    if metric == "euclidean":
        d[d < 1e-7] = 0.0
    ids = np.array([i for i, _ in rows])
    got = {}
    for r in neighbours.topk_neighbours(df, "id", "vec", 6, metric, 20, group_rows=50).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["nb"], r["dist"]))
    assert set(got) == set(ids.tolist())
    for i, found in got.items():
        at = np.flatnonzero(ids == i)
        want = sorted((round(d[p, q], 9), int(ids[q])) for p in at for q in np.flatnonzero(ids != i))[:6]
        found = sorted(found)
        assert [n for n, _, _ in found] == list(range(1, 7))
        assert [nb for _, nb, _ in found] == [nb for _, nb in want]
        assert np.allclose([x for _, _, x in found], [x for x, _ in want], atol=1e-7)


def test_near_cells_share_chunks(spark):
    rows = [r for r in points(4, 900, 3, 0.1) if r[0] < 1000]
    cells = Cells(spark.createDataFrame(rows, SCHEMA), "euclidean", 30)
    first, parts = cells.chunked(100)
    held = {}
    for c, (f, m) in enumerate(zip(first, parts)):
        for p in range(m):
            held[f + p] = held.get(f + p, 0) + cells.sizes[c] / m
    assert sorted(held) == list(range(max(held) + 1)) and max(held.values()) <= 100
    assert sum(held.values()) == len(rows) and len(held) < len(cells.sizes)


def test_places_of_a_sparse_mask():
    rng = np.random.default_rng(1)
    for shape in ((3, 5), (8, 16), (0, 4), (7, 9)):
        mask = rng.random(shape) < 0.1
        assert true_at(mask).tolist() == np.flatnonzero(mask.ravel()).tolist()
        assert true_at(mask.T).tolist() == np.flatnonzero(mask.T.ravel()).tolist()
