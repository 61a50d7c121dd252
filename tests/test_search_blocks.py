"""The blocks of the parameter search: what is compared, and the sums of a block."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators import density, validity
from tessera.operators.spanning import distances, pair_distances
from tests.test_vectors import _scan_dbscan


def clouds(seed=0, dims=8):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (3, dims))
    m = np.concatenate([c + rng.normal(0, 0.25, (90, dims)) for c in centre] + [rng.normal(0, 1, (60, dims))])
    return rng.permutation(m)


@pytest.mark.parametrize("chunk, run_edges", [(40, 1 << 20), (40, 0), (5000, 1 << 20)])
def test_labels_over_pairs_of_chunks(spark, monkeypatch, chunk, run_edges):
    monkeypatch.setattr(density, "RUN_EDGES", run_edges)
    m = clouds()
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    settings = density.grid([0.02, 0.08, 0.3], [3, 9])
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(m)], "vec_id long, vec array<double>")
    got = {}
    for r in density.dbscan_grid(df, "vec_id", "vec", settings, chunk_rows=chunk).collect():
        got.setdefault(r["param_id"], {})[r["vec_id"]] = r["cluster"]
    kinds = set()
    for s in settings:
        want = _scan_dbscan(1 - u @ u.T, s.eps, s.min_samples)
        assert [got[s.param_id][k] for k in range(len(m))] == want.tolist()
        kinds.add((want.max() > 0, bool((want < 0).any())))
    assert len(kinds) > 1  # one and more clusters


def test_settled_pairs_are_not_compared(monkeypatch):
    compared = []
    near = density.Points.near
    monkeypatch.setattr(density.Points, "near", lambda self, other, i, j: compared.append(len(i) * len(j)) or near(self, other, i, j))
    monkeypatch.setattr(density, "tiles", lambda a, b, same: [(slice(x, x + 50), slice(y, y + 50)) for x in range(0, a, 50) for y in range(0, b, 50)])
    rng = np.random.default_rng(2)
    vec = pd.Series(list(np.array([5.0, 0, 0]) + rng.normal(0, 0.1, (600, 3))))
    ids, core = np.arange(600), np.ones((1, 600), bool)
    core[0, 17] = False
    s = density.Stars(ids, core, [0.5], np.arange(600)[None, :].copy())
    a, b = density.Points(vec[:300], [0.5], "cosine"), density.Points(vec[300:], [0.5], "cosine")
    s.compare(a, b, ids[:300], ids[300:], False)
    assert sum(compared) < 300 * 300 / 2
    assert set(s.root[0][core[0]]) == {0} and list(zip(*s.borders(0))) == [(0, 17)]


def test_eps_is_decided_exactly():
    """Distances nearer to eps than single precision can tell."""
    rng = np.random.default_rng(3)
    m = rng.normal(0, 1, (80, 16))
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    d = 1 - (u[:, None] * u[None]).sum(-1)
    eps = float(np.sort(d[np.triu_indices(80, 1)])[500])
    for e in (eps - 1e-11, eps + 1e-11):
        p = density.Points(pd.Series(list(m)), [e, 1.0], "cosine")
        got = {(i, j) for r, c, x in p.near(p, np.arange(80), np.arange(80)) for i, j, y in zip(r, c, x) if y <= e and i != j}
        assert got == {(i, j) for i, j in zip(*np.nonzero(d <= e)) if i != j}


def test_labelings_of_one_cluster_need_no_validity(spark, monkeypatch):
    seen = []
    each = validity.cluster_validity
    monkeypatch.setattr(validity, "cluster_validity", lambda points, *a: seen.extend(r[0] for r in points.select("param_id").distinct().collect()) or each(points, *a))
    rng = np.random.default_rng(4)
    rows = [(k, i, [float(x) for x in rng.normal(i % 2 * 9, 1, 3)], c) for k, of in enumerate((lambda i: 0, lambda i: i % 2, lambda i: -1)) for i in range(30) for c in [of(i)]]
    points = spark.createDataFrame(rows, "param_id int, id long, vec array<double>, cluster long")
    got = {r["param_id"]: r for r in validity.dbcv(points, ["param_id"]).collect()}
    assert seen == [1]
    assert got[0]["score"] == got[2]["score"] == float("-inf") and got[1]["score"] > 0
    assert [(got[k]["n_points"], got[k]["n_clusters"], got[k]["n_noise"]) for k in range(3)] == [(30, 1, 0), (30, 2, 0), (30, 0, 30)]


@pytest.mark.parametrize("dims", [3, 64, 65])
def test_core_distances_of_all_scales(spark, dims):
    rng = np.random.default_rng(5)
    m = np.concatenate([rng.normal(0, s, (25, dims)) + s * 50 for s in (1e-6, 1.0, 1e7)])
    m = np.concatenate([m, m[:2]])
    df = spark.createDataFrame([(0, k, [float(x) for x in v]) for k, v in enumerate(m)], "k int, id long, vec array<double>")
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1))
    for r in validity.all_points_core(df, ["k"], chunk_rows=40).collect():
        logs = -dims * np.log(d[r["id"]][d[r["id"]] > 0])
        want = np.exp((logs.max() + np.log(np.exp(logs - logs.max()).sum()) - np.log(len(m) - 1)) / -dims)
        assert np.isclose(r["core"], want, rtol=1e-9)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_pairs_have_the_doubles_of_the_matrix(metric):
    rng = np.random.default_rng(6)
    a, b = rng.normal(0, 1, (2500, 37)), rng.normal(0, 1, (3, 37))
    assert (pair_distances(a, np.tile(b[1], (2500, 1)), metric) == distances(a, b, metric)[:, 1]).all()
