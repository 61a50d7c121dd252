"""Vector operators against brute-force numpy statements."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import density, graph, neighbours
from tessera.session import scratch_dir
from tessera.sources import sinks

SF = "/root/testdata/sf0.001"


def _load(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    rows = e.orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([r.embedding for r in rows], dtype=np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    return e, ids, 1.0 - m @ m.T


def _scan_dbscan(d, eps, min_samples):
    """Sequential DBSCAN scanning points in id order."""
    n = len(d)
    nb = [np.nonzero(d[i] <= eps)[0] for i in range(n)]
    core = np.array([len(x) >= min_samples for x in nb])
    lab = np.full(n, -1)
    c = 0
    for i in range(n):
        if lab[i] != -1 or not core[i]:
            continue
        lab[i] = c
        stack = [i]
        while stack:
            p = stack.pop()
            for q in nb[p]:
                if lab[q] == -1:
                    lab[q] = c
                    if core[q]:
                        stack.append(q)
        c += 1
    return lab


@pytest.mark.parametrize("eps, ms", [(0.65, 4), (0.6, 3), (0.3, 4)])
def test_dbscan_matches_scan(spark, eps, ms):
    e, ids, d = _load(spark)
    want = dict(zip(ids.tolist(), _scan_dbscan(d, eps, ms).tolist()))
    got = density.dbscan(e, "vec_id", "embedding", eps, ms, chunk_rows=64)
    assert {r.vec_id: r.cluster for r in got.collect()} == want


def test_grid_equals_single_runs(spark):
    e, ids, d = _load(spark)
    settings = density.grid([0.6, 0.65], [3, 4])
    got = density.dbscan_grid(e, "vec_id", "embedding", settings, chunk_rows=100).collect()
    for s in settings:
        want = dict(zip(ids.tolist(), _scan_dbscan(d, s.eps, s.min_samples).tolist()))
        assert {r.vec_id: r.cluster for r in got if r.param_id == s.param_id} == want


def test_duplicates_weigh_as_rows(spark):
    e, ids, d = _load(spark)
    dup = e.unionByName(e.withColumn("vec_id", F.col("vec_id") + 100000))
    lab = {r.vec_id: r.cluster for r in density.dbscan(dup, "vec_id", "embedding", 0.65, 4).collect()}
    # every point and its copy share the label; copies double the weight
    assert all(lab[i] == lab[i + 100000] for i in ids.tolist())


def test_topk_matches_brute(spark):
    e, ids, d = _load(spark)
    k = 5
    got = neighbours.topk_neighbours(e, "vec_id", "embedding", k, chunk_rows=50).collect()
    have = {}
    for r in got:
        have.setdefault(r.id, []).append((r.rank, r.nb))
    for i, row in enumerate(d):
        order = sorted((row[j], ids[j]) for j in range(len(ids)) if j != i)[:k]
        assert [nb for _, nb in sorted(have[ids[i]])] == [int(x[1]) for x in order]


def test_components_union_find(spark):
    rng = np.random.default_rng(7)
    n = 200
    edges = {(int(a), int(b)) for a, b in rng.integers(0, n, size=(150, 2)) if a != b}
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {}
    for v in range(n):
        want.setdefault(find(v), []).append(v)
    want = {v: min(members) for members in want.values() for v in members}
    vdf = spark.createDataFrame([(v,) for v in range(n)], "id long")
    edf = spark.createDataFrame(sorted(edges), "src long, dst long")
    got = {r.id: r.comp for r in graph.components(vdf, edf).collect()}
    assert got == want


def test_merge_twice_is_once(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, version long")
    batch = spark.createDataFrame([(2, "B", 2), (2, "B2", 3), (3, "c", 2)], "k long, v string, version long")
    p0 = scratch_dir(spark, "t-merge-0")
    sinks.merge_upsert(spark, p0, target, ["k"], order_col="version")
    once = sorted(map(tuple, sinks.merge_upsert(spark, p0, batch, ["k"], order_col="version").collect()))
    twice = sorted(map(tuple, sinks.merge_upsert(spark, p0, batch, ["k"], order_col="version").collect()))
    assert once == twice == [(1, "a", 1), (2, "B2", 3), (3, "c", 2)]


def test_search_settings():
    g = density.search_settings("grid", [0.5, 0.6], [3, 4])
    assert [(s.eps, s.min_samples) for s in g] == [(0.5, 3), (0.5, 4), (0.6, 3), (0.6, 4)]
    r = density.search_settings("random", [0.5, 0.6], [3, 4], n_iter=2)
    assert len(r) == 2 and r == density.search_settings("random", [0.5, 0.6], [3, 4], n_iter=2)
    with pytest.raises(ValueError):
        density.search_settings("bayes", [0.5], [3])


def test_encoder_in_ml_pipeline(spark):
    from pyspark.ml import Pipeline

    from tessera.operators.ml import HashingSentenceEncoder

    df = spark.createDataFrame([("the cat the",), ("",)], "sentence string")
    model = Pipeline(stages=[HashingSentenceEncoder(numFeatures=8, normalize=True)]).fit(df)
    rows = model.transform(df).collect()
    assert len(rows[0].embedding) == 8
    assert abs(sum(x * x for x in rows[0].embedding) - 1.0) < 1e-5
    assert sum(rows[1].embedding) == 0.0


def test_eps_edges_euclidean(spark):
    e, ids, _ = _load(spark)
    raw = np.array([r.embedding for r in e.orderBy("vec_id").collect()], dtype=np.float64)
    d = np.sqrt(((raw[:, None, :] - raw[None, :, :]) ** 2).sum(-1))
    eps = float(np.quantile(d[np.triu_indices(len(d), 1)], 0.01))
    want = {(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(np.triu(d <= eps, 1)))}
    got = {(r.src, r.dst) for r in neighbours.eps_edges(e, "vec_id", "embedding", eps, "euclidean",
                                                            chunk_rows=70).collect()}
    assert got == want
