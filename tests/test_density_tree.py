"""HDBSCAN, spanning trees and DBCV against plain statements of their definitions."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import hdbscan as hdb
from tessera.operators import spanning, validity
from tessera.operators.ordering import with_position

SCHEMA = "id long, vec array<double>"


def dist(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += (x - y) * (x - y)
    return math.sqrt(s)


def kruskal(ids, weight):
    up = {i: i for i in ids}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    tree = []
    for w, i, j in sorted((weight(i, j), i, j) for i in ids for j in ids if i < j):
        if root(i) != root(j):
            up[root(j)] = root(i)
            tree.append((w, i, j))
    return tree


def parts(nodes, edges):
    near = defaultdict(list)
    for _, i, j in edges:
        near[i].append(j)
        near[j].append(i)
    todo, out = set(nodes), []
    while todo:
        seen, stack = set(), [min(todo)]
        while stack:
            v = stack.pop()
            if v not in seen:
                seen.add(v)
                stack += near[v]
        out.append(seen)
        todo -= seen
    return [(p, [e for e in edges if e[1] in p]) for p in out]


def brute_hdbscan(vecs, least, samples, eps=0.0):
    """Top down: cut the largest edge of a cluster until it splits for good."""
    ids = sorted(vecs)
    core = {i: sorted(dist(vecs[i], vecs[j]) for j in ids)[min(samples, len(ids)) - 1] for i in ids}
    tree = kruskal(ids, lambda i, j: max(core[i], core[j], dist(vecs[i], vecs[j])))
    clusters = []

    def grow(nodes, edges, birth, parent):
        me = len(clusters)
        clusters.append({"parent": parent, "birth": birth, "left": {}, "kids": [], "stability": 0.0})
        c = clusters[me]
        lam0 = 0.0 if birth == math.inf else 1 / birth
        while True:
            edges = sorted(edges)
            w, lam = max(edges[-1][0], 1e-12), 1 / max(edges[-1][0], 1e-12)
            (a, ea), (b, eb) = parts(nodes, edges[:-1])
            if len(a) >= least and len(b) >= least:
                c["stability"] += len(nodes) * (lam - lam0)
                c["kids"] = [grow(a, ea, w, me), grow(b, eb, w, me)]
                return me
            gone = [x for x in (a, b) if len(x) < least]
            for x in gone:
                c["left"].update({v: me for v in x})
                c["stability"] += len(x) * (lam - lam0)
            if len(gone) == 2:
                return me
            nodes, edges = (a, ea) if len(a) >= least else (b, eb)

    if len(ids) < least:
        return {i: -1 for i in ids}
    grow(set(ids), tree, math.inf, None)
    chosen = set()

    def best(k):
        c = clusters[k]
        below = [best(x) for x in c["kids"]]
        if k and (not below or c["stability"] >= sum(b for b, _ in below)):
            return c["stability"], {k}
        return sum(b for b, _ in below), set().union(*(s for _, s in below)) if below else set()

    for k in best(0)[1]:
        while clusters[k]["birth"] < eps and clusters[k]["parent"]:
            k = clusters[k]["parent"]
        chosen.add(k)
    label = {}
    for k, c in enumerate(clusters):
        above, top = k, None
        while above is not None:
            top = above if above in chosen else top
            above = clusters[above]["parent"]
        label.update({v: top for v in c["left"]})
    first = sorted({t for t in label.values() if t is not None}, key=lambda t: min(v for v in label if label[v] == t))
    return {i: -1 if label.get(i) is None else first.index(label[i]) for i in ids}


def blobs(seed, n=70, dims=2):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 5, (4, dims))
    vecs = {int(i): [float(x) for x in centre[i % 4] + rng.normal(0, 0.3 + (i % 4) * 0.3, dims)] for i in range(n)}
    vecs |= {n + i: [float(x) for x in rng.uniform(-9, 9, dims)] for i in range(10)}
    return vecs


@pytest.mark.parametrize("seed, least, samples, eps, chunk, run", [
    (1, 5, None, 0.0, 1024, 1 << 20), (2, 4, 3, 0.0, 17, 9), (3, 3, 2, 1.2, 23, 1 << 20), (4, 3, 5, 0.8, 1024, 13)])
def test_hdbscan_against_brute_force(spark, seed, least, samples, eps, chunk, run):
    vecs = blobs(seed)
    df = spark.createDataFrame(list(vecs.items()), SCHEMA)
    got = {r["id"]: r["cluster"] for r in hdb.hdbscan(df, "id", "vec", least, samples, eps, chunk_rows=chunk, run_edges=run).collect()}
    want = brute_hdbscan(vecs, least, samples or least, eps)
    assert got == want and max(want.values()) > 0


def test_hdbscan_query(spark):
    from tessera.plans import QUERIES
    from tessera.plans.vectors import HDB_CLUSTER_SIZE, HDB_SAMPLES
    from tests.conftest import SF_SMALL

    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    want = brute_hdbscan({r["vec_id"]: [float(x) for x in r["embedding"]] for r in rows}, HDB_CLUSTER_SIZE, HDB_SAMPLES)
    assert {r["vec_id"]: r["cluster"] for r in QUERIES["clu_hdbscan"](spark, SF_SMALL).collect()} == want
    assert len(set(want.values())) > 1


def test_hdbscan_edges(spark):
    one = spark.createDataFrame([(7, [1.0, 2.0])], SCHEMA)
    assert [tuple(r) for r in hdb.hdbscan(one, "id", "vec", 2).collect()] == [(7, -1)]
    assert hdb.hdbscan(one.limit(0), "id", "vec", 2).collect() == []
    vecs = {i: [float(i % 3 * 10)] for i in range(12)}  # equal points: distance zero
    got = {r["id"]: r["cluster"] for r in hdb.hdbscan(spark.createDataFrame(list(vecs.items()), SCHEMA), "id", "vec", 3, 2).collect()}
    assert got == {i: i % 3 for i in range(12)}
    with pytest.raises(ValueError):
        hdb.hdbscan(one, "id", "vec", 1)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_tree_is_the_same_in_any_blocks(spark, metric):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 3)], float(rng.choice([0.0, 0.9]))) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, core double")
    trees = [sorted(map(tuple, spanning.spanning_tree(df, None, metric, c).select("src", "dst", "w").collect())) for c in (1024, 7)]
    assert trees[0] == trees[1] and len(trees[0]) == 59
    if metric == "euclidean":
        core = {i: c for i, _, c in rows}
        vec = {i: v for i, v, _ in rows}
        assert trees[0] == sorted((i, j, w) for w, i, j in kruskal(sorted(vec), lambda i, j: max(core[i], core[j], dist(vec[i], vec[j]))))


def brute_dbcv(vecs, label):
    if len(set(label.values()) - {-1}) <= 1:
        return -math.inf
    groups = defaultdict(list)
    for i, k in sorted(label.items()):
        if k != -1:
            groups[k].append(i)
    core, sparse, inner = {}, {}, {}
    for k, ids in groups.items():
        dim = len(vecs[ids[0]])
        for i in ids:
            near = [dist(vecs[i], vecs[j]) for j in ids if j != i and dist(vecs[i], vecs[j]) > 0]
            core[i] = (sum((1 / d) ** dim for d in near) / (len(ids) - 1)) ** (-1 / dim) if near else 0.0
        tree = kruskal(ids, lambda i, j: max(core[i], core[j], dist(vecs[i], vecs[j])))
        degree = defaultdict(int)
        for _, i, j in tree:
            degree[i] += 1
            degree[j] += 1
        mid = {i for i in degree if degree[i] > 1}
        inside = [w for w, i, j in tree if i in mid and j in mid]
        sparse[k] = max(inside or [w for w, _, _ in tree] or [0.0])
        inner[k] = mid or set(ids)
    total = 0.0
    for k, ids in groups.items():
        sep = min((max(core[i], core[j], dist(vecs[i], vecs[j])) for o in groups if o != k for i in inner[k] for j in inner[o]))
        total += len(ids) * (0.0 if max(sep, sparse[k]) == 0 else (sep - sparse[k]) / max(sep, sparse[k]))
    return total / len(label)


@pytest.mark.parametrize("chunk", [1024, 9])
def test_dbcv_against_brute_force(spark, chunk):
    rows, want = [], {}
    for p, seed in enumerate((11, 12, 13, 14, 15, 16)):
        vecs = blobs(seed, 40, 3)
        rng = np.random.default_rng(seed)
        label = {i: -1 if i >= 45 else i % 4 for i in vecs}
        if p == 1:
            label = {i: int(rng.integers(-1, 3)) for i in vecs}
        if p == 2:
            label = {i: 0 for i in vecs}
        if p == 3:
            label = {i: 0 if i % 2 else -1 for i in vecs}
        if p == 4:
            label = {i: i // 2 for i in vecs}  # pairs: no inner points
            label[0] = 99
        if p == 5:
            vecs = {i: vecs[i - i % 5] for i in vecs}  # equal points
        want[p] = brute_dbcv(vecs, label)
        rows += [(p, i, v, label[i]) for i, v in vecs.items()]
    df = spark.createDataFrame(rows, "param_id long, id long, vec array<double>, cluster long")
    got = {r["param_id"]: r["score"] for r in validity.dbcv(df, ["param_id"], chunk_rows=chunk).collect()}
    assert got[2] == got[3] == -math.inf and set(got) == set(want)
    for p in want:
        assert got[p] == pytest.approx(want[p], rel=1e-9)


def test_positions(spark):
    rng = np.random.default_rng(1)
    values = [int(x) for x in rng.permutation(500)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    assert sorted((r["pos"], r["v"]) for r in with_position(df, ["v"]).collect()) == [(k, k) for k in range(500)]
    assert with_position(df.where(F.lit(False)), ["v"]).collect() == []
