"""Hierarchical density clustering (HDBSCAN).

Core distances and the spanning tree of mutual-reachability distances come from
``spanning``.  The tree's edges, in ascending order, are the merges of the
single-linkage tree.  They are dealt into runs of at most ``run_edges``: a
run is one group of bounded size that merges the components which the runs
before it left, so the tree is never whole in one task or on the driver.

A component of at least ``min_cluster_size`` points is a cluster.  Merges seen
from below (lambda = 1 / distance):

* small + small, together large enough: a new cluster; its points leave it here;
* cluster + small: the points of the small one leave the cluster here;
* cluster + cluster: both were born here, and a new cluster holds both.

A cluster's stability is the sum of lambda over its points' leaving minus size
times lambda at birth.  It is selected if the best total of its
descendants is not larger; the root never is.  A selected cluster born below
``epsilon`` gives way to its closest ancestor born at or above it.  A point
has the label of the topmost selected cluster above the place where it left,
else -1 (noise).

Clusters are numbered in the order of their smallest point id.  Distance zero
counts as 1e-12, so that lambda stays finite.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import with_position
from tessera.operators.spanning import CHUNK_ROWS, core_distances, spanning_tree
from tessera.session import materialize

RUN_EDGES = 1 << 20
TINY = 1e-12
MOVED, STATE, CLUSTER, LEFT = range(4)
ROWS = "kind int, a long, b long, n long, x double, y double, z double, flag boolean"
NONE = -1


def _merge_run(pdf: pd.DataFrame, least: int) -> pd.DataFrame:
    """Merges of one run.  In: edges (a, b, w, pos) with the state of a in the
    columns ``a_*`` and of b in ``b_*``.  Out: ``ROWS`` by kind:

    MOVED    vertex a now belongs to component b
    STATE    component a is cluster b (or NONE) of n points with lambda sum x,
             best total y of its child clusters; flag: it has some
    CLUSTER  a finished cluster a with parent b, n points, birth distance x,
             stability y, best total z; flag: selected
    LEFT     the points of vertex a left in cluster b
    """
    pdf = pdf.sort_values("pos")
    up: dict[int, int] = {}
    state: dict[int, list] = {}   # root -> [size, cluster, lambda sum, best of children, has children]
    waiting: dict[int, list] = {}  # small root -> its vertices
    out: list[tuple] = []
    for side in "ab":
        for v, size, cluster, lam, kids, has in zip(*(pdf[c] for c in (
                side, *(f"{side}_{x}" for x in ("size", "cluster", "lam", "kids", "has"))))):
            up[v], state[v], waiting[v] = v, [size, cluster, lam, kids, has], [v]

    def root(v):
        while up[v] != v:
            up[v] = v = up[up[v]]
        return v

    def finish(s, parent, w):
        size, cluster, lam, kids, has = s
        own = lam - size / w
        chosen = not (has and kids > own)
        best = own if chosen else kids
        out.append((CLUSTER, cluster, parent, size, w, own, best, chosen))
        return best

    for a, b, w, pos in zip(pdf["a"], pdf["b"], pdf["w"], pdf["pos"]):
        a, b, w = root(a), root(b), max(w, TINY)
        if b < a:
            a, b = b, a
        s, t = state[a], state.pop(b)
        up[b] = a
        size = s[0] + t[0]
        if s[1] != NONE and t[1] != NONE:
            state[a] = [size, pos, size / w, finish(s, pos, w) + finish(t, pos, w), True]
        elif s[1] != NONE or t[1] != NONE:
            big, small, gone = (s, t, b) if s[1] != NONE else (t, s, a)
            out += [(LEFT, v, big[1], 0, 0.0, 0.0, 0.0, False) for v in waiting[gone]]
            state[a] = [size, big[1], big[2] + small[0] / w, *big[3:]]
            waiting[a] = []
        elif size >= least:
            out += [(LEFT, v, pos, 0, 0.0, 0.0, 0.0, False) for x in (a, b) for v in waiting[x]]
            state[a] = [size, pos, size / w, 0.0, False]
            waiting[a] = []
        else:
            state[a] = [size, NONE, 0.0, 0.0, False]
            waiting[a] += waiting[b]
    out += [(MOVED, v, root(v), 0, 0.0, 0.0, 0.0, False) for v in up]
    out += [(STATE, v, s[1], s[0], s[2], s[3], 0.0, s[4]) for v, s in state.items()]
    return pd.DataFrame(out, columns=["kind", "a", "b", "n", "x", "y", "z", "flag"])


def cluster_tree(ids: DataFrame, tree: DataFrame, min_cluster_size: int,
                 run_edges: int = RUN_EDGES) -> tuple[DataFrame, DataFrame]:
    """(clusters, leaves): the condensed tree (cluster, parent, n, birth,
    stability, best, selected), parent null for the root, and per point the
    cluster (id, cluster) it left last."""
    if min_cluster_size < 2:
        raise ValueError("min_cluster_size must be at least 2")
    spark = ids.sparkSession
    edges = materialize(with_position(tree, ["w", "src", "dst"]), "hdb-edges")
    n_runs = -(-edges.count() // run_edges)
    where = ids.select("id", F.col("id").alias("comp"))
    state = spark.createDataFrame([], "comp long, size long, cluster long, lam double, kids double, has boolean")
    start = {"size": F.lit(1).cast("long"), "cluster": F.lit(NONE).cast("long"), "lam": F.lit(0.0), "kids": F.lit(0.0), "has": F.lit(False)}
    clusters, leaves = [], []

    for k in range(n_runs):
        run = edges.where(F.floor(F.col("pos") / run_edges) == k)
        for side, end in (("a", "src"), ("b", "dst")):
            run = run.join(where.select(F.col("id").alias(end), F.col("comp").alias(side)), end)
            known = state.select(F.col("comp").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in start))
            run = run.join(known, side, "left").withColumns({f"{side}_{c}": F.coalesce(f"{side}_{c}", v) for c, v in start.items()})
        run = run.drop("src", "dst").withColumn("run", F.lit(k))
        done = materialize(run.groupBy("run").applyInPandas(lambda pdf: _merge_run(pdf, min_cluster_size), ROWS), "hdb-run")
        part = lambda kind: done.where(F.col("kind") == kind)  # noqa: B023,E731
        clusters.append(part(CLUSTER))
        leaves.append(where.join(part(LEFT).select(F.col("a").alias("comp"), F.col("b").alias("cluster")), "comp").select("id", "cluster"))
        moved = part(MOVED).select(F.col("a").alias("comp"), F.col("b").alias("to"))
        where = materialize(where.join(moved, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "hdb-where")
        new = part(STATE).select(F.col("a").alias("comp"), F.col("n").alias("size"), F.col("b").alias("cluster"),
                                 F.col("x").alias("lam"), F.col("y").alias("kids"), F.col("flag").alias("has"))
        state = materialize(state.join(moved, "comp", "left_anti").unionByName(new), "hdb-state")

    union = lambda parts, schema: (spark.createDataFrame([], schema) if not parts else
                                   materialize(_union(parts), "hdb-out"))
    found = union(clusters, ROWS).select(F.col("a").alias("cluster"), F.col("b").alias("parent"), "n", F.col("x").alias("birth"),
                                         F.col("y").alias("stability"), F.col("z").alias("best"), F.col("flag").alias("selected"))
    roots = state.where(F.col("cluster") != NONE).select(
        "cluster", F.lit(None).cast("long").alias("parent"), F.col("size").alias("n"), F.lit(float("inf")).alias("birth"),
        F.col("lam").alias("stability"), F.greatest("lam", "kids").alias("best"), F.lit(False).alias("selected"))
    return found.unionByName(roots), union(leaves, "id long, cluster long")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def selected_above(clusters: DataFrame, epsilon: float = 0.0) -> DataFrame:
    """(cluster, chosen): the topmost selected cluster at or above each
    cluster, moved up to ``epsilon``; no row where there is none.  Ancestors
    are reached by pointer doubling."""
    tree = materialize(clusters, "hdb-tree")
    root = tree.where(F.col("parent").isNull()).select(F.col("cluster").alias("parent"), F.lit(True).alias("under_root"))
    rows = tree.join(root, "parent", "left")
    step = rows.select("cluster", F.col("parent").alias("up"), F.when(F.col("selected"), F.col("cluster")).alias("chosen"))
    while True:
        step = materialize(step, "hdb-up")
        if step.where(F.col("up").isNotNull()).isEmpty():
            break
        above = step.select(F.col("cluster").alias("up"), F.col("up").alias("up2"), F.col("chosen").alias("chosen2"))
        step = step.join(above, "up", "left").select("cluster", F.col("up2").alias("up"), F.coalesce("chosen2", "chosen").alias("chosen"))
    step = step.where(F.col("chosen").isNotNull()).select("cluster", "chosen")
    if epsilon <= 0:
        return step
    stays = F.coalesce(F.col("under_root"), F.lit(False)) | (F.col("birth") >= epsilon) | F.col("parent").isNull()
    jump = materialize(rows.select("cluster", F.when(stays, F.col("cluster")).otherwise(F.col("parent")).alias("to")), "hdb-eps")
    while True:
        far = materialize(jump.join(jump.select(F.col("cluster").alias("to"), F.col("to").alias("to2")), "to")
                          .select("cluster", "to", "to2"), "hdb-eps")
        jump = far.select("cluster", F.col("to2").alias("to"))
        if far.where("to != to2").isEmpty():
            break
    lifted = step.where("cluster = chosen").join(jump, "cluster").select(F.col("to").alias("seed")).distinct()
    # a cluster below a lifted one belongs to it
    again = tree.drop("selected").join(lifted.select(F.col("seed").alias("cluster"), F.lit(True).alias("selected")), "cluster", "left")
    return selected_above(again.withColumn("selected", F.coalesce("selected", F.lit(False))))


def hdbscan(df: DataFrame, id_col: str, vec_col: str, min_cluster_size: int = 10, min_samples: int | None = None,
            epsilon: float = 0.0, metric: str = "euclidean", chunk_rows: int = CHUNK_ROWS,
            run_edges: int = RUN_EDGES) -> DataFrame:
    """(<id_col>, cluster) for every row; ``min_samples`` is
    ``min_cluster_size`` where not given.  Ids must be distinct; fewer than two
    rows, or no split into clusters, give noise only."""
    points = materialize(df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")), "hdb-points")
    core = core_distances(points, min_samples or min_cluster_size, metric, chunk_rows)
    points = materialize(points.join(core, "id"), "hdb-core")
    clusters, leaves = cluster_tree(points, spanning_tree(points, None, metric, chunk_rows), min_cluster_size, run_edges)
    chosen = selected_above(clusters, epsilon)
    named = materialize(leaves.join(chosen, "cluster").select("id", "chosen"), "hdb-named")
    first = named.groupBy("chosen").agg(F.min("id").alias("first"))
    number = with_position(first, ["first"], "cluster").select("chosen", "cluster")
    label = named.join(number, "chosen").select("id", "cluster")
    return points.select("id").join(label, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("cluster", F.lit(-1)).cast("long").alias("cluster"))
