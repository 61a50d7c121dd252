"""Density-based validity of a clustering (DBCV), for many labelings at once.

Per cluster of a labeling: all-points core distances, the spanning tree of the
mutual-reachability distances, sparseness (largest edge between inner points,
those with more than one edge) and separation (smallest mutual-reachability
distance from its inner points to another cluster's).  The validity of a
cluster is (separation - sparseness) / max of both; the index is their mean
weighted by cluster size over all points, noise included.

Pairs are compared in blocks of bounded size (``keyed_block_pairs``); only
per-point and per-cluster values leave a block.  Core distances are summed in log
space, since 1 / distance to the power of the dimension overflows.

Defined cases: at most one cluster gives minus infinity, with or without noise
(there is no separation, so such a labeling comes last in a search).  A
cluster without inner edges takes its largest edge, one without inner points
all its points, as in the published code.  A single point has sparseness 0.  Points at distance zero do not count in a core distance; a point with only
such neighbours has core distance 0.  Equal separation and sparseness 0 is validity 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.spanning import (CHUNK_ROWS, PAIR_ROWS, keyed_block_pairs, leveled, matrix, near_levels, pair_distances, spanning_tree,
                                        tiles, true_at)
from tessera.session import materialize

NOISE = -1
POWER_ROWS = 512  # rows of a tile that stays near the processor over many passes


def _of(df: DataFrame, keys: list[str]) -> str:
    return "".join(f"{f.name} {f.dataType.simpleString()}, " for c in keys for f in df.schema.fields if f.name == c)


def _keyed(out: dict, keys: list[str], pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({**{c: pdf[c].iat[0] if len(pdf) else None for c in keys}, **out})


def powered(x: np.ndarray, exponent: float) -> np.ndarray:
    """x ** exponent, a whole exponent by squaring."""
    if exponent != int(exponent) or exponent < 1:
        return np.power(x, exponent)
    out, n, held = None, int(exponent), None
    while True:
        if n & 1:
            out = x.copy() if out is None else np.multiply(out, x, out=out)
        n >>= 1
        if not n:
            return out
        x = held = np.multiply(x, x, out=held)  # one array for all squares, not that of the caller


def all_points_core(points: DataFrame, keys: list[str], metric: str = "euclidean", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``points`` (keys, id, vec) with ``core``: ((sum of (1 / d) ** dim over the
    other points of the key) / (n - 1)) ** (-1 / dim)."""

    def log_sums(d: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """log of the sums of (1 / d) ** dim by row and by column, of the levels d."""
        p = dim * (1.0 if metric == "cosine" else 0.5)  # levels are squares unless cosine
        some = d[::POWER_ROWS // 8].min(axis=1)
        some = some[np.isfinite(some)]
        scale = np.exp(np.log(some).mean()) if len(some) else 1.0
        with np.errstate(divide="ignore", over="ignore", under="ignore", invalid="ignore"):
            x = powered(np.divide(scale, d), p)
            sums = [x.sum(axis=1), x.sum(axis=0)]
            out = [np.log(v) - p * np.log(scale) for v in sums]
            for v, log, levels in zip(sums, out, (d, d.T)):
                far = np.flatnonzero(~((v > 1e-200) & (v < 1e200)))  # the scale is not theirs
                part = levels[far]
                own = part.min(axis=1, initial=np.inf)
                of = np.where(np.isfinite(own), own, 1.0)
                log[far] = np.where(np.isfinite(own), np.log(powered(of[:, None] / part, p).sum(axis=1)) - p * np.log(of), -np.inf)
        return out[0], out[1]

    def fn(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        a = matrix(left["vec"], metric)
        b = a if same else matrix(right["vec"], metric)
        dim = a.shape[1] if len(a) else b.shape[1]
        of_a = np.full(len(a), -np.inf)
        of_b = of_a if same else np.full(len(b), -np.inf)
        for x, y in tiles(len(a), len(b), same, POWER_ROWS):
            d, slack = near_levels(a[x], b[y], metric)
            # where a product loses the digits of a short distance, and at zero
            i, j = np.divmod(true_at(d <= 1e8 * slack), d.shape[1])
            for s in range(0, len(i), PAIR_ROWS):
                r, c = i[s:s + PAIR_ROWS], j[s:s + PAIR_ROWS]
                near = leveled(pair_distances(a[x][r], b[y][c], metric), metric)
                d[r, c] = np.where(near > 0, near, np.inf)  # a point at distance zero does not count
            if same and x == y:
                np.fill_diagonal(d, np.inf)
            by_row, by_column = log_sums(d, dim)
            of_a[x] = np.logaddexp(of_a[x], by_row)
            if not (same and x == y):
                of_b[y] = np.logaddexp(of_b[y], by_column)
        ids, part = (left["id"], of_a) if same else (pd.concat([left["id"], right["id"]]), np.concatenate([of_a, of_b]))
        return _keyed({"id": ids.to_numpy(np.int64), "dim": dim, "part": part}, keys, left if len(left) else right)

    rows = points.select(*keys, "id", "vec")
    parts = keyed_block_pairs(rows, keys, "id", fn, _of(points, keys) + "id long, dim int, part double", chunk_rows, dealt=True)
    parts = materialize(parts.where("part > double('-infinity')"), "dbcv-parts")
    top = parts.groupBy(*keys, "id").agg(F.max("part").alias("top"), F.max("dim").alias("dim"))
    total = parts.join(top.drop("dim"), [*keys, "id"]).groupBy(*keys, "id").agg(F.sum(F.exp(F.col("part") - F.col("top"))).alias("s"))
    size = points.groupBy(*keys).agg(F.count("*").alias("n"))
    core = top.join(total, [*keys, "id"]).join(size, keys)
    core = core.withColumn("core", F.exp((F.col("top") + F.log("s") - F.log(F.col("n") - 1)) / -F.col("dim")))
    return points.join(core.select(*keys, "id", "core"), [*keys, "id"], "left").withColumn("core", F.coalesce("core", F.lit(0.0)))


def separations(inner: DataFrame, keys: list[str], cluster: str, metric: str = "euclidean", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(keys, cluster, separation): smallest mutual-reachability distance of a
    cluster's points to those of another cluster of the same labeling."""

    def fn(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        left = left.sort_values(cluster)  # so that most tiles of a large cluster hold no other
        right = left if same else right.sort_values(cluster)
        a = matrix(left["vec"], metric)
        b = a if same else matrix(right["vec"], metric)
        if not len(a) or not len(b):
            return _keyed({cluster: [], "separation": []}, keys, left)
        of_a, of_b = left[cluster].to_numpy(np.int64), right[cluster].to_numpy(np.int64)
        core_a, core_b = left["core"].to_numpy(np.float64), right["core"].to_numpy(np.float64)
        least = []
        for x, y in tiles(len(a), len(b), same):
            if of_a[x.start] == of_a[x.stop - 1] == of_b[y.start] == of_b[y.stop - 1]:
                continue
            d, _ = near_levels(a[x], b[y], metric)
            np.maximum(d, leveled(core_a[x], metric)[:, None], out=d)
            np.maximum(d, leveled(core_b[y], metric)[None, :], out=d)
            d[of_a[x][:, None] == of_b[y][None, :]] = np.inf
            for i, j in ((np.arange(len(d)), d.argmin(axis=1)), (d.argmin(axis=0), np.arange(d.shape[1]))):
                there = np.isfinite(d[i, j])
                i, j = i[there] + x.start, j[there] + y.start
                w = np.maximum(pair_distances(a[i], b[j], metric), np.maximum(core_a[i], core_b[j]))
                least += [pd.Series(w, index=of_a[i]), pd.Series(w, index=of_b[j])]
        least = pd.concat([pd.Series([], index=np.zeros(0, np.int64), dtype=np.float64), *least])
        least = least.groupby(level=0).min()
        least = least[np.isfinite(least)]
        return _keyed({cluster: least.index.to_numpy(), "separation": least.to_numpy()}, keys, left)

    schema = _of(inner, keys) + f"{cluster} long, separation double"
    found = keyed_block_pairs(inner.select(*keys, cluster, "id", "vec", "core"), keys, "id", fn, schema, chunk_rows, dealt=True)
    return found.groupBy(*keys, cluster).agg(F.min("separation").alias("separation"))


def cluster_validity(points: DataFrame, keys: list[str], cluster: str = "cluster", metric: str = "euclidean",
                     chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(keys, cluster, n, sparseness, separation, validity) of every cluster."""
    own = [*keys, cluster]
    points = points.select(*keys, F.col(cluster).cast("long").alias(cluster), "id", "vec").where(F.col(cluster) != NOISE)
    points = materialize(all_points_core(materialize(points, "dbcv-points"), own, metric, chunk_rows), "dbcv-core")
    tree = materialize(spanning_tree(points, own, metric, chunk_rows), "dbcv-tree")
    degree = tree.select(*own, F.explode(F.array("src", "dst")).alias("id")).groupBy(*own, "id").agg(F.count("*").alias("degree"))
    inner = materialize(degree.where("degree > 1").select(*own, "id"), "dbcv-inner")
    mark = lambda end: inner.select(*own, F.col("id").alias(end), F.lit(True).alias(f"in_{end}"))
    edges = tree.join(mark("src"), [*own, "src"], "left").join(mark("dst"), [*own, "dst"], "left")
    inside = F.coalesce(F.col("in_src") & F.col("in_dst"), F.lit(False))
    sparse = edges.groupBy(*own).agg(F.max(F.when(inside, F.col("w"))).alias("within"), F.max("w").alias("largest"))
    sparse = sparse.select(*own, F.coalesce("within", "largest").alias("sparseness"))
    some = inner.select(*own).distinct().withColumn("has_inner", F.lit(True))
    flagged = points.join(inner.withColumn("is_inner", F.lit(True)), [*own, "id"], "left").join(some, own, "left")
    flagged = materialize(flagged.where("is_inner or has_inner is null").drop("is_inner", "has_inner"), "dbcv-inner-points")
    apart = separations(flagged, keys, cluster, metric, chunk_rows)
    rows = points.groupBy(*own).agg(F.count("*").alias("n")).join(sparse, own, "left").join(apart, own, "left")
    low, sep = F.coalesce("sparseness", F.lit(0.0)), F.coalesce("separation", F.lit(float("inf")))
    value = F.when(F.greatest(sep, low) == 0, F.lit(0.0)).otherwise((sep - low) / F.greatest(sep, low))
    return rows.select(*own, "n", low.alias("sparseness"), sep.alias("separation"), value.alias("validity"))


def dbcv(points: DataFrame, keys: list[str], cluster: str = "cluster", metric: str = "euclidean",
         chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(keys, n_points, n_clusters, n_noise, score) of every labeling; ``points``
    holds (keys, id, vec, cluster) with noise as -1."""
    count = points.groupBy(*keys).agg(
        F.count("*").alias("n_points"), F.count_distinct(F.when(F.col(cluster) != NOISE, F.col(cluster))).alias("n_clusters"),
        F.count_if(F.col(cluster) == NOISE).alias("n_noise"))
    count = materialize(count, "dbcv-count")
    some = count.where("n_clusters > 1").select(*keys)  # the others have no separation, whatever their clusters are like
    each = cluster_validity(points.join(some, keys, "left_semi"), keys, cluster, metric, chunk_rows)
    total = each.groupBy(*keys).agg(F.sum(F.col("n") * F.col("validity")).alias("total"))
    one = F.col("n_clusters") <= 1
    return count.join(total, keys, "left").select(
        *keys, "n_points", "n_clusters", "n_noise",
        F.when(one, F.lit(float("-inf"))).otherwise(F.col("total") / F.col("n_points")).alias("score"))
