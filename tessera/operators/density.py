"""Density clustering (V5 DBSCAN, V12 one-job parameter search).

Identical vectors are merged into one point with a weight.  Two passes over
blocks of bounded size (``keyed_block_pairs``) replace an edge table:

1. A block counts, per point and eps, the weight of its neighbours; sums
   over the blocks tell for every setting whether a point is core.
2. A chunk keeps, per setting, its connected core points as a star (smallest
   id, member) and the stars that its border points are next to; then pairs of
   chunks keep which of their stars are one.  Pairs of points that are
   settled - in or next to the largest star in every setting - are left out.

The components of the stars are the clusters; a border point joins the
smallest cluster next to it; the rest is noise (-1).

Cluster ids are deterministic: clusters are numbered 0, 1, ... in the
order of their smallest core point id (range offsets, no one-task window), and
a border point takes the smallest adjacent cluster id - the labels a
sequential scan in id order produces.

All settings of a search run in one job: they are a handful of driver-side
values, so both passes serve all of them and every later step is keyed by
``param_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cells import distance_matrix
from tessera.operators.graph import components
from tessera.operators.ordering import with_position
from tessera.operators.spanning import (CHUNK_ROWS, PAIR_ROWS, RUN_EDGES, deal, join_roots, keyed_block_pairs, matrix, n_chunks, pair_distances,
                                        tiles, true_at)
from tessera.session import materialize


@dataclass(frozen=True)
class Setting:
    param_id: int
    eps: float
    min_samples: int


def grid(eps_values, min_samples_values) -> list[Setting]:
    """Cartesian product of the lists, numbered in row-major order."""
    out, i = [], 0
    for e in eps_values:
        for m in min_samples_values:
            out.append(Setting(i, float(e), int(m)))
            i += 1
    return out


def search_settings(search_type: str, eps_values, min_samples_values, n_iter: int | None = None,
                    seed: int = 42) -> list[Setting]:
    """Settings of a search: the whole grid, or ``n_iter`` of them drawn
    without replacement in a repeatable md5 order for ``random``.  Any
    other search type is an error."""
    import hashlib

    full = grid(eps_values, min_samples_values)
    if search_type == "grid":
        return full
    if search_type == "random":
        key = lambda s: hashlib.md5(f"{seed}|{s.param_id}".encode()).hexdigest()
        return sorted(full, key=key)[: (n_iter or len(full))]
    raise ValueError(f"unknown search type {search_type!r}; use 'grid' or 'random'")


def row_sample(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """The rows whose md5 of (seed, id) lies below the fraction: repeatable,
    whatever the partitioning."""
    high = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("long")
    return df.where(high < int(fraction * 2**32))


def dedupe_points(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(points: id, vec, weight), (members: orig_id, id).  Identical vectors
    become one point (smallest id) whose weight is their count."""
    g = df.groupBy(vec_col).agg(F.min(id_col).cast("long").alias("id"), F.count(F.lit(1)).alias("weight"))
    members = df.join(g.select(vec_col, "id"), vec_col).select(F.col(id_col).cast("long").alias("orig_id"), "id")
    return g.select("id", F.col(vec_col).alias("vec"), "weight"), members


STAR, BORDER = 0, 1
BLOCK_ROWS = 4 * CHUNK_ROWS  # most rows of a chunk


class Points:
    """Vectors of a chunk, compared with the eps of a search: for cosine by a
    product in single precision, and exactly where that can't tell."""

    def __init__(self, vec: pd.Series, eps: list[float], metric: str):
        self.eps, self.metric, self.vec = eps, metric, matrix(vec, metric)
        self.fast = self.vec.astype(np.float32) if metric == "cosine" else self.vec

    def near(self, other: "Points", i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, d) of the pairs of rows i and rows j of the other's within the
        largest eps; d lies on the right side of every eps."""
        if not len(i) or not len(j):
            return
        top, dim = max(self.eps), self.vec.shape[1]
        if self.metric != "cosine":
            d = distance_matrix(self.vec[i], other.vec[j], self.metric)
            at = true_at(d <= top)
            r, c = np.divmod(at, len(j))
            yield i[r], j[c], d[r, c]
            return
        slack = (dim + 4) * 2.0**-23
        close = self.fast[i] @ other.fast[j].T
        at = true_at(close >= np.float32(1.0 - top - slack))
        for s in range(0, len(at), PAIR_ROWS):
            r, c = np.divmod(at[s:s + PAIR_ROWS], len(j))
            x, y, d = i[r], j[c], 1.0 - close[r, c].astype(np.float64)
            unsure = np.flatnonzero((np.abs(d[:, None] - np.array(self.eps)[None, :]) <= 2 * slack).any(axis=1))
            d[unsure] = pair_distances(self.vec[x[unsure]], other.vec[y[unsure]], self.metric)
            ok = d <= top
            yield x[ok], y[ok], d[ok]


def _neighbour_weights(pts: DataFrame, eps: list[float], metric: str, chunk_rows: int) -> DataFrame:
    """(id, w0, w1, ...): weight of the other points within each eps."""
    names = [f"w{k}" for k in range(len(eps))]

    def fn(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        wl, wr = left["weight"].to_numpy(np.int64), right["weight"].to_numpy(np.int64)
        of_left = np.zeros((len(eps), len(left)), np.int64)
        of_right = of_left if same else np.zeros((len(eps), len(right)), np.int64)
        a = Points(left["vec"], eps, metric)
        b = a if same else Points(right["vec"], eps, metric)
        for x, y in tiles(len(left), len(right), same):
            for i, j, d in a.near(b, np.arange(x.start, x.stop), np.arange(y.start, y.stop)):
                if same and x == y:
                    once = i < j
                    i, j, d = i[once], j[once], d[once]
                for k, e in enumerate(eps):
                    at = d <= e
                    np.add.at(of_left[k], i[at], wr[j[at]])
                    np.add.at(of_right[k], j[at], wl[i[at]])
        rows, found = ([left["id"]], [of_left]) if same else ([left["id"], right["id"]], [of_left, of_right])
        return pd.DataFrame({"id": pd.concat(rows), **dict(zip(names, np.concatenate(found, axis=1)))})

    schema = "id long, " + ", ".join(f"{n} long" for n in names)
    parts = keyed_block_pairs(pts.select("id", "vec", "weight"), [], "id", fn, schema, chunk_rows, dealt=True)
    return parts.groupBy("id").agg(*(F.sum(n).alias(n) for n in names))


class Stars:
    """The stars of connected core points of some rows, per setting.

    ``root`` holds each row's smallest known row of its star.  A row is settled
    in a setting if it is a core point of the largest star, or one next to it: a pair
    of settled rows has nothing to add, so it is not compared."""

    def __init__(self, ids: np.ndarray, core: np.ndarray, eps: list[float], root: np.ndarray):
        self.ids, self.core, self.eps, self.root = ids, core, eps, root
        self.next_to = np.full(root.shape, -1)  # a core point found next to a row that is not
        self.border: list[list[np.ndarray]] = [[] for _ in eps]

    def open(self) -> np.ndarray:
        """Rows that are not settled in every setting."""
        n, out = len(self.ids), np.zeros(len(self.ids), bool)
        for core, root, next_to in zip(self.core, self.root, self.next_to):
            if not core.any():
                continue  # no point is core: there is nothing to find
            star = np.bincount(root[core], minlength=n).argmax()
            out |= np.where(core, root != star, (next_to < 0) | (root[next_to] != star))
        return out

    def add(self, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> None:
        n = len(self.ids)
        for k, e in enumerate(self.eps):
            at = d <= e
            x, y = i[at], j[at]
            cx, cy = self.core[k, x], self.core[k, y]
            join_roots(self.root[k], x[cx & cy], y[cx & cy])
            one = cx != cy  # a point that is not core has fewer than min_samples of these
            inner, edge = np.where(cx, x, y)[one], np.where(cx, y, x)[one]
            self.next_to[k, edge] = inner
            self.border[k].append(inner * n + edge)

    def compare(self, a: Points, b: Points, at_a: np.ndarray, at_b: np.ndarray, same: bool) -> None:
        """All pairs of a chunk with itself or of two chunks that can add
        something; ``at_a``, ``at_b``: their rows' numbers here."""
        for x, y in tiles(len(at_a), len(at_b), same):
            i, j, left = np.arange(x.start, x.stop), np.arange(y.start, y.stop), self.open()
            here, there = left[at_a[i]], left[at_b[j]]
            if not here.any() and not there.any():
                continue
            parts = [(i, j)]
            if here.mean() + there.mean() < 0.5:
                parts = [(i[here], j), (i[~here], j[there])]
            for p, q in parts:
                for r, c, d in a.near(b, p, q):
                    r, c = at_a[r], at_b[c]
                    if same and x == y:
                        once = r != c
                        r, c, d = r[once], c[once], d[once]
                    self.add(r, c, d)

    def borders(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of the star, row next to it), each once."""
        n = len(self.ids)
        inner, edge = np.divmod(np.concatenate([np.zeros(0, np.int64), *self.border[k]]), n)
        return np.divmod(np.unique(self.root[k][inner] * n + edge), n)


def _stars(pts: DataFrame, settings: list[Setting], metric: str, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """(id, core, root, next), (kind, param_id, a, b).

    First every chunk of points by itself: ``root`` is per setting the
    smallest id of a core point's star, ``next`` the stars that another point is next to.
    Then pairs of chunks, of which only what joins stars of different chunks
    leaves a task: stars a and b that are one, or a point b next to the star of a."""
    eps, every = [s.eps for s in settings], sorted({s.eps for s in settings})
    sizes = pts.agg(n_chunks(chunk_rows).alias("_k"))
    rows = pts.select("id", "vec", "core").crossJoin(F.broadcast(sizes))  # one row
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("_k")))

    def cores(pdf: pd.DataFrame) -> np.ndarray:
        return np.array(pdf["core"].tolist(), dtype=bool).reshape(len(pdf), len(settings)).T

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, n = pdf["id"].to_numpy(np.int64), len(pdf)
        s = Stars(ids, cores(pdf), eps, np.tile(np.arange(n), (len(settings), 1)))
        points, at = Points(pdf["vec"], every, metric), np.arange(n)
        s.compare(points, points, at, at, True)
        found = {}
        for k in range(len(settings)):
            for star, edge in zip(*s.borders(k)):
                found.setdefault(edge, [[] for _ in settings])[k].append(ids[star])
        none = [[] for _ in settings]
        return pdf.assign(root=list(ids[s.root].T), next=[found.get(r, none) for r in range(n)])

    def between(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, core = pdf["id"].to_numpy(np.int64), cores(pdf)
        # the first point of a star is in its chunk
        root = np.searchsorted(ids, np.array(pdf["root"].tolist(), dtype=np.int64).reshape(len(pdf), len(settings)).T)
        stars = [np.unique(r[c]) for r, c in zip(root, core)]
        s, lower = Stars(ids, core, eps, root), (pdf["chunk"] == pdf["bi"].iat[0]).to_numpy()
        a, b = (Points(pdf["vec"][side], every, metric) for side in (lower, ~lower))
        s.compare(a, b, np.flatnonzero(lower), np.flatnonzero(~lower), False)
        parts = []
        for k, setting in enumerate(settings):
            moved = stars[k][s.root[k][stars[k]] != stars[k]]
            star, edge = s.borders(k)
            parts += [(STAR, setting.param_id, ids[s.root[k][moved]], ids[moved]), (BORDER, setting.param_id, ids[star], ids[edge])]
        frames = [pd.DataFrame({"kind": kind, "param_id": p, "a": x, "b": y}) for kind, p, x, y in parts if len(x)]
        return pd.concat(frames) if frames else pd.DataFrame({"kind": [], "param_id": [], "a": [], "b": []}, dtype="int64")

    vec = pts.schema["vec"].dataType.simpleString()
    kept = f"id long, vec {vec}, core array<boolean>, _k long, chunk long, root array<bigint>, next array<array<bigint>>"
    rows = materialize(deal(rows, 0, "chunk").groupBy("chunk").applyInPandas(own, kept), "dbscan-chunks")
    cross = rows.drop("next").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))).where("other != chunk")
    cross = cross.withColumns({"bi": F.least("chunk", "other"), "bj": F.greatest("chunk", "other")}).drop("other", "_k")
    cross = deal(cross, 0, "bi", "bj").groupBy("bi", "bj").applyInPandas(between, "kind int, param_id int, a long, b long")
    return rows.select("id", "core", "root", "next"), materialize(cross, "dbscan-links")


def _joined(star: DataFrame) -> DataFrame:
    """(param_id, id, comp) of the stars (param_id, src, dst) of several chunks: in one
    group per setting, in rounds where one has more than ``RUN_EDGES``."""
    ends = star.select("param_id", F.explode(F.array("src", "dst")).alias("id")).distinct()
    most = star.groupBy("param_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most > RUN_EDGES:
        return components(materialize(ends, "dbscan-ends"), star, keys=["param_id"])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, at = np.unique(pdf[["src", "dst"]].to_numpy(np.int64), return_inverse=True)
        root = np.arange(len(ids))
        join_roots(root, *at.reshape(-1, 2).T)
        return pd.DataFrame({"param_id": pdf["param_id"].iat[0], "id": ids, "comp": ids[root]})

    return star.groupBy("param_id").applyInPandas(finish, "param_id int, id long, comp long")


def dbscan_grid(df: DataFrame, id_col: str, vec_col: str, settings: list[Setting],
                metric: str = "cosine", chunk_rows: int = BLOCK_ROWS) -> DataFrame:
    """(param_id, <id_col>, cluster) for every input row and setting."""
    pts, members = dedupe_points(df, id_col, vec_col)
    pts = materialize(pts, "dbscan-points")
    eps = sorted({s.eps for s in settings})
    weights = _neighbour_weights(pts, eps, metric, chunk_rows)
    is_core = F.array(*(F.col("weight") + F.col(f"w{eps.index(s.eps)}") >= s.min_samples for s in settings))
    pts = materialize(pts.join(weights, "id").select("id", "vec", is_core.alias("core")), "dbscan-core")
    pts, links = _stars(pts, settings, metric, chunk_rows)

    flags = F.array(*(F.struct(F.lit(s.param_id).alias("param_id"), F.get("core", F.lit(k)).alias("core"), F.get("root", F.lit(k)).alias("root"),
                               F.get("next", F.lit(k)).alias("next")) for k, s in enumerate(settings)))
    per = pts.select("id", F.inline(flags))
    joined = _joined(links.where(F.col("kind") == STAR).select("param_id", F.col("a").alias("src"), F.col("b").alias("dst")))
    core = per.where("core").select("param_id", "id", "root").join(joined.withColumnRenamed("id", "root"), ["param_id", "root"], "left")
    core = materialize(core.select("param_id", "id", F.coalesce("comp", "root").alias("comp")), "dbscan-comp")
    roots = with_position(core.where("id = comp").select("param_id", "comp"), ["param_id", "comp"])
    first = roots.groupBy("param_id").agg(F.min("pos").alias("first"))
    roots = roots.join(first, "param_id").select("param_id", "comp", (F.col("pos") - F.col("first")).alias("cluster"))
    core = materialize(core.join(roots, ["param_id", "comp"]).select("param_id", "id", "cluster"), "dbscan-labels")
    edges = links.where(F.col("kind") == BORDER).select("param_id", F.col("a").alias("id"), F.col("b").alias("of"))
    edges = edges.unionByName(per.select("param_id", F.explode("next").alias("id"), F.col("id").alias("of")))
    border = edges.join(core, ["param_id", "id"]).groupBy("param_id", F.col("of").alias("id")).agg(F.min("cluster").alias("cluster"))
    label = per.select("param_id", "id").join(core.unionByName(border), ["param_id", "id"], "left")
    label = label.withColumn("cluster", F.coalesce("cluster", F.lit(-1)).cast("long"))
    return members.join(label, "id").select("param_id", F.col("orig_id").alias(id_col), "cluster")


def dbscan(df: DataFrame, id_col: str, vec_col: str, eps: float, min_samples: int,
           metric: str = "cosine", chunk_rows: int = BLOCK_ROWS) -> DataFrame:
    """(<id_col>, cluster) for every input row."""
    g = dbscan_grid(df, id_col, vec_col, [Setting(0, eps, min_samples)], metric, chunk_rows)
    return g.select(id_col, "cluster")
