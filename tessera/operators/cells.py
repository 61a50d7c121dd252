"""Pivot cells: which points can be within a distance of which others.

At most ``MAX_CELLS`` rows, the first in a repeatable hash order, are pivots
(a bounded sample that only steers the work).  A point lives in the cell of
its nearest pivot; a cell's radius is its farthest point.  By the triangle
inequality a point x can have a neighbour within u in another cell only if
d(x, pivot) <= u + radius, and only then x visits that cell.  Cosine
distances are compared through unit vectors: |x - y|^2 = 2 (1 - cos).

Rows of a cell and its visitors are cut into chunks, and a group is one pair of
chunks, so no group grows with a cell.  Where the bounds exclude nothing
(high-dimensional vectors without clusters) every point visits every cell
and all pairs are compared, in blocks; ``compared`` tells how many are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

MAX_CELLS = 256
VISIT_ROWS = 8192  # copies that leave a task's Python at a time, not those of a whole batch
SLACK = 1e-9  # rounding of the bounds; the distance itself decides


def vectors_of(col: pd.Series, normalize: bool) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, 0))
    m = np.stack([np.asarray(v, dtype=np.float64) for v in col])
    if normalize:
        n = np.linalg.norm(m, axis=1, keepdims=True)
        m = np.divide(m, n, out=np.zeros_like(m), where=n > 0)
    return m


def distance_matrix(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return 1.0 - a @ b.T
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0.0))


def straight(d, metric: str):
    """A distance as Euclidean distance of the compared vectors.  (A zero vector
    has cosine distance 1 and Euclidean distance 1 or 0, which is below it.)"""
    return np.sqrt(np.maximum(2.0 * np.asarray(d, float), 0.0)) if metric == "cosine" else np.asarray(d, float)


def to_pivots(vec: pd.Series, pivots: np.ndarray, metric: str) -> np.ndarray:
    m = vectors_of(vec, metric == "cosine")
    return distance_matrix(m, pivots, "euclidean") if len(m) else np.zeros((0, len(pivots)))


def copies(pdf: pd.DataFrame, near: np.ndarray, rows: int = VISIT_ROWS) -> Iterator[pd.DataFrame]:
    """(id, vec, cell) of the points with each cell they visit, in frames of at
    most ``rows``: a point can visit all cells."""
    i, c = np.nonzero(near)
    ids, vecs = pdf["id"].to_numpy(), pdf["vec"].to_numpy()
    for s in range(0, max(1, len(i)), rows):
        at = i[s:s + rows]
        yield pd.DataFrame({"id": ids[at], "vec": vecs[at], "cell": c[s:s + rows].astype(np.int32)})


class Cells:
    """Points (id, vec, cell) of a table, with the pivots and radii."""

    def __init__(self, df: DataFrame, metric: str, chunk_rows: int, n_rows: int | None = None):
        self.metric, self.chunk_rows = metric, chunk_rows
        n = df.count() if n_rows is None else n_rows
        k = max(1, min(MAX_CELLS, -(-n // chunk_rows)))
        self.pivots, self.radius, self.sizes = np.zeros((0, 0)), np.zeros(1), np.array([n])
        if k == 1:  # one chunk: there is nothing to exclude
            self.rows = df.withColumn("cell", F.lit(0))
            return
        first = df.orderBy(F.xxhash64("id"), "id").limit(k).collect()
        self.pivots = pivots = vectors_of(pd.Series([r["vec"] for r in first]), metric == "cosine")

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                d = to_pivots(pdf["vec"], pivots, metric)
                yield pdf.assign(cell=d.argmin(axis=1).astype(np.int32), r=d.min(axis=1))

        vec = df.schema["vec"].dataType.simpleString()
        rows = materialize(df.mapInPandas(assign, f"id long, vec {vec}, cell int, r double"), "cells")
        self.radius = np.full(k, -np.inf)  # an empty cell is never visited
        self.sizes = np.zeros(k, np.int64)
        for r in rows.groupBy("cell").agg(F.max("r").alias("r"), F.count("*").alias("n")).collect():  # at most MAX_CELLS rows
            self.radius[r["cell"]], self.sizes[r["cell"]] = r["r"], r["n"]
        self.rows = rows.drop("r")

    def chunked(self, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, parts) per cell: the numbers of the chunks of about ``rows``
        rows that hold it.  Near cells share a chunk, a larger cell has
        several of its own."""
        k, at = len(self.sizes), 0
        order = [0]
        if len(self.pivots):
            near = distance_matrix(self.pivots, self.pivots, "euclidean")
            while len(order) < k:  # each cell is followed by the nearest that is left
                near[:, order[-1]] = np.inf
                order.append(int(near[order[-1]].argmin()))
        first, parts, held = np.zeros(k, np.int32), np.ones(k, np.int32), 0
        for c in order:
            n = int(self.sizes[c])
            if held and held + n > rows:
                at, held = at + 1, 0
            first[c], parts[c] = at, max(1, -(-n // rows))
            at, held = (at + int(parts[c]), 0) if parts[c] > 1 else (at, held + n)
        return first, parts

    def visitors(self, reach: float, upward: bool = False) -> DataFrame | None:
        """(id, vec, cell): points with the other cells they visit within
        ``reach``; ``upward`` leaves out cells of smaller number, for pairs
        that count once."""
        if not len(self.pivots):
            return None
        vec = self.rows.schema["vec"].dataType.simpleString()
        pivots, radius, metric = self.pivots, self.radius, self.metric

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                near = to_pivots(pdf["vec"], pivots, metric) <= straight(reach, metric) + radius[None, :] + SLACK
                own = pdf["cell"].to_numpy()
                other = np.arange(len(pivots))[None, :]
                near &= other > own[:, None] if upward else other != own[:, None]
                yield from copies(pdf, near)

        return self.rows.mapInPandas(visit, f"id long, vec {vec}, cell int")

    def compared(self, visitors: DataFrame | None) -> int:
        """Number of pairs that the blocks compare."""
        home = self.rows.groupBy("cell").agg(F.count("*").alias("h"))
        if visitors is None:
            return home.agg(F.sum(F.col("h") * (F.col("h") - 1) / 2).cast("long")).first()[0] or 0
        both = home.join(visitors.groupBy("cell").agg(F.count("*").alias("v")), "cell", "left")
        pairs = F.col("h") * (F.col("h") - 1) / 2 + F.col("h") * F.coalesce("v", F.lit(0))
        return both.agg(F.sum(pairs).cast("long")).first()[0] or 0

    def blocks(self, visitors: DataFrame | None, fn: Callable, schema: str) -> DataFrame:
        """``fn(left, right, mode)`` on every pair of chunks: ``same`` and
        ``home`` within a cell, ``visit`` with the visitors on the left."""
        chunks = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count("*") / self.chunk_rows).alias(name))
        upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
        home = self.rows.select("id", "vec", "cell").join(chunks(self.rows, "hk"), "cell")
        home = home.withColumn("own", F.pmod(F.xxhash64("id"), F.col("hk")))
        cols = ["cell", "visit", "bi", "bj", "guest", "own", "id", "vec"]
        rows = home.withColumn("o", F.explode(upto("hk"))).withColumns(
            {"bi": F.least("own", "o"), "bj": F.greatest("own", "o"), "visit": F.lit(False), "guest": F.lit(False)}).select(*cols)
        if visitors is not None:
            visitors = materialize(visitors, "cell-visitors")
            vk = chunks(visitors, "vk")
            host = home.join(vk, "cell").withColumn("bj", F.explode(upto("vk"))).withColumn("bi", F.col("own"))
            guest = visitors.join(vk, "cell").join(chunks(self.rows, "hk"), "cell")
            guest = guest.withColumn("own", F.pmod(F.xxhash64("id"), F.col("vk"))).withColumn("bi", F.explode(upto("hk")))
            guest = guest.withColumn("bj", F.col("own"))
            for df, is_guest in ((host, False), (guest, True)):
                rows = rows.unionByName(df.withColumns({"visit": F.lit(True), "guest": F.lit(is_guest)}).select(*cols))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            if pdf["visit"].iat[0]:
                return fn(pdf[pdf["guest"]], pdf[~pdf["guest"]], "visit")
            bi, bj = pdf["bi"].iat[0], pdf["bj"].iat[0]
            if bi == bj:
                return fn(pdf, pdf, "same")
            return fn(pdf[pdf["own"] == bi], pdf[pdf["own"] == bj], "home")

        return rows.groupBy("cell", "visit", "bi", "bj").applyInPandas(run, schema)
