"""Vector neighbour search (J9, J10, V3, V8) over pivot cells.

Pairs within a distance: a point visits the cells that the distance can
reach.  Each block is one float64 matrix product, only the pairs that pass leave
the task.

Top-k packs near cells into chunks and takes two passes: the k best of a point's
own chunk bound how far its neighbours can be, then pairs of chunks that one of
their points can reach are compared, in tiles that the bound leaves.  A row is
copied once per other chunk, not per cell, and a row's k best leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cells import SLACK, Cells, distance_matrix, straight, to_pivots, vectors_of
from tessera.operators.spanning import PAIR_ROWS, SPREAD, deal, matrix, pair_distances, true_at
from tessera.session import materialize

EDGE_SCHEMA = "src long, dst long, dist double"


def _points(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))


def _block(left: pd.DataFrame, right: pd.DataFrame, mode: str, metric: str):
    """(ids, ids, distances) of two chunks."""
    a = vectors_of(left["vec"], metric == "cosine")
    b = a if mode == "same" else vectors_of(right["vec"], metric == "cosine")
    d = distance_matrix(a, b, metric) if len(a) and len(b) else np.zeros((len(a), len(b)))
    return left["id"].to_numpy(np.int64), right["id"].to_numpy(np.int64), d


def eps_edges(df: DataFrame, id_col: str, vec_col: str, eps: float, metric: str = "cosine",
              chunk_rows: int = 2048, n_rows: int | None = None) -> DataFrame:
    """Undirected pairs (src < dst) within distance ``eps``."""

    def fn(left: pd.DataFrame, right: pd.DataFrame, mode: str) -> pd.DataFrame:
        ia, ib, d = _block(left, right, mode, metric)
        mask = d <= eps
        if mode == "same":
            mask &= ia[:, None] < ib[None, :]
        r, c = np.nonzero(mask)
        x, y = ia[r], ib[c]
        return pd.DataFrame({"src": np.minimum(x, y), "dst": np.maximum(x, y), "dist": d[r, c]})

    cells = Cells(_points(df, id_col, vec_col), metric, chunk_rows, n_rows)
    return cells.blocks(cells.visitors(eps, upward=True), fn, EDGE_SCHEMA)


class Nearest:
    """The ``k`` nearest rows of two chunks of points, tile by tile.

    A product of the vectors (for cosine in single precision) only chooses
    pairs, within its rounding; ``pair_distances`` of these decide, so a pair has
    the same distance in every block.  ``limit`` bounds what can still be
    among a row's nearest: tiles out of reach by the pivots are not compared.
    """

    def __init__(self, rows: pd.DataFrame, k: int, metric: str, pivots: np.ndarray, radius: np.ndarray, tile: int):
        rows = rows.iloc[np.argsort(rows["cell"].to_numpy(), kind="stable")]
        self.k, self.metric, self.tile, n = k, metric, tile, len(rows)
        self.rows, self.ids, self.cell = rows, rows["id"].to_numpy(np.int64), rows["cell"].to_numpy()
        self.vec = matrix(rows["vec"], metric)
        self.fast = self.vec.astype(np.float32) if metric == "cosine" else self.vec
        with np.errstate(over="ignore", invalid="ignore"):
            self.half = np.einsum("ij,ij->i", self.vec, self.vec) / 2
        self.limit = rows["reach"].to_numpy(float).copy()
        self.dist, self.nb = np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max)
        self.new: dict[int, list] = {}  # by tile, not merged yet
        self.pivots, self.radius = pivots, radius
        self.slices = [slice(s, min(s + tile, n)) for s in range(0, n, tile)]

    def out_of(self, other: "Nearest") -> np.ndarray:
        """Smallest (straight) distance that each row can have to the rows of each tile of ``other``."""
        if not len(self.pivots):
            return np.zeros((len(self.ids), len(other.slices)))
        cells = np.unique(other.cell)
        least = distance_matrix(self.vec, self.pivots[cells], "euclidean") - self.radius[cells][None, :]
        at = np.searchsorted(cells, other.cell)
        return np.stack([least[:, at[s.start]:at[s.stop - 1] + 1].min(axis=1) for s in other.slices], axis=1)

    def within(self, part: slice, least: np.ndarray) -> np.ndarray:
        """Rows of a tile that can have a nearest row at ``least``; what a comparison can't tell is within."""
        return np.flatnonzero(~(straight(self.limit[part], self.metric) + SLACK < least)) + part.start

    def add(self, t: int, row: np.ndarray, d: np.ndarray, nb: np.ndarray) -> None:
        held = self.new.setdefault(t, [])
        held.append((row, d, nb))
        part = self.slices[t]
        if sum(len(x[0]) for x in held) * 2 >= self.k * (part.stop - part.start) or not np.isfinite(self.limit[part]).all():
            self.merge(t)

    def merge(self, t: int) -> None:
        """The k best of the kept rows of a tile and the new ones, by (distance, id)."""
        if not (held := self.new.pop(t, None)):
            return
        row, d, nb = (np.concatenate(x) for x in zip(*held))
        touched = np.unique(row)
        row = np.concatenate([np.repeat(touched, self.k), row])
        d, nb = np.concatenate([self.dist[touched].ravel(), d]), np.concatenate([self.nb[touched].ravel(), nb])
        order = np.lexsort((nb, d, row))
        row, d, nb = row[order], d[order], nb[order]
        at = np.searchsorted(row, touched)[:, None] + np.arange(self.k)[None, :]
        self.dist[touched], self.nb[touched] = d[at], nb[at]
        self.limit[touched] = np.minimum(self.limit[touched], self.dist[touched, -1])

    def compare(self, other: "Nearest", x: int, y: int, least_x: np.ndarray, least_y: np.ndarray) -> None:
        """Tile ``x`` of the rows with tile ``y`` of the other's, for both sides; a tile with itself for one."""
        px, py, itself = self.slices[x], other.slices[y], self is other and x == y
        i, j = self.within(px, least_x[px, y]), other.within(py, least_y[py, x])
        if not len(i) and not len(j):
            return
        if len(i):  # all rows of the side that the other side's rows need
            j = np.arange(py.start, py.stop)
        if itself or len(other.within(py, least_y[py, x])):
            i = np.arange(px.start, px.stop)
        with np.errstate(over="ignore", invalid="ignore"):
            close = self.fast[i] @ other.fast[j].T
            dim = self.vec.shape[1]
            if self.metric == "cosine":
                slack = (dim + 4) * 2.0**-23
                floor = lambda s, at: (1.0 - s.limit[at] - slack).astype(np.float32)
            else:
                close -= self.half[i][:, None]
                close -= other.half[j][None, :]
                slack = (dim + 4) * 2.0**-50 * (self.half[i].max() + other.half[j].max())
                floor = lambda s, at: -np.square(s.limit[at]) / 2 - slack

            def lowest(s: Nearest, at: np.ndarray, o: Nearest, of: np.ndarray, c: np.ndarray) -> np.ndarray:
                """What a row's nearest reach at least; rows that have less than k so far look at their k best here."""
                least, few = floor(s, at), np.flatnonzero(~np.isfinite(s.limit[at]))
                if len(few) and c.shape[1] > s.k:
                    part = c[few]
                    part[(s.ids[at[few]][:, None] == o.ids[of][None, :]) | np.isnan(part)] = -np.inf
                    least[few] = np.partition(part, -s.k, axis=1)[:, -s.k] - 2 * slack
                return least

            mask = close >= lowest(self, i, other, j, close)[:, None]
            if not itself:
                mask |= close >= lowest(other, j, self, i, close.T)[None, :]
        r, c = np.divmod(true_at(mask), mask.shape[1])
        for s in range(0, len(r), PAIR_ROWS):
            a, b = i[r[s:s + PAIR_ROWS]], j[c[s:s + PAIR_ROWS]]
            d = pair_distances(self.vec[a], other.vec[b], self.metric)
            ok = np.isfinite(d) & (self.ids[a] != other.ids[b])
            a, b, d = a[ok], b[ok], d[ok]
            for side, t, row, nb in ((self, x, a, other.ids[b]), (other, y, b, self.ids[a]))[:1 if itself else 2]:
                good = d <= side.limit[row]
                if good.any():
                    side.add(t, row[good], d[good], nb[good])

    def found(self) -> tuple[list, list]:
        """(distances, ids) of every row's nearest so far."""
        for t in list(self.new):
            self.merge(t)
        n = np.isfinite(self.dist).sum(axis=1)
        return [v[:m] for v, m in zip(self.dist, n)], [v[:m] for v, m in zip(self.nb, n)]


def topk_neighbours(df: DataFrame, id_col: str, vec_col: str, k: int, metric: str = "cosine",
                    chunk_rows: int = 2048, n_rows: int | None = None, group_rows: int | None = None) -> DataFrame:
    """(id, nb, dist, rank) for the k nearest other rows of each row; ties by
    neighbour id.  Chunks of near cells have about ``group_rows`` rows (32 tiles of
    ``chunk_rows``, fewer where there would be too few chunks for all cores)."""
    points = _points(df, id_col, vec_col).where("id is not null")
    n = points.count() if n_rows is None else n_rows
    cells = Cells(points, metric, chunk_rows, n)
    if group_rows is None:
        group_rows = max(chunk_rows, min(32 * chunk_rows, -(-n // SPREAD)))
    first, parts = cells.chunked(group_rows)
    pivots, radius = cells.pivots, cells.radius
    vec = cells.rows.schema["vec"].dataType.simpleString()
    side = lambda pdf: Nearest(pdf, k, metric, pivots, radius, chunk_rows)
    found = "dist array<double>, nb array<bigint>"

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        s = side(pdf)
        least = s.out_of(s)
        for gap in range(len(s.slices)):  # a tile with itself and the nearest cells first
            for x in range(len(s.slices) - gap):
                s.compare(s, x, x + gap, least, least)
        dist, nb = s.found()
        return s.rows.assign(reach=s.limit, dist=dist, nb=nb)

    def between(pdf: pd.DataFrame) -> pd.DataFrame:
        lower = pdf["chunk"] == pdf["bi"].iat[0]
        a, b = side(pdf[lower]), side(pdf[~lower])
        least_a, least_b = a.out_of(b), b.out_of(a)
        for x in range(len(a.slices)):
            for y in range(len(b.slices)):
                a.compare(b, x, y, least_a, least_b)
        out = pd.DataFrame({"id": np.concatenate([a.ids, b.ids])})
        out["dist"], out["nb"] = (p + q for p, q in zip(a.found(), b.found()))
        return out[out["dist"].str.len() > 0]

    chunk = F.lit(0)
    if len(pivots):
        place = lambda values: F.get(F.array(*[F.lit(int(v)) for v in values]), F.col("cell"))
        chunk = (place(first) + F.pmod(F.xxhash64("id"), place(parts))).cast("int")
    rows = cells.rows.select("id", "vec", "cell", chunk.alias("chunk"), F.lit(float("inf")).alias("reach"))
    n_chunks = int((first + parts).max()) if len(pivots) else 1
    kept = f"id long, vec {vec}, cell int, chunk int, reach double, "
    rows = deal(rows, n_chunks, "chunk").groupBy("chunk").applyInPandas(own, kept + found)
    best = rows.select("id", "dist", "nb")
    if n_chunks > 1:
        rows = materialize(rows, "knn-own")
        held = pd.DataFrame([(c, f + p) for c, (f, m) in enumerate(zip(first, parts)) for p in range(m)], columns=["cell", "chunk"])

        def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                u = straight(pdf["reach"].to_numpy(float), metric)
                with np.errstate(invalid="ignore"):  # infinite reach, empty cell
                    near = ~(to_pivots(pdf["vec"], pivots, metric) > u[:, None] + radius[None, :] + SLACK)
                i, c = np.nonzero(near)
                pairs = pd.DataFrame({"chunk": pdf["chunk"].to_numpy()[i], "cell": c}).drop_duplicates()
                pairs = pairs.merge(held.rename(columns={"chunk": "other"}), on="cell")[["chunk", "other"]]
                yield pairs[pairs["chunk"] != pairs["other"]].drop_duplicates()

        met = rows.select("vec", "chunk", "reach").mapInPandas(visits, "chunk int, other int")
        met = materialize(met.union(met.select("other", "chunk")).distinct(), "knn-chunks")  # pairs of chunks, both ways
        bi, bj = F.least("chunk", "other").alias("bi"), F.greatest("chunk", "other").alias("bj")
        cross = rows.select("id", "vec", "cell", "chunk", "reach").join(met, "chunk").select("id", "vec", "cell", "chunk", "reach", bi, bj)
        cross = deal(cross, n_chunks * (n_chunks - 1) // 2, "bi", "bj").groupBy("bi", "bj").applyInPandas(between, "id long, " + found)
        best = rows.select("id", "dist", "nb").unionByName(cross)
    best = best.groupBy("id").agg(F.flatten(F.collect_list(F.arrays_zip("dist", "nb"))).alias("near"))  # k of each chunk
    best = best.select("id", F.posexplode(F.slice(F.sort_array("near"), 1, k)).alias("at", "near"))
    return best.select("id", F.col("near.nb").alias("nb"), F.col("near.dist").alias("dist"), (F.col("at") + 1).alias("rank"))

