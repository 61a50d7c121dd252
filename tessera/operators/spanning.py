"""Minimum spanning trees of mutual-reachability distances.

Every pair of points lies in one block (two chunks of a key's rows, or one
chunk with itself).  A block keeps only its own spanning forest: by the
cycle property an edge outside it is in no tree of the whole.  So one
pass over the blocks leaves at most 2 * chunk edges of each block, and Borůvka
rounds over this sparse edge table give the tree: per component the
smallest outgoing edge, then only the edges between components are rewritten.

Edges are ordered by (weight, src, dst), which makes the tree unique.
Distances are summed dimension by dimension, so a pair has the same double in
every block and both directions.  A matrix product has not: it only chooses the
pairs that can be in the tree or among a point's nearest, within its rounding.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.graph import components
from tessera.session import materialize

CHUNK_ROWS = 16384  # most rows of a chunk: every row is copied once per chunk of its key
TILE_ROWS = 2048    # a task compares its two chunks in tiles of this many rows
PAIR_ROWS = 1 << 16  # pairs whose distances are summed at a time
RUN_EDGES = 1 << 20  # edges that one task may finish
SPREAD = 16         # chunks of a key that has rows for as many tiles, so that there are groups for all cores


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows divided by their norms; zero rows stay."""
    norm = np.zeros(len(m))
    for j in range(m.shape[1]):
        norm += m[:, j] * m[:, j]
    norm = np.sqrt(norm)[:, None]
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distance matrix, summed in the order of the dimensions."""
    out = np.zeros((len(a), len(b)))
    if metric == "cosine":
        for j in range(a.shape[1]):
            out += a[:, j, None] * b[None, :, j]
        return np.maximum(1.0 - out, 0.0)
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        out += gap * gap
    return np.sqrt(out)


def matrix(col: pd.Series, metric: str) -> np.ndarray:
    m = np.array(col.tolist(), dtype=np.float64).reshape(len(col), -1)
    return unit_rows(m) if metric == "cosine" else m


def n_chunks(chunk_rows: int):
    """Number of chunks of a group's rows, as an aggregate."""
    n = F.count("*")
    return F.greatest(F.ceil(n / chunk_rows), F.least(F.lit(SPREAD).cast("long"), F.ceil(n / TILE_ROWS)))


def deal(rows: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Groups of few bytes and much work, in tasks of their own."""
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, min(groups, 4096))
    return rows.repartition(tasks, *keys)


def keyed_block_pairs(df: DataFrame, keys: list[str], id_col: str, fn: Callable, schema: str,
                      chunk_rows: int = CHUNK_ROWS, dealt: bool = False) -> DataFrame:
    """``fn(left, right, same)`` on every pair of chunks of each key; no chunk has
    more than about ``chunk_rows`` rows, so no group grows with a key.  ``dealt``
    keeps the groups apart in tasks of their own where few bytes mean much work."""
    sizes = df.groupBy(*keys).agg(n_chunks(chunk_rows).alias("_k"))
    own = F.pmod(F.xxhash64(id_col), F.col("_k"))
    rows = (df.join(sizes, keys) if keys else df.crossJoin(F.broadcast(sizes))).withColumn("_own", own)  # without keys one row
    rows = rows.withColumn("_to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)))
    rows = rows.withColumn("_bi", F.least("_own", "_to")).withColumn("_bj", F.greatest("_own", "_to")).drop("_to", "_k")
    if dealt:
        rows = deal(rows, 0, *keys, "_bi", "_bj")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bi, bj = pdf["_bi"].iat[0], pdf["_bj"].iat[0]
        if bi == bj:
            return fn(pdf, pdf, True)
        return fn(pdf[pdf["_own"] == bi], pdf[pdf["_own"] == bj], False)

    return rows.groupBy(*keys, "_bi", "_bj").applyInPandas(run, schema)


def tiles(n_left: int, n_right: int, same: bool, rows: int = TILE_ROWS):
    """(slice, slice) of two chunks; of a chunk with itself the upper triangle."""
    for i in range(0, n_left, rows):
        for j in range(i if same else 0, n_right, rows):
            yield slice(i, min(i + rows, n_left)), slice(j, min(j + rows, n_right))


def pair_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Row-wise distances, with the doubles of ``distances``: a running sum adds
    in the order of the dimensions."""
    out = np.zeros(len(a))
    if not a.shape[1]:
        return out if metric != "cosine" else out + 1.0
    for s in range(0, len(a), 1024):  # rows that stay near the processor
        at = slice(s, s + 1024)
        part = a[at] * b[at] if metric == "cosine" else a[at] - b[at]
        if metric != "cosine":
            part *= part
        out[at] = np.add.accumulate(part, axis=1)[:, -1]
    return np.maximum(1.0 - out, 0.0) if metric == "cosine" else np.sqrt(out)


def true_at(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of a sparse mask, eight places at a time."""
    flat = np.ascontiguousarray(mask).ravel()
    whole = len(flat) // 8 * 8
    some = np.flatnonzero(flat[:whole].view(np.uint64)) * 8
    at = (some[:, None] + np.arange(8)[None, :]).ravel()
    at = at[flat[at]]
    return at if whole == len(flat) else np.concatenate([at, np.flatnonzero(flat[whole:]) + whole])


def leveled(d, metric: str):
    """Distances on the scale of ``near_levels``."""
    return np.asarray(d, float) if metric == "cosine" else np.square(np.asarray(d, float))


def near_levels(a: np.ndarray, b: np.ndarray, metric: str) -> tuple[np.ndarray, float]:
    """(distances, squared unless cosine, by a matrix product; bound of their
    rounding).  They choose pairs, ``pair_distances`` of these are the result."""
    dot = a @ b.T
    if metric == "cosine":
        return np.maximum(np.subtract(1.0, dot, out=dot), 0.0, out=dot), 1e-12
    na, nb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    dot *= -2.0
    dot += na[:, None]
    dot += nb[None, :]
    return np.maximum(dot, 0.0, out=dot), 1e-12 * (na.max() + nb.max())


def core_distances(points: DataFrame, k: int, metric: str = "euclidean", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(id, core): distance to the k-th nearest point, the point itself being
    the first; the farthest point where there are fewer."""

    def merged(near: np.ndarray, row: np.ndarray, d: np.ndarray) -> None:
        """The k smallest of each row's kept distances and new ones."""
        touched = np.unique(row)
        row = np.concatenate([np.repeat(touched, k), row])
        d = np.concatenate([near[touched].ravel(), d])
        order = np.lexsort((d, row))
        row, d = row[order], d[order]
        first = np.searchsorted(row, touched)
        near[touched] = d[first[:, None] + np.arange(k)[None, :]]

    def fn(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        a = matrix(left["vec"], metric)
        b = a if same else matrix(right["vec"], metric)
        near_a = np.full((len(a), k), np.inf)
        near_b = near_a if same else np.full((len(b), k), np.inf)
        for x, y in tiles(len(a), len(b), same):
            level, slack = near_levels(a[x], b[y], metric)
            diagonal = same and x == y
            if diagonal:
                np.fill_diagonal(level, 0.0)
            mask = np.zeros(level.shape, bool)
            for values, hits, kept in ((level, mask, near_a[x]), (level.T, mask.T, near_b[y]))[:1 if diagonal else 2]:
                limit = leveled(kept[:, -1], metric)
                if not np.isfinite(limit).all():
                    kk = min(k, values.shape[1])
                    limit = np.minimum(limit, np.partition(values, kk - 1, axis=1)[:, kk - 1] if kk == k else np.inf)
                hits |= values <= (limit + 4 * slack)[:, None]
            i, j = np.divmod(np.flatnonzero(mask.ravel()), mask.shape[1])
            d = pair_distances(a[x][i], b[y][j], metric)
            if diagonal:
                d[i == j] = 0.0
            merged(near_a, i + x.start, d)
            if not diagonal:
                merged(near_b, j + y.start, d)
        ids, near = (left["id"], near_a) if same else (pd.concat([left["id"], right["id"]]), np.concatenate([near_a, near_b]))
        return pd.DataFrame({"id": ids.to_numpy(np.int64), "near": [v[np.isfinite(v)].tolist() for v in near]})

    near = keyed_block_pairs(points.select("id", "vec"), [], "id", fn, "id long, near array<double>", chunk_rows, dealt=True)
    # k values per chunk and point
    smallest = F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k)
    return near.groupBy("id").agg(smallest.alias("near")).select("id", F.element_at("near", -1).alias("core"))


def join_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the groups of i and j; ``root`` holds each row's smallest row."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def sparse_forest(n: int, i: np.ndarray, j: np.ndarray, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the edges of the minimum spanning forest, roots of the n
    vertices) of a list of edges between points x and y, ordered by (w, smaller
    id, larger id)."""
    order = np.lexsort((np.maximum(x, y), np.minimum(x, y), w))
    i, j = i[order], j[order]
    root, live, kept = np.arange(n), np.arange(len(order)), [np.zeros(0, np.int64)]
    while True:
        x, y = root[i[live]], root[j[live]]
        apart = x != y
        live, x, y = live[apart], x[apart], y[apart]
        if not len(live):
            return order[np.concatenate(kept)], root
        best = np.full(n, len(order))
        np.minimum.at(best, x, live)
        np.minimum.at(best, y, live)
        chosen = np.unique(best[best < len(order)])
        kept.append(chosen)
        join_roots(root, i[chosen], j[chosen])


def tile_forest(ids: np.ndarray, vec: np.ndarray, core: np.ndarray, left: np.ndarray, right: np.ndarray,
                same: bool, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, w): minimum spanning forest of the pairs between two tiles, given
    as row numbers (``same``: of one tile).  The light pairs come first, in one
    list; then the components other than the largest look for their smallest
    edges (Borůvka)."""
    a, b, ca, cb = vec[left], vec[right], core[left], core[right]
    level, slack = near_levels(a, b, metric)
    slack *= 4
    np.maximum(level, leveled(ca, metric)[:, None], out=level)
    np.maximum(level, leveled(cb, metric)[None, :], out=level)
    if same:
        np.fill_diagonal(level, np.inf)
    weight = lambda i, j: np.maximum(pair_distances(a[i], b[j], metric), np.maximum(ca[i], cb[j]))
    n = len(left) if same else len(left) + len(right)
    shift = 0 if same else len(left)
    own = ids[left] if same else np.concatenate([ids[left], ids[right]])
    root = np.arange(n)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if level.size > 1 << 16:
        limit = np.quantile(level[::16, ::16], min(1.0, 8.0 * n / level.size))
        i, j = np.divmod(true_at(level <= limit + slack), level.shape[1])
        if same:
            once = i < j
            i, j = i[once], j[once]
        w = weight(i, j)
        light = leveled(w, metric) <= limit  # all pairs up to a weight, none beyond
        i, j, w = i[light], j[light], w[light]
        at, root = sparse_forest(n, i, j + shift, w, own[i], own[j + shift])
        found.append((i[at], j[at], w[at]))
    while len(level) and level.shape[1]:
        big = np.bincount(root).argmax()
        rows, cols = np.flatnonzero(root[:len(left)] != big), np.flatnonzero(root[shift:] != big)
        if not len(rows) and not len(cols):
            break
        ends = []
        for side, values, mine, other in ((rows, level, root[:len(left)], root[shift:]), (cols, level.T, root[shift:], root[:len(left)]))[:1 if same else 2]:
            for start in range(0, len(side), 256):
                at = side[start:start + 256]
                sub = values[at]
                sub[mine[at][:, None] == other[None, :]] = np.inf
                r, c = np.nonzero((sub <= sub.min(axis=1)[:, None] + slack) & np.isfinite(sub))
                ends.append((at[r], c, mine[at[r]]) if values is level else (c, at[r], mine[at[r]]))
        i, j, comp = (np.concatenate(x) for x in zip(*ends))
        if not len(i):
            break
        w = weight(i, j)
        x, y = own[i], own[j + shift]
        order = np.lexsort((np.maximum(x, y), np.minimum(x, y), w, comp))
        first = order[np.unique(comp[order], return_index=True)[1]]
        pair = np.unique(np.stack([np.minimum(i[first], j[first]), np.maximum(i[first], j[first])]) if same
                         else np.stack([i[first], j[first]]), axis=1)
        i, j = pair
        found.append((i, j, weight(i, j)))
        join_roots(root, i, j + shift)
    i, j, w = (np.concatenate(x) for x in zip(*found))
    return left[i], right[j], w


def spanning_tree(points: DataFrame, keys: list[str] | None = None, metric: str = "euclidean",
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(keys, src, dst, w): the tree of every key's points (keys, id, vec,
    core) under max(core, core, distance); src < dst."""
    keys = keys or []

    def fn(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        rows = left if same else pd.concat([left, right])
        ids, core, vec = rows["id"].to_numpy(np.int64), rows["core"].to_numpy(np.float64), matrix(rows["vec"], metric)
        n, m = len(rows), len(left)
        at, shift = np.arange(n), 0 if same else m
        i, j, w = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        # only the pairs between the chunks: those inside have a block of their own
        for x, y in tiles(m, n - shift, same):
            more = tile_forest(ids, vec, core, at[x], at[shift:][y], same and x == y, metric)
            i, j, w = (np.concatenate(both) for both in zip((i, j, w), more))
            if len(i) > 8 * n:
                i, j, w = (c[sparse_forest(n, i, j, w, ids[i], ids[j])[0]] for c in (i, j, w))
        kept = sparse_forest(n, i, j, w, ids[i], ids[j])[0]
        i, j, w = i[kept], j[kept], w[kept]
        out = pd.DataFrame({"src": np.minimum(ids[i], ids[j]), "dst": np.maximum(ids[i], ids[j]), "w": w})
        for c in reversed(keys):
            out.insert(0, c, left[c].iat[0] if len(left) else right[c].iat[0])
        return out

    of_key = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in points.schema.fields if f.name in keys)
    order = [x.split()[0] for x in of_key.split(", ") if x]
    cols = [*order, "id", "vec", "core"]
    found = keyed_block_pairs(points.select(*cols), order, "id", fn, of_key + "src long, dst long, w double", chunk_rows, dealt=True)
    found = materialize(found, "span-blocks")
    if points.groupBy(*keys).agg(n_chunks(chunk_rows).alias("k")).where("k > 1").isEmpty():
        return found  # one block per key: its tree is the tree
    return _boruvka(found, order)


def _boruvka(edges: DataFrame, keys: list[str]) -> DataFrame:
    """The minimum spanning forest of an edge table: rounds until no key has more
    than ``RUN_EDGES`` edges between components, one group of a key ends it."""
    of_key = "".join(f"{c} {edges.schema[c].dataType.simpleString()}, " for c in keys)
    cols = [*keys, "src", "dst", "w"]

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        ends, at = np.unique(pdf[["a", "b"]].to_numpy(np.int64), return_inverse=True)
        i, j = at.reshape(-1, 2).T
        found, _ = sparse_forest(len(ends), i, j, pdf["w"].to_numpy(), pdf["src"].to_numpy(), pdf["dst"].to_numpy())
        return pdf.iloc[found][cols]

    left = edges.select(*keys, F.col("src").alias("a"), F.col("dst").alias("b"), "w", "src", "dst")
    tree = None
    while True:
        most = left.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= RUN_EDGES:
            last = (deal(left, 0, *keys) if keys else left).groupBy(*(keys or [F.lit(0).alias("_all")])).applyInPandas(finish, of_key + "src long, dst long, w double")
            return materialize(last if tree is None else tree.unionByName(last), "span-tree")
        turned = left.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"), "w", "src", "dst")
        both = left.select(*keys, "a", "b", "w", "src", "dst").unionByName(turned)
        best = both.groupBy(*keys, "a").agg(F.min(F.struct("w", "src", "dst", "b")).alias("e"))
        best = materialize(best.select(*keys, "a", "e.*"), "span-best")
        chosen = best.select(*keys, "src", "dst", "w").distinct()
        tree = chosen if tree is None else tree.unionByName(chosen)
        label = components(best.select(*keys, F.col("a").alias("id")),
                           best.select(*keys, F.col("a").alias("src"), F.col("b").alias("dst")), keys=keys)
        name = lambda c: label.select(*keys, F.col("id").alias(c), F.col("comp").alias(f"new_{c}"))
        left = left.join(name("a"), [*keys, "a"]).join(name("b"), [*keys, "b"]).where("new_a != new_b")
        pair = [F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")]
        # of parallel edges between two components only the smallest can be in the tree
        left = left.select(*keys, *pair, F.struct("w", "src", "dst").alias("e")).groupBy(*keys, "a", "b").agg(F.min("e").alias("e"))
        left = materialize(left.select(*keys, "a", "b", "e.*"), "span-left")
