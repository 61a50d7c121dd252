"""Fuzzy name matching.

* ``pair_scores``     - the three ratios of two name columns, per row (expressions).
* ``fuzzy_pairs``     - every pair of distinct names with combined score
  >= threshold, mirrored, plus the self pair (score 100): the sparse
  form of the n x n score matrix.  Names meet under the keys of ``namekeys``,
  which lose no pair; the names of one key are compared in bounded blocks.
* ``greedy_anchors``  - the queue clustering: in name order, a name is an
  anchor unless an earlier anchor matches it; a member joins the first
  (earliest) anchor that matches it.  Solved per component of the match graph.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.fuzzy import token_set_ratio, token_sort_ratio
from tessera.functions.ratios import pair_scores
from tessera.operators.graph import components
from tessera.operators.namekeys import key_rows
from tessera.operators.spanning import keyed_block_pairs
from tessera.session import ensure_checkpoint_dir, materialize

PAIR_SCHEMA = "ANCHOR string, MATCH string, SIMILARITY_SCORE int"


_ALPHABET = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789_ ")}


def _histograms(strings: list[str]) -> np.ndarray:
    h = np.zeros((len(strings), len(_ALPHABET)), dtype=np.int16)
    for i, s in enumerate(strings):
        for ch in s:
            h[i, _ALPHABET[ch]] += 1
    return h


def _candidates(sa: list[str], sb: list[str], threshold: int, same: bool, block: int = 256) -> np.ndarray:
    """Exact prefilter: (i, j) pairs that can still reach ``threshold``.

    combined >= T needs round(token_sort) >= 2T - 100, and token_sort is at
    most 200 * H / (|a| + |b|) where H, the size of the character-histogram
    intersection of the sorted strings, bounds their LCS.  Pairs below the
    bound are dropped without running the LCS; for T <= 50 nothing is.
    """
    need = 2 * threshold - 100 - 0.5
    la = np.array([len(x) for x in sa], dtype=np.float64)
    lb = la if same else np.array([len(x) for x in sb], dtype=np.float64)
    out = []
    if need <= 0:
        ii, jj = np.meshgrid(np.arange(len(sa)), np.arange(len(sb)), indexing="ij")
        keep = np.ones_like(ii, dtype=bool)
        if same:
            keep &= jj > ii
        return np.stack([ii[keep], jj[keep]], axis=1)
    ha = _histograms(sa)
    hb = ha if same else _histograms(sb)
    for r0 in range(0, len(sa), block):
        inter = np.minimum(ha[r0:r0 + block, None, :], hb[None, :, :]).sum(-1, dtype=np.int64)
        lensum = la[r0:r0 + block, None] + lb[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = np.where(lensum > 0, 200.0 * inter / lensum, 100.0)
        keep = bound >= need
        if same:
            keep &= np.arange(len(sb))[None, :] > np.arange(r0, min(r0 + block, len(sa)))[:, None]
        i, j = np.nonzero(keep)
        out.append(np.stack([i + r0, j], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)


def _score_block(threshold: int):
    def fn(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        key = (left if len(left) else right)["key_hash"].iat[0]
        ln, rn, ls, rs = left["name"].tolist(), right["name"].tolist(), left["s"].tolist(), right["s"].tolist()
        lk = [set(x.tolist()) for x in left["keys"]]
        rk = lk if same else [set(x.tolist()) for x in right["keys"]]
        out = []
        for i, j in _candidates(ls, rs, threshold, same):
            if min(lk[i] & rk[j]) != key:
                continue  # the pair is scored under its first common key
            sc = (token_sort_ratio(ls[i], rs[j]) + token_set_ratio(ls[i], rs[j])) // 2
            if sc >= threshold:
                out.append((ln[i], rn[j], sc))
        return pd.DataFrame(out, columns=["ANCHOR", "MATCH", "SIMILARITY_SCORE"])
    return fn


def fuzzy_pairs(df: DataFrame, name_col: str, threshold: int = 80, chunk_rows: int = 512) -> DataFrame:
    names = df.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    names = materialize(names, "fuzzy-names")
    rows = materialize(key_rows(names, threshold).withColumn("key_hash", F.hash("key")), "fuzzy-keys")
    # a hot key is dealt into chunks; distinct: two keys may have one hash
    half = keyed_block_pairs(rows, ["key"], "name", _score_block(threshold), PAIR_SCHEMA, chunk_rows).distinct()
    # both directions of a pair from one scoring pass
    flip = F.struct(F.col("MATCH").alias("ANCHOR"), F.col("ANCHOR").alias("MATCH"), "SIMILARITY_SCORE")
    both = half.select(F.explode(F.array(F.struct("ANCHOR", "MATCH", "SIMILARITY_SCORE"), flip)).alias("p")).select("p.*")
    self_pairs = names.select(F.col("name").alias("ANCHOR"), F.col("name").alias("MATCH"),
                              F.lit(100).alias("SIMILARITY_SCORE"))
    return both.unionByName(self_pairs)


GROUP_EDGES = 1 << 18


def _queue(pdf: pd.DataFrame) -> pd.DataFrame:
    """The queue clustering of one component from its (u, v) edges, u < v."""
    earlier: dict[str, list[str]] = {}
    for u, v in zip(pdf["u"], pdf["v"]):
        earlier.setdefault(v, []).append(u)
        earlier.setdefault(u, [])
    anchor: dict[str, str] = {}
    for name in sorted(earlier, key=lambda x: x.encode()):
        mine = [u for u in earlier[name] if anchor[u] == u]
        anchor[name] = min(mine, key=lambda x: x.encode()) if mine else name
    return pd.DataFrame({"name": list(anchor), "anchor": list(anchor.values())})


def _anchors_in_rounds(edges: DataFrame) -> DataFrame:
    """(name, anchor) of components too large for one group.  A name without an
    undecided earlier neighbour is an anchor and removes its neighbours; only
    the edges between undecided names, the frontier, are rewritten."""
    names = edges.select(F.explode(F.array("u", "v")).alias("name")).distinct()
    open_names, open_edges, found = materialize(names, "greedy-open"), edges, None
    while not open_names.isEmpty():
        anchors = materialize(open_names.join(open_edges.select(F.col("v").alias("name")), "name", "left_anti"), "greedy-anchors")
        removed = open_edges.join(anchors.select(F.col("name").alias("u")), "u").select(F.col("v").alias("name")).distinct()
        found = anchors if found is None else found.unionByName(anchors)
        gone = materialize(anchors.unionByName(removed), "greedy-gone")
        open_names = materialize(open_names.join(gone, "name", "left_anti"), "greedy-open")
        left = open_edges.join(gone.select(F.col("name").alias("u")), "u", "left_anti").join(
            gone.select(F.col("name").alias("v")), "v", "left_anti")
        open_edges = materialize(left.select("u", "v"), "greedy-frontier")
    if found is None:
        return names.select("name", F.col("name").alias("anchor"))
    first = edges.join(found.select(F.col("name").alias("u")), "u").groupBy(F.col("v").alias("name")).agg(F.min("u").alias("anchor"))
    members = first.join(found, "name", "left_anti")
    return found.select("name", F.col("name").alias("anchor")).unionByName(members)


def greedy_anchors(names: DataFrame, pairs: DataFrame, name_col: str = "name", group_edges: int = GROUP_EDGES) -> DataFrame:
    """(name, anchor) for every distinct name; anchors map to themselves.

    ``pairs`` holds (ANCHOR, MATCH) edges at or above the threshold (self
    pairs are ignored).  Anchors are the greedy (lexicographically first)
    maximal independent set, and a member belongs to its earliest anchor
    neighbour, exactly the anchor that removed it from the queue.  The queue
    never crosses a component of the match graph: components of at most
    ``group_edges`` edges are solved in one group each, whatever the length of
    their chains, larger ones in rounds over their frontier.
    """
    ensure_checkpoint_dir(names.sparkSession)
    edges = (pairs.filter(F.col("ANCHOR") < F.col("MATCH"))
                  .select(F.col("ANCHOR").alias("u"), F.col("MATCH").alias("v")).distinct())
    edges = materialize(edges, "greedy-edges")
    ends = edges.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    comp = components(materialize(ends, "greedy-ends"), edges.toDF("src", "dst"))
    edges = materialize(edges.join(comp.withColumnRenamed("id", "u"), "u"), "greedy-edges")
    large = edges.groupBy("comp").agg(F.count("*").alias("n")).where(F.col("n") > group_edges).select("comp")
    large = materialize(large, "greedy-large")
    solved = edges.join(large, "comp", "left_anti").groupBy("comp").applyInPandas(_queue, "name string, anchor string")
    if not large.isEmpty():
        solved = solved.unionByName(_anchors_in_rounds(edges.join(large, "comp", "left_semi").select("u", "v")))
    all_names = names.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    return all_names.join(materialize(solved, "greedy-solved"), "name", "left").select(
        "name", F.coalesce("anchor", "name").alias("anchor"))
