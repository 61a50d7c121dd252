"""Co-occurrence counts of items over baskets (who shares bills with whom).

Baskets of at most ``heavy`` items are dealt by hash into groups of a bounded
number of pairs; a group counts its pairs before it hands them on, and no row
is copied.  The items of a larger basket are cut into chunks and compared chunk
by chunk (``keyed_block_pairs``), so a basket with very many items is spread
over tasks.  An item on very many baskets meets only partial counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.spanning import keyed_block_pairs
from tessera.session import materialize


def incidence(pairs: DataFrame, item: str, basket: str) -> DataFrame:
    """Distinct (item, basket) rows, written once under the checkpoint
    folder: the product, its size statistics and the per-item totals all
    read it."""
    inc = pairs.select(F.col(item).alias("item"), F.col(basket).alias("basket")).filter(
        F.col("item").isNotNull() & F.col("basket").isNotNull()).distinct()
    return materialize(inc, "incidence")


COUNTS = "item_a string, item_b string, shared long"


def _count_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pair counts over the baskets of one group."""
    item, names = pd.factorize(pdf["item"], sort=True)
    basket, _ = pd.factorize(pdf["basket"])
    order = np.lexsort((item, basket))
    item, size = item[order], np.bincount(basket)
    first = np.cumsum(size) - size
    found = []
    for m in np.unique(size[size > 1]):  # baskets of one size side by side
        rows = item[first[size == m][:, None] + np.arange(m)[None, :]]
        a, b = np.triu_indices(m, 1)
        found.append((rows[:, a] * len(names) + rows[:, b]).ravel())
    pair, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
    return pd.DataFrame({"item_a": names[pair // max(1, len(names))], "item_b": names[pair % max(1, len(names))], "shared": n})


def _block_pairs(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
    """The pairs of two chunks of one basket."""
    a, b = left["item"].to_numpy(object), right["item"].to_numpy(object)
    i, j = np.triu_indices(len(a), 1) if same else (x.ravel() for x in np.indices((len(a), len(b))))
    a, b = a[i], b[j]
    less = np.array([x < y for x, y in zip(a, b)], bool)
    return pd.DataFrame({"item_a": np.where(less, a, b), "item_b": np.where(less, b, a), "shared": 1})


def cooccurrence(inc: DataFrame, heavy: int = 512, pairs_per_task: int = 1 << 18) -> DataFrame:
    """(item_a, item_b, shared) for item_a < item_b sharing >= 1 basket,
    from distinct (item, basket) rows (see ``incidence``)."""
    inc = inc.select("item", "basket")
    sizes = inc.groupBy("basket").agg(F.count("*").alias("n")).where("n > 1")
    rows = materialize(inc.join(sizes, "basket"), "basket-rows")
    pairs = rows.where(F.col("n") <= heavy).agg(F.coalesce(F.sum((F.col("n") - 1) / 2), F.lit(0)).alias("p")).first()["p"]
    group = F.pmod(F.xxhash64("basket"), F.lit(max(1, math.ceil(pairs / pairs_per_task))))
    light = rows.where(F.col("n") <= heavy).withColumn("group", group).select("group", "basket", "item")
    parts = light.groupBy("group").applyInPandas(_count_pairs, COUNTS)
    large = rows.where(F.col("n") > heavy).select("basket", "item")
    parts = parts.unionByName(keyed_block_pairs(large, ["basket"], "item", _block_pairs, COUNTS, heavy))
    return parts.groupBy("item_a", "item_b").agg(F.sum("shared").cast("long").alias("shared"))


def affinity(pairs: DataFrame, item: str, basket: str, **kw) -> DataFrame:
    """shared / (baskets of a + baskets of b): 0.5 when two items always
    appear together."""
    inc = incidence(pairs, item, basket)
    co = cooccurrence(inc, **kw)
    per = inc.groupBy("item").agg(F.count(F.lit(1)).cast("long").alias("n"))
    a = per.select(F.col("item").alias("item_a"), F.col("n").alias("n_a"))
    b = per.select(F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    out = co.join(a, "item_a").join(b, "item_b")
    return out.select("item_a", "item_b", "shared", "n_a", "n_b",
                      (F.col("shared") / (F.col("n_a") + F.col("n_b"))).alias("affinity"))
