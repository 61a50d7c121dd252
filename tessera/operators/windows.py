"""Window-function semantics (W*), planned to survive hot keys.

``COUNT(*) OVER (PARTITION BY k)`` and "first row per key" are expressed as
an aggregate (partial aggregation before the shuffle) joined back, so no
single task has to sort a partition that holds a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_over(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Every row plus the number of rows sharing its key; a null key is one
    group (joined back with null-safe equality)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias(name))
    counts = counts.withColumnRenamed(key, "_k")
    return (df.join(counts, df[key].eqNullSafe(counts["_k"]), "inner").drop("_k"))


def first_per_key(df: DataFrame, keys: list[str], order: str, payload: list[str]) -> DataFrame:
    """First-seen row per key in ``order`` (arrival) order; null keys form
    one group, as in a Python set of seen values."""
    st = F.struct(*[F.col(c) for c in [order] + payload])
    agg = df.groupBy(*keys).agg(F.min_by(st, F.col(order)).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in [order] + payload])


def top1_per_group(df: DataFrame, group: str, value: str, score: str, tiebreak: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY score DESC,
    tiebreak ASC) = 1`` as an aggregate."""
    # (score desc, tiebreak asc) is the minimum of the struct (-score, tiebreak);
    # tiebreak may be a string, so it is not negated.
    st = F.struct((-F.col(score)).alias("_neg"), F.col(tiebreak).alias("_tb"))
    return df.groupBy(group).agg(F.min_by(F.col(value), st).alias(value))
