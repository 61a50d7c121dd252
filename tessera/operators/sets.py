"""Set operations, sort, limit and sample (U*, O*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def hash_bucket(col, buckets: int):
    """Deterministic bucket from md5 of the value's text: the first 8 hex
    digits as an unsigned integer, modulo ``buckets``.  The same value is
    computable in any SQL engine that has md5."""
    h = F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def hash_fraction(df: DataFrame, key: str, fraction: float, resolution: int = 1000) -> DataFrame:
    """Repeatable Bernoulli sample without replacement keyed on ``key``.
    Unlike ``sample(seed)`` the draw does not depend on partitioning."""
    return df.filter(hash_bucket(F.col(key), resolution) < F.lit(int(round(fraction * resolution))))


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)
