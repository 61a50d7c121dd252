"""Joins (J1-J7).

Broadcast hints are given only to sides whose size is bounded by
construction (a lookup of regions, a top-n list); every data-sized side
is left to the planner, which broadcasts it only when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime)
and otherwise shuffles both sides on the key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unprocessed(bronze: DataFrame, silver: DataFrame | None, key: str = "doc_id") -> DataFrame:
    """Bronze rows without a silver row (``left_anti``, never NOT IN: a null
    key in silver would empty the result).  Silver may hold many rows per
    key; the anti join is insensitive to that.  No silver -> all rows."""
    if silver is None:
        return bronze
    return bronze.join(silver.select(key).distinct(), on=key, how="left_anti")


def semi(df: DataFrame, other: DataFrame, left: str, right: str) -> DataFrame:
    o = other.select(F.col(right).alias("_semi_key"))
    return df.join(o, df[left] == o["_semi_key"], "left_semi")


def lookup_with_default(df: DataFrame, lookup: DataFrame, key: str, value: str,
                        default: str = "Other", keep: list[str] | None = None,
                        out: str | None = None) -> DataFrame:
    """Left join to a key->value map; unmapped keys, and values outside
    ``keep`` when given, become ``default``.  The map is broadcast only if
    the planner measures it below the broadcast threshold."""
    out = out or value
    lk = lookup.select(F.col(key).alias("_lk"), F.trim(F.col(value)).alias("_lv"))
    j = df.join(lk, df[key] == lk["_lk"], "left")
    v = F.col("_lv")
    if keep is not None:
        v = F.when(v.isin(keep), v)
    return j.withColumn(out, F.coalesce(v, F.lit(default))).drop("_lk", "_lv")


def compute_on_distinct(df: DataFrame, col: str, fn: Callable[[Column], Column], out: str) -> DataFrame:
    """Evaluate an expensive expression once per distinct value, then attach
    it to every row.  Catalyst does not de-duplicate expression inputs by
    itself; the distinct set is shuffled once and joined back."""
    uniq = df.select(col).distinct().withColumn(out, fn(F.col(col)))
    uniq = uniq.withColumnRenamed(col, "_dv")
    return df.join(uniq, df[col].eqNullSafe(uniq["_dv"]), "left").drop("_dv")


def parent_child(parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """Each parent key visited once: de-duplicate parents before the fan-out."""
    return parents.dropDuplicates(keys).join(children, on=keys, how="inner")
