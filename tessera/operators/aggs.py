"""Aggregations (A*).

Everything is a single hash aggregate with map-side partial aggregation,
so a hot key (one organisation holding a third of the rows) is reduced on
the map side before the shuffle.  Top-1-per-group uses ``max_by``/
``min_by`` aggregates instead of a window sort for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.strings import like


def conditional_counts(df: DataFrame, text: str, patterns: dict[str, str],
                       both: dict[str, tuple[str, str]] | None = None,
                       total: str = "TOTAL") -> DataFrame:
    """One pass of ``COUNT(CASE WHEN text LIKE p THEN 1 END)`` per pattern.

    ``both`` names columns that require two patterns at once.  Null text
    only counts towards ``total`` (LIKE on null is null).
    """
    c = F.col(text)
    aggs = [F.count_if(like(c, p)).cast("long").alias(name) for name, p in patterns.items()]
    for name, (a, b) in (both or {}).items():
        aggs.append(F.count_if(like(c, patterns[a]) & like(c, patterns[b])).cast("long").alias(name))
    aggs.append(F.count(F.lit(1)).cast("long").alias(total))
    return df.agg(*aggs)


def group_count(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias(name))


def max_with_default(df: DataFrame, col: str, default: int, name: str) -> DataFrame:
    """MAX(col) with a default for an empty table (the reference returned
    NULL there and then failed)."""
    return df.agg(F.coalesce(F.max(col).cast("long"), F.lit(default).cast("long")).alias(name))


def cardinality(df: DataFrame, cols: list[str], nulls_as_value: bool = True) -> DataFrame:
    """Exact distinct counts; with ``nulls_as_value`` a null counts as one
    more value (pandas ``unique()`` semantics)."""
    aggs = []
    for c in cols:
        n = F.countDistinct(c)
        if nulls_as_value:
            n = n + F.max(F.col(c).isNull().cast("int"))
        aggs.append(n.cast("long").alias(f"distinct_{c}"))
    return df.agg(*aggs)


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    return group_count(df.filter(F.col(col).isNotNull()), [col], name)


def filtered_counts(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(p).cast("long").alias(n) for n, p in predicates.items()])


def time_bins(df: DataFrame, ts: str, unit: str, category: str, name: str = "count") -> DataFrame:
    bin_col = F.date_format(F.date_trunc(unit, F.col(ts)), "yyyy-MM-dd").alias(f"{unit}_start")
    return df.groupBy(bin_col, F.col(category)).agg(F.count(F.lit(1)).cast("long").alias(name))


def counts_with_group_rank(df: DataFrame, family: str, member: str) -> DataFrame:
    """Count per (family, member); add the family total and a dense rank of
    families by total (largest first, name breaks ties).  The total is a
    window over the already aggregated (small) table, not over raw rows."""
    cnt = group_count(df, [family, member], "cnt")
    totals = df.groupBy(family).agg(F.count(F.lit(1)).cast("long").alias("family_total"))
    order = Window.orderBy(F.desc("family_total"), F.asc(family))  # one row per family
    ranked = totals.withColumn("family_rank", F.dense_rank().over(order).cast("long")).withColumnRenamed(family, "_family")
    return cnt.join(ranked, F.col(family).eqNullSafe(F.col("_family"))).drop("_family")


def grouped_ols(df: DataFrame, group: str, y: str, x: str, digits: int = 6) -> DataFrame:
    return df.groupBy(group).agg(
        F.round(F.regr_slope(F.col(y), F.col(x)), digits).alias("slope"),
        F.round(F.regr_intercept(F.col(y), F.col(x)), digits).alias("intercept"),
        F.round(F.regr_r2(F.col(y), F.col(x)), digits).alias("r2"),
        F.count(F.lit(1)).cast("long").alias("n"),
    )


def profile_with_total(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Count by ``col`` plus a grand-total row (``col`` null) via ROLLUP."""
    return df.rollup(col).agg(F.count(F.lit(1)).cast("long").alias(name))


def sorted_distinct_list(col: str, sep: str = ",") -> Column:
    return F.concat_ws(sep, F.array_sort(F.collect_set(F.col(col))))


def trend_with_names(df: DataFrame, group: str, name: str) -> DataFrame:
    """One row per group and name: the name's records, and the records and
    distinct names of its group.  The names of a group stay rows, so no task
    holds the list of a large group."""
    per = df.groupBy(group, name).agg(F.count(F.lit(1)).cast("long").alias("name_records"))
    whole = per.groupBy(group).agg(F.sum("name_records").cast("long").alias("records"),
                                   F.count(F.col(name)).cast("long").alias("distinct_names"))
    return per.where(F.col(name).isNotNull()).join(whole, group)


def breadth(df: DataFrame, entity: str, session: str, area: str) -> DataFrame:
    """Distinct areas per (entity, session), then the average over sessions."""
    per = df.groupBy(entity, session).agg(F.countDistinct(area).alias("areas"))
    return per.groupBy(entity).agg(
        F.round(F.avg("areas"), 6).alias("avg_areas"),
        F.max("areas").cast("long").alias("max_areas"),
        F.count(F.lit(1)).cast("long").alias("sessions"),
    )


def representative_by_max(df: DataFrame, cluster: str, name: str, weight: str, order: str,
                          noise: int = -1, out: str = "grouped_name") -> DataFrame:
    """Cluster representative = the name with the largest weight, first row
    (smallest ``order``) on ties; a noise row keeps its own name.  The
    representative is a ``max_by`` aggregate, joined back on the cluster."""
    key = F.struct(F.col(weight), (-F.col(order)).alias("_neg_order"))
    reps = (df.filter(F.col(cluster) != noise)
              .groupBy(cluster).agg(F.max_by(F.col(name), key).alias("_rep")))
    out_df = df.join(reps, on=cluster, how="left")
    return out_df.withColumn(out, F.when(F.col(cluster) == noise, F.col(name)).otherwise(F.col("_rep"))).drop("_rep")


def representative_by_mode(df: DataFrame, cluster: str, name: str, order: str,
                           noise: int = -1, out: str = "CLUSTER_LABEL") -> DataFrame:
    """Cluster representative = most frequent string, first-seen on ties;
    noise gets a null label."""
    per = (df.filter(F.col(cluster) != noise)
             .groupBy(cluster, name)
             .agg(F.count(F.lit(1)).alias("_freq"), F.min(order).alias("_first")))
    key = F.struct(F.col("_freq"), (-F.col("_first")).alias("_neg_first"))
    reps = per.groupBy(cluster).agg(F.max_by(F.col(name), key).alias(out))
    return df.join(reps, on=cluster, how="left")


def cluster_summary(df: DataFrame, cluster: str, name: str, k: int) -> DataFrame:
    """Per cluster: sorted distinct names and row count; the k largest
    clusters (ties by cluster id).  The top-k is a TakeOrdered, not a sort."""
    top = (df.groupBy(cluster).agg(F.count(F.lit(1)).cast("long").alias("count"))
             .orderBy(F.desc("count"), F.asc(cluster)).limit(k))
    # names are gathered for the k clusters only
    names = (df.select(F.col(cluster).alias("_c"), name).join(top.select(F.col(cluster).alias("_t")), F.col("_c").eqNullSafe(F.col("_t")), "left_semi")
               .distinct().groupBy("_c").agg(F.concat_ws(",", F.array_sort(F.collect_list(F.col(name)))).alias("names")))
    return top.join(names, F.col(cluster).eqNullSafe(F.col("_c"))).select(cluster, "names", "count")


def repeat_by_weight(df: DataFrame, weight: str) -> DataFrame:
    """Materialise a weight as repeated rows (parity helper only; the
    clustering code consumes the weight column directly).  A weight is dealt
    in blocks, so no array grows with a hot key."""
    w, block = F.col(weight).cast("long"), 1024
    blocks = df.where(w > 0).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((w - 1) / block))))
    size = F.least(F.lit(block).cast("long"), w - F.col("_b") * block).cast("int")
    return blocks.withColumn("_rep", F.explode(F.array_repeat(F.lit(1), size))).drop("_b", "_rep")
