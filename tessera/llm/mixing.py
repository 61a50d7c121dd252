"""Mixing sources to target weights with a multivariate-hypergeometric tree.

Every source is cut into ``BLOCKS`` permuted blocks by a hash of its rows.
Its target in words fixes how many whole passes and which leading blocks of
one more pass are drawn; the last block is cut at the row whose middle
reaches the target.  The drawn block slots of all sources are dealt to output
shards by a binary tree: at each node the sources' quotas are split between
the two halves by drawing without replacement (slot by slot, the chance of
"left" is slots left over for the left half / slots left over), which is the
multivariate hypergeometric law with exact quotas.  A shard then owns a
contiguous range of each source's slots, and rows are ordered in it by hash.

A row's copies and shards follow from its source's one parameter row, so the
texts are joined with a table of one row per source only.

All draws are hashes of ``seed``: reruns agree.  Edge cases: a null source is
a source of its own (last); null and blank texts have size 0, follow their
block and add no words; equal rows share their fate; a source of size 0 has
target 0; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import pinned, saved, spaced_words

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3
BLOCKS = 1024
SHARDS = 16


def placed(docs: DataFrame, seed: int, keep: list[str]) -> DataFrame:
    """``keep`` columns plus size, block and order hash of every row."""
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))]
    return docs.select(
        *keep, F.col("source").alias("_m_source"),
        F.size(spaced_words(F.col("text"))).cast("long").alias("_m_size"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("block"), *key), F.lit(BLOCKS)).cast("int").alias("_m_block"),
        F.xxhash64(F.lit(seed), F.lit("order"), *key).alias("_m_ord"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(rank, source, source_size, target) from (source, source_size).

    Water filling over the sources in order of cap / weight: a source is full
    if the level reached without the sources before it lies above its cap.
    The windows run over the table of one row per source."""
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1)
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    cap = F.col("source_size").cast("double") * max_repeat
    t = ranked.withColumn("w", weight).withColumn("cap", cap)
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    total = F.sum(F.col("source_size").cast("double")).over(Window.partitionBy())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", (total - before) / after).withColumn("full", F.col("level") >= F.col("cap") / F.col("w"))
    first = F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("w")).alias("r"), "rank", "level"))).over(Window.partitionBy())
    return t.withColumn("open", first).select(
        "rank", "source", "source_size",
        F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * F.col("open.level")).alias("target"))


def source_plan(rows: DataFrame, weights: tuple[float, ...], max_repeat: int) -> DataFrame:
    """One row per source: target, whole passes, the block in which the last
    pass ends, and the last order hash it takes there."""
    blocks = saved(rows.groupBy(F.col("_m_source").alias("source"), F.col("_m_block").alias("block"))
                   .agg(F.sum("_m_size").alias("words")), "mix-blocks")
    plan = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeat)
    size = F.col("source_size")
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    plan = saved(plan.withColumn("passes", passes.cast("long"))
                 .withColumn("rest", F.col("target") - F.col("passes") * size), "mix-targets")
    upto = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    b = blocks.withColumn("upto", F.sum("words").over(upto))
    b = b.join(plan.select(F.col("source").alias("_s"), "rest"), F.col("source").eqNullSafe(F.col("_s")))
    last = (b.where((F.col("rest") > 0) & (F.col("upto") >= F.col("rest")))
            .groupBy("source").agg(F.min(F.struct("block", (F.col("upto") - F.col("words")).alias("before"))).alias("l"))
            .select(F.col("source").alias("_s"), F.col("l.block").alias("last_block"), F.col("l.before").alias("before")))
    plan = saved(plan.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-last")
    ends = plan.select(F.col("source").alias("_s"), "last_block", "before", "rest")
    edge = rows.join(ends, F.col("_m_source").eqNullSafe(F.col("_s")) & (F.col("_m_block") == F.col("last_block")))
    run = Window.partitionBy("_s").orderBy("_m_ord").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("_m_size").over(run) - F.col("_m_size") / 2
    cut = (edge.withColumn("middle", middle).where(F.col("middle") < F.col("rest"))
           .groupBy("_s").agg(F.max("_m_ord").alias("last_ord")))
    return plan.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def split_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(rank, bounds) from (rank, quota): bounds[j] is the end of shard j's
    range of the source's slots.  Rows of the tree are nodes, each with the
    quotas of all sources."""
    if shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("rank", F.col("quota").cast("long").alias("q")))).alias("qs"))
    nodes = nodes.withColumn("node", F.lit(1).cast("long"))
    for _ in range(shards.bit_length() - 1):
        total = F.aggregate("qs", F.lit(0).cast("long"), lambda a, x: a + x["q"])
        # half of the slots; of an odd number a fair bit decides
        left = F.floor((F.col("n") + F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(2))) / 2).cast("long")
        nodes = nodes.withColumn("n", total).withColumn("left", left)

        def chance(rank: Column, i: Column) -> Column:
            return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "node", rank, i), 11) / F.lit(float(1 << 53))

        def slot(x: Column):
            def draw(a: Column, i: Column) -> Column:
                hit = (chance(x["rank"], i) * a["n"] < a["left"]).cast("long")
                return F.struct((a["n"] - 1).alias("n"), (a["left"] - hit).alias("left"), (a["got"] + hit).alias("got"))
            return draw

        def source(a: Column, x: Column) -> Column:
            start = F.struct(a["n"].alias("n"), a["left"].alias("left"), F.lit(0).cast("long").alias("got"))
            steps = F.when(x["q"] > 0, F.sequence(F.lit(1).cast("long"), x["q"])).otherwise(F.array().cast("array<long>"))
            end = F.aggregate(steps, start, slot(x))
            return F.struct(end["n"].alias("n"), end["left"].alias("left"), F.concat(a["out"], F.array(end["got"])).alias("out"))

        drawn = F.aggregate("qs", F.struct(F.col("n"), F.col("left"), F.array().cast("array<long>").alias("out")),
                            source, lambda a: a["out"])
        nodes = nodes.withColumn("drawn", pinned(drawn))
        part = lambda sign: F.transform("qs", lambda x, k: F.struct(
            x["rank"].alias("rank"), (F.get("drawn", k) if sign else x["q"] - F.get("drawn", k)).alias("q")))
        nodes = nodes.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), part(True).alias("qs")),
            F.struct((F.col("node") * 2 + 1).alias("node"), part(False).alias("qs")))).alias("x")).select("x.*")
    leaves = nodes.select("node", F.explode("qs").alias("x")).select("node", "x.*")
    ends = F.sum("q").over(Window.partitionBy("rank").orderBy("node").rowsBetween(Window.unboundedPreceding, 0))
    return (leaves.withColumn("end", ends).groupBy("rank")
            .agg(F.array_sort(F.collect_list("end")).alias("bounds")))


def draws(docs: DataFrame, keep: list[str], weights: tuple[float, ...] = WEIGHTS,
          max_repeat: int = MAX_REPEAT, shards: int = SHARDS, seed: int = 11) -> DataFrame:
    """``keep`` columns plus size, source_size, target and ``shards``: the
    shard of every copy of the row (an empty list if it is not drawn)."""
    rows = saved(placed(docs, seed, []), "mix-rows")
    plan = source_plan(rows, weights, max_repeat)
    quota = F.col("passes") * BLOCKS + F.coalesce(F.col("last_block") + 1, F.lit(0))
    plan = saved(plan, "mix-plan")
    tree = saved(split_tree(plan.select("rank", quota.alias("quota")), shards, seed), "mix-tree")
    plan = plan.join(tree, "rank").select(
        F.col("source").alias("_p_source"), "source_size", "target", "passes", "last_block", "last_ord", "bounds")
    df = placed(docs, seed, keep).join(plan, F.col("_m_source").eqNullSafe(F.col("_p_source")))
    more = ((F.col("_m_block") < F.col("last_block"))
            | ((F.col("_m_block") == F.col("last_block")) & (F.col("_m_ord") <= F.col("last_ord"))))
    copies = (F.col("passes") + F.coalesce(more, F.lit(False)).cast("long")).cast("int")
    shard = F.transform(
        F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>")),
        lambda e: F.size(F.filter("bounds", lambda b: b <= e.cast("long") * BLOCKS + F.col("_m_block"))))
    return df.select(*keep, F.col("_m_size").alias("size"), "source_size", "target", shard.alias("shards"),
                     F.col("_m_ord").alias("mix_order"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
        shards: int = SHARDS, seed: int = 11) -> DataFrame:
    """The mixed rows with the columns of ``docs``, ordered by shard and, in a
    shard, by a hash of row and copy; partitions are ranges of that order."""
    names = [f"_m_c{k}" for k in range(len(docs.columns))]  # input columns may be named like ours
    keyed = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)],
                        *[F.col(c) for c in ("doc_id", "text", "source")])
    out = draws(keyed, names, weights, max_repeat, shards, seed)
    out = out.select(*names, "mix_order", F.posexplode("shards").alias("_m_copy", "_m_shard"))
    key = F.xxhash64("mix_order", "_m_copy")
    out = out.withColumn("_m_key", key).repartitionByRange("_m_shard", "_m_key").sortWithinPartitions("_m_shard", "_m_key")
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
