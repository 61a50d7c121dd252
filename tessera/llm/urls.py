"""URL filters by a path-template tree, in DataFrame functions only.

Rules come first (longest fitting rule).  For the other urls the paths of
each host form a tree that is generalised level by level: digits become
``{n}``; at a node, a child stays literal only if it is the only child or if
its labelled pages differ from the node's by a binomial z-score; all other
children are merged into ``*``.  A template is rejected if its smoothed share
of good labels falls below the purity limit.

The tree works on counts per distinct (host, path shape), aggregated before
any shuffle, so a hot host costs as many rows as it has shapes.  It is as deep
as the paths; a shape that is alone below its node has only single children
and gets its remaining segments at once.

Edge cases: null urls and urls without ``://`` have empty host and path and
fit no rule; repeated pages are judged row by row; repeated labels count
once per page (the lowest quality); without labels every template is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_LOWER, ASCII_UPPER, saved

# Fixed values: (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return (F.translate(F.regexp_extract(u, pattern, 1), ASCII_UPPER, ASCII_LOWER),
            F.regexp_extract(u, pattern, 2))


def rule_columns(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    # shortest first: a longer rule wraps and so precedes the shorter ones
    for h, p, v in sorted(RULES if rules is None else rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    """Path segments with digit runs as {n}."""
    return F.array_remove(F.split(F.regexp_replace(path, "[0-9]+", "{n}"), "/", -1), "")


def template_tree(shapes: DataFrame, z: float = 2.0, min_labels: int = 5) -> DataFrame:
    """(host, shape, template) from (host, shape, labelled, good)."""
    df = saved(shapes.withColumns({"template": F.lit(""), "done": F.size("shape") == 0}), "url-shapes")
    d = 0
    while df.where("not done").limit(1).count():
        seg = F.get("shape", F.lit(d))
        child = (df.where("not done").groupBy("host", "template", seg.alias("seg"))
                 .agg(F.sum("labelled").alias("cl"), F.sum("good").alias("cg"), F.count("*").alias("below"), F.min("shape").alias("rest")))
        node = child.groupBy("host", "template").agg(
            F.count("*").alias("children"), F.sum("cl").alias("nl"), F.sum("cg").alias("ng"), F.sum("below").alias("all"))
        rate = (F.col("ng") + 0.5) / (F.col("nl") + 1)
        score = F.abs(F.col("cg") - F.col("cl") * rate) / F.sqrt(F.col("cl") * rate * (1 - rate))
        literal = (F.col("children") == 1) | ((F.col("cl") >= min_labels) & (score > z))
        alone = F.col("all") == 1
        tail = F.array_join(F.slice("rest", d + 1, F.size("rest")), "/")
        step = child.join(node, ["host", "template"]).select(
            "host", "template", "seg", alone.alias("alone"),
            F.concat("template", F.lit("/"), F.when(alone, tail).when(literal, F.col("seg")).otherwise("*")).alias("next"))
        df = (df.withColumn("seg", F.when(F.col("done"), "").otherwise(seg))
              .join(step, ["host", "template", "seg"], "left")
              .select("host", "shape", "labelled", "good", F.coalesce("next", "template").alias("template"),
                      (F.col("done") | F.coalesce("alone", F.lit(False)) | (F.size("shape") <= d + 1)).alias("done")))
        df = saved(df, f"url-level{d}")
        d += 1
    return df.drop("done")


def judge(pages: DataFrame, labels: DataFrame, rules=None, min_purity: float = 0.5, weight: float = 10.0) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every page."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = saved(rows.withColumns({"rule": name, "ruled": verdict, "shape": shape(F.col("path"))}), "url-rows")
    quality = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
               .groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumnRenamed("doc_id", "page_id"))
    seen = rows.join(quality, "page_id", "left")
    shapes = seen.groupBy("host", "shape").agg(
        F.count("quality").alias("labelled"), F.sum(F.coalesce((F.col("quality") > 0).cast("long"), F.lit(0))).alias("good"))
    tree = template_tree(shapes)
    total = tree.agg(((F.sum("good") + 1) / (F.sum("labelled") + 2)).alias("prior"))
    purity = (tree.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("good").alias("g"))
              .join(total).withColumn("purity", (F.col("g") + weight * F.col("prior")) / (F.col("n") + weight)))
    named = tree.join(purity.select("host", "template", "purity"), ["host", "template"])
    return (rows.join(named.select("host", "shape", "template", "purity"), ["host", "shape"])
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("purity") < min_purity, "block").otherwise("allow")).alias("verdict"),
                    "template", "purity"))
