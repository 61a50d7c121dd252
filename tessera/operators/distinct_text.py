"""Distinctiveness of text (D1 tf-idf, D4 most distinctive sentence).

Both are aggregates and joins over sparse term / bucket counts; no pair
of documents or sentences is ever formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import vectors as vx
from tessera.session import materialize


def tfidf_top_terms(docs: DataFrame, group: str, text: str, k: int = 10) -> DataFrame:
    """Per group: the k terms with the highest tf * ln(N / df), where tf is
    the term's count in the group, df the number of groups using it and N
    the number of groups.  Ties by term."""
    terms = docs.select(group, F.explode(vx.tokens(F.col(text))).alias("term"))
    # written once: both the scores and the group counts read it
    tf = materialize(terms.groupBy(group, "term").agg(F.count(F.lit(1)).cast("long").alias("tf")), "tfidf-counts")
    df = tf.groupBy("term").agg(F.count(F.lit(1)).cast("long").alias("df"))
    n = docs.select(group).distinct().agg(F.count(F.lit(1)).alias("n_groups"))
    # N is a one-row aggregate: attach it with an equi-join on a constant key
    scored = tf.join(df, "term").withColumn("_one", F.lit(1))
    scored = scored.join(F.broadcast(n.withColumn("_one", F.lit(1))), "_one").drop("_one")
    scored = scored.withColumn("tfidf", F.col("tf") * F.log(F.col("n_groups") / F.col("df")))
    w = Window.partitionBy(group).orderBy(F.desc(F.round("tfidf", 9)), F.asc("term"))
    ranked = scored.withColumn("rank", F.row_number().over(w).cast("long"))
    return ranked.filter(F.col("rank") <= k).select(group, "term", "tf", "df", F.round("tfidf", 6).alias("tfidf"),
                                                     "rank")


def distinctive_sentences(sparse: DataFrame, doc: str = "doc_id", idx: str = "sentence_index") -> DataFrame:
    """Per document, the sentence least similar (cosine) to the document's
    mean sentence vector, from sparse (doc, idx, bucket, cnt) counts."""
    # windows and groups that all stay within a document: counts dealt by document are not dealt again
    total = F.sum("cnt").over(Window.partitionBy(doc, "bucket"))
    rows = sparse.where(F.col(doc).isNotNull()).withColumn("_tot", total)
    dots = rows.groupBy(doc, idx).agg(F.sum(F.col("cnt") * F.col("_tot")).cast("double").alias("dot"),
                                      F.sqrt(F.sum(F.col("cnt").cast("double") * F.col("cnt"))).alias("snorm"))
    # the mean enters as a sum (a scale does not change a cosine); its squared norm is the sum of the dots
    mnorm = F.sqrt(F.sum("dot").over(Window.partitionBy(doc)))
    sim = dots.select(doc, idx, (F.col("dot") / (F.col("snorm") * mnorm)).alias("similarity"))
    key = F.struct(F.round("similarity", 9).alias("s"), F.col(idx).alias("i"))
    best = sim.groupBy(doc).agg(F.min_by(F.struct(idx, "similarity"), key).alias("b"))
    return best.select(doc, F.col(f"b.{idx}").alias(idx), F.round("b.similarity", 6).alias("similarity"))


def tfidf_in_scopes(docs: DataFrame, scopes: list[str], text: str, k: int = 10) -> DataFrame:
    """(scope, *scopes, term, tf, df, tfidf, rank): the k terms that set the text
    of one cell, a value of every scope column (a party on a bill), apart
    from the other cells that share its scope value (the party's other bills, the
    others on the bill)."""
    terms = docs.select(*scopes, F.explode(vx.tokens(F.col(text))).alias("term"))
    tf = materialize(terms.groupBy(*scopes, "term").agg(F.count(F.lit(1)).cast("long").alias("tf")), "tfidf-cells")
    out = None
    for scope in scopes:
        df = tf.groupBy(scope, "term").agg(F.count(F.lit(1)).cast("long").alias("df"))
        n = tf.select(*scopes).distinct().groupBy(scope).agg(F.count(F.lit(1)).alias("n_cells"))
        scored = tf.join(df, [scope, "term"]).join(n, scope)
        scored = scored.withColumn("tfidf", F.col("tf") * F.log(F.col("n_cells") / F.col("df")))
        w = Window.partitionBy(*scopes).orderBy(F.desc(F.round("tfidf", 9)), F.asc("term"))
        ranked = scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k).select(
            F.lit(scope).alias("scope"), *scopes, "term", "tf", "df", F.round("tfidf", 6).alias("tfidf"), "rank")
        out = ranked if out is None else out.unionByName(ranked)
    return out


def sentence_similarity(sparse: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """(group, *keys, similarity): cosine of every sentence to the mean vector
    of its group's sentences, from sparse (group, keys, bucket, cnt) counts.
    The mean enters as a sum: a scale does not change a cosine."""
    mean = sparse.groupBy(group, "bucket").agg(F.sum("cnt").cast("double").alias("m"))
    mnorm = mean.groupBy(group).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("mnorm"))
    dots = sparse.join(mean, [group, "bucket"]).groupBy(group, *keys).agg(
        F.sum(F.col("cnt") * F.col("m")).alias("dot"), F.sqrt(F.sum(F.col("cnt").cast("double") * F.col("cnt"))).alias("snorm"))
    return dots.join(mnorm, group).select(group, *keys, (F.col("dot") / (F.col("snorm") * F.col("mnorm"))).alias("similarity"))
