"""Queries for operations the reference documents but does not code."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import distinct_text, silver
from tessera.session import materialize
from tessera.plans import roles
from tessera.plans.documents import CLEANED_SQL, HASH_SQL
from tessera.plans.registry import query
from tessera.plans.roles import FULL_TEXT_SQL, with_views
from tessera.sources.tables import Tables

TOP_TERMS = 10


@query("doc_tfidf", with_views(f"""
WITH terms AS (SELECT session, unnest(string_split_regex(lower(doc_text), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM ft),
tf AS (SELECT session, term, count(*) AS tf FROM terms WHERE term <> '' GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(DISTINCT session) AS n_groups FROM ft),
s AS (SELECT tf.session, tf.term, tf.tf, df.df, tf.tf * ln(n.n_groups / df.df) AS tfidf FROM tf JOIN df USING (term), n),
r AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY round(tfidf, 9) DESC, term ASC) AS rk FROM s)
SELECT session, term, CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df, round(tfidf, 6) AS tfidf,
       CAST(rk AS BIGINT) AS rank FROM r WHERE rk <= {TOP_TERMS}""", ft=FULL_TEXT_SQL))
def doc_tfidf(spark, sf_dir):
    """Terms that set one session's documents apart from the others."""
    ft = roles.full_text(Tables(spark, sf_dir))
    return distinct_text.tfidf_top_terms(ft, "session", "doc_text", TOP_TERMS)


@query("doc_distinctive_sentence", with_views(f"""
WITH sv AS (SELECT * FROM hashed),
n AS (SELECT doc_id, count(DISTINCT sentence_index) AS n_sent FROM sv GROUP BY 1),
mv AS (SELECT sv.doc_id, bucket, sum(cnt) / n.n_sent AS m FROM sv JOIN n USING (doc_id) GROUP BY sv.doc_id, bucket, n.n_sent),
mn AS (SELECT doc_id, sqrt(sum(m * m)) AS mnorm FROM mv GROUP BY 1),
sn AS (SELECT doc_id, sentence_index, sqrt(sum(CAST(cnt AS DOUBLE) * cnt)) AS snorm FROM sv GROUP BY 1, 2),
d AS (SELECT sv.doc_id, sv.sentence_index, sum(sv.cnt * mv.m) AS dot FROM sv JOIN mv USING (doc_id, bucket) GROUP BY 1, 2),
sim AS (SELECT d.doc_id, d.sentence_index, d.dot / (sn.snorm * mn.mnorm) AS similarity
        FROM d JOIN sn USING (doc_id, sentence_index) JOIN mn USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(similarity, 9), sentence_index) AS rk FROM sim)
SELECT doc_id, sentence_index, round(similarity, 6) AS similarity FROM r WHERE rk = 1""",
    ft=FULL_TEXT_SQL, cl=CLEANED_SQL, hashed=HASH_SQL))
def doc_distinctive_sentence(spark, sf_dir):
    """Per document, the sentence that differs most from the document's
    average sentence (lowest cosine to the mean vector)."""
    ft = roles.full_text(Tables(spark, sf_dir))
    # the sentences are dealt by document once; their counts, many times as long, stay where they are
    sents = silver.sentences(silver.cleaned_documents(ft, None)).repartition("doc_id")
    return distinct_text.distinctive_sentences(silver.sparse_hash_counts(sents))


# party = source, bill = language of a document
def _tfidf_scope_sql(scope: str) -> str:
    return f"""
SELECT '{scope}' AS scope, party, bill, term, CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df, round(tfidf, 6) AS tfidf, CAST(rk AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY party, bill ORDER BY round(tfidf, 9) DESC, term) AS rk
      FROM (SELECT tf.*, df, tf * ln(n / df) AS tfidf FROM tf
            JOIN (SELECT {scope}, term, count(*) AS df FROM tf GROUP BY ALL) USING ({scope}, term)
            JOIN (SELECT {scope}, count(DISTINCT (party, bill)) AS n FROM tf GROUP BY ALL) USING ({scope})))
WHERE rk <= {TOP_TERMS}"""


@query("doc_tfidf_scopes", """
WITH terms AS (SELECT source AS party, lang AS bill, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+')) AS term FROM documents),
tf AS (SELECT party, bill, term, count(*) AS tf FROM terms WHERE term <> '' GROUP BY ALL)
""" + _tfidf_scope_sql("party") + "\nUNION ALL" + _tfidf_scope_sql("bill"))
def doc_tfidf_scopes(spark, sf_dir):
    """Terms that set a party's text on a bill apart from its text on other
    bills, and from the others' text on the same bill."""
    docs = Tables(spark, sf_dir).documents.select(F.col("source").alias("party"), F.col("lang").alias("bill"), "text")
    return distinct_text.tfidf_in_scopes(docs, ["party", "bill"], "text", TOP_TERMS)


def _similar_scope_sql(scope: str) -> str:
    return f"""
SELECT '{scope}' AS scope, party, bill, doc_id, sentence_index, round(similarity, 6) AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY party, bill ORDER BY round(similarity, 9), doc_id, sentence_index) AS rk
      FROM (SELECT party, bill, doc_id, sentence_index, sum(cnt * m) / (sqrt(sum(CAST(cnt AS DOUBLE) * cnt)) * max(mnorm)) AS similarity
            FROM sv JOIN (SELECT {scope}, bucket, CAST(sum(cnt) AS DOUBLE) AS m FROM sv GROUP BY ALL) USING ({scope}, bucket)
            JOIN (SELECT {scope}, sqrt(sum(m * m)) AS mnorm FROM (SELECT {scope}, bucket, CAST(sum(cnt) AS DOUBLE) AS m FROM sv GROUP BY ALL) GROUP BY ALL)
              USING ({scope}) GROUP BY ALL))
WHERE rk = 1"""


@query("doc_distinctive_scopes", with_views(
    "WITH sv AS (SELECT source AS party, lang AS bill, hashed.* FROM hashed JOIN documents USING (doc_id))"
    + _similar_scope_sql("party") + "\nUNION ALL" + _similar_scope_sql("bill"),
    ft=FULL_TEXT_SQL, cl=CLEANED_SQL, hashed=HASH_SQL))
def doc_distinctive_scopes(spark, sf_dir):
    """Per party and bill, the sentence least like all sentences of the party,
    and the one least like all sentences on the bill."""
    t = Tables(spark, sf_dir)
    sents = silver.sentences(silver.cleaned_documents(roles.full_text(t), None)).repartition("doc_id")
    sparse = silver.sparse_hash_counts(sents)
    place = t.documents.select("doc_id", F.col("source").alias("party"), F.col("lang").alias("bill"))
    sparse = materialize(sparse.join(place, "doc_id"), "sparse-scopes")
    out = None
    for scope, other in (("party", "bill"), ("bill", "party")):
        near = distinct_text.sentence_similarity(sparse, scope, [other, "doc_id", "sentence_index"])
        first = F.struct(F.round("similarity", 9).alias("s"), F.col("doc_id").alias("d"), F.col("sentence_index").alias("i"))
        best = near.groupBy("party", "bill").agg(F.min_by(F.struct("doc_id", "sentence_index", "similarity"), first).alias("b"))
        best = best.select(F.lit(scope).alias("scope"), "party", "bill", "b.doc_id", "b.sentence_index", F.round("b.similarity", 6).alias("similarity"))
        out = best if out is None else out.unionByName(best)
    return out


# ------------------------------------------------- co-testimony
from tessera.operators import cooccur, sets  # noqa: E402
from tessera.plans.roles import TESTIMONY_SQL  # noqa: E402

STRONG_AFFINITY = 0.035
TOP_PAIRS = 10

AFFINITY_SQL = f"""
WITH ob AS (SELECT DISTINCT Organization AS org, LDNumber AS bill FROM ({TESTIMONY_SQL}) th
            WHERE Organization IS NOT NULL AND LDNumber IS NOT NULL),
n AS (SELECT org, count(*) AS n FROM ob GROUP BY org),
co AS (SELECT a.org AS item_a, b.org AS item_b, count(*) AS shared FROM ob a JOIN ob b
       ON a.bill = b.bill AND a.org < b.org GROUP BY 1, 2),
af AS (SELECT co.item_a, co.item_b, CAST(co.shared AS BIGINT) AS shared, CAST(na.n AS BIGINT) AS n_a,
              CAST(nb.n AS BIGINT) AS n_b, co.shared / (na.n + nb.n) AS affinity
       FROM co JOIN n na ON na.org = co.item_a JOIN n nb ON nb.org = co.item_b)"""


def _affinity(t: Tables):
    th = roles.testimony(t).select("Organization", "LDNumber")
    return cooccur.affinity(th, "Organization", "LDNumber")


@query("doc_affinity", AFFINITY_SQL + """
SELECT item_a, item_b, shared, n_a, n_b, round(affinity, 6) AS affinity FROM af""")
def doc_affinity(spark, sf_dir):
    """Affinity of two organisations: bills both testified on / (bills of
    A + bills of B), for every pair sharing a bill."""
    a = _affinity(Tables(spark, sf_dir))
    return a.select("item_a", "item_b", "shared", "n_a", "n_b", F.round("affinity", 6).alias("affinity"))


@query("doc_cotestimony", AFFINITY_SQL + f"""
SELECT item_a AS source, item_b AS target, round(affinity, 6) AS weight FROM af WHERE affinity >= {STRONG_AFFINITY}""")
def doc_cotestimony(spark, sf_dir):
    """Edge list of the normalised co-testimony graph, strong edges only."""
    a = _affinity(Tables(spark, sf_dir)).filter(F.col("affinity") >= STRONG_AFFINITY)
    return a.select(F.col("item_a").alias("source"), F.col("item_b").alias("target"),
                    F.round("affinity", 6).alias("weight"))


@query("doc_frequent_pairs", AFFINITY_SQL + f"""
SELECT item_a, item_b, shared FROM af ORDER BY shared DESC, item_a, item_b LIMIT {TOP_PAIRS}""")
def doc_frequent_pairs(spark, sf_dir):
    """'Frequent fliers': the organisation pairs on the most bills together
    (a top-k report)."""
    a = _affinity(Tables(spark, sf_dir)).select("item_a", "item_b", "shared")
    return sets.top_k(a, TOP_PAIRS, F.desc("shared"), F.asc("item_a"), F.asc("item_b"))


# A digit inside a word and the letter it stands for, and back.
OCR_DIGITS = [("0", "o"), ("1", "l"), ("5", "s")]

_fixed_sql = "coalesce(text, '')"
for _digit, _letter in OCR_DIGITS:
    _cap = _letter.upper() if _letter != "l" else "I"
    for _around, _old, _new in ((("[a-z]", "[a-z]"), _digit, _letter), (("[A-Z]", "[A-Z]"), _digit, _cap), (("[0-9]", "[0-9]"), f"[{_letter}{_cap}]", _digit)):
        for _ in range(2):  # a match takes both neighbours, so every second one waits for the next pass
            _fixed_sql = f"regexp_replace({_fixed_sql}, '({_around[0]}){_old}({_around[1]})', '\\1{_new}\\2', 'g')"


@query("doc_ocr_fixes", f"""
SELECT doc_id, md5(fixed) AS fixed_md5, fixed <> coalesce(text, '') AS changed FROM (SELECT *, {_fixed_sql} AS fixed FROM documents)""")
def doc_ocr_fixes(spark, sf_dir):
    """Texts with digits between letters, and letters between digits, read as
    the character they were scanned from."""
    docs = Tables(spark, sf_dir).documents
    text = F.coalesce("text", F.lit(""))
    fixed = docs.withColumn("fixed", tx.fix_scanned(text, OCR_DIGITS))
    return fixed.select("doc_id", F.md5("fixed").alias("fixed_md5"), (F.col("fixed") != text).alias("changed"))
