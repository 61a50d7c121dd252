"""Organisation-name queries: fuzzy ratios, pair table, greedy clusters,
the cluster views (top match per anchor, anchors among matches, standard
organisation per testimony)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import fuzzy, windows
from tessera.plans import roles
from tessera.plans.registry import query
from tessera.plans.roles import TESTIMONY_SQL
from tessera.plans.sqlfuzzy import score_ctes
from tessera.session import materialize
from tessera.sources.tables import Tables

PAIR_THRESHOLD = 80      # score matrix threshold
VIEW_THRESHOLD = 90      # cluster view threshold
ANCHOR_FILTER = "%red%"  # stands in for the view's '%legislature%' probe

NEIGHBOUR_PAIRS_SQL = """
SELECT a.p_partkey, a.p_name AS name_a, b.p_name AS name_b
FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1"""


def _neighbour_pairs(t: Tables):
    a = t.part.select("p_partkey", F.col("p_name").alias("name_a"))
    b = t.part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("name_b"))
    return a.join(b, "p_partkey")


def _scored(t: Tables):
    # a few bytes a row but much work: the pairs are dealt over the tasks, not packed by their size
    p = _neighbour_pairs(t).repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    return p.withColumn("s", fuzzy.pair_scores(F.col("name_a"), F.col("name_b")))


def _pair_sql(cols: str) -> str:
    return f"WITH src AS ({NEIGHBOUR_PAIRS_SQL}),{score_ctes('src', 'name_a', 'name_b')}\nSELECT {cols} FROM scored"


@query("str_token_sort_ratio", _pair_sql("p_partkey, name_a, name_b, token_sort"))
def str_token_sort_ratio(spark, sf_dir):
    return _scored(Tables(spark, sf_dir)).select("p_partkey", "name_a", "name_b", F.col("s.token_sort").alias("token_sort"))


@query("str_token_set_ratio", _pair_sql("p_partkey, name_a, name_b, token_set"))
def str_token_set_ratio(spark, sf_dir):
    return _scored(Tables(spark, sf_dir)).select("p_partkey", "name_a", "name_b", F.col("s.token_set").alias("token_set"))


@query("str_combined_score", _pair_sql("p_partkey, name_a, name_b, token_sort, token_set, score"))
def str_combined_score(spark, sf_dir):
    return _scored(Tables(spark, sf_dir)).select("p_partkey", "name_a", "name_b", "s.*")


DISTINCT_NAMES_SQL = f"SELECT DISTINCT Organization AS name FROM ({TESTIMONY_SQL}) th WHERE Organization IS NOT NULL"

FUZZY_PAIRS_SQL = f"""
WITH names AS ({DISTINCT_NAMES_SQL}),
src AS (SELECT a.name AS name_a, b.name AS name_b FROM names a JOIN names b ON a.name < b.name),
{score_ctes('src', 'name_a', 'name_b')},
half AS (SELECT name_a, name_b, score FROM scored WHERE score >= {PAIR_THRESHOLD})
SELECT name_a AS ANCHOR, name_b AS MATCH, score AS SIMILARITY_SCORE FROM half
UNION ALL SELECT name_b, name_a, score FROM half
UNION ALL SELECT name, name, 100 FROM names"""


def _pairs(t: Tables):
    return fuzzy.fuzzy_pairs(roles.testimony(t), "Organization", PAIR_THRESHOLD)


@query("join_fuzzy_pairs", FUZZY_PAIRS_SQL)
def join_fuzzy_pairs(spark, sf_dir):
    return _pairs(Tables(spark, sf_dir))


# the busiest match of every name: most testimony, then smallest name
MATCHES_SQL = f"""
SELECT DISTINCT busiest AS MATCH FROM (
  SELECT list(close.MATCH ORDER BY volume.n DESC, close.MATCH)[1] AS busiest
  FROM (SELECT ANCHOR, MATCH FROM ({FUZZY_PAIRS_SQL}) s WHERE SIMILARITY_SCORE >= {VIEW_THRESHOLD}) close,
       (SELECT Organization, count(*) AS n FROM ({TESTIMONY_SQL}) t GROUP BY ALL) volume
  WHERE volume.Organization = close.MATCH
  GROUP BY close.ANCHOR) per_name"""


def _matches(t: Tables, pairs):
    pairs = pairs.filter(F.col("SIMILARITY_SCORE") >= VIEW_THRESHOLD)
    counts = roles.testimony(t).groupBy("Organization").agg(F.count(F.lit(1)).alias("RECORDS"))
    j = pairs.join(counts, pairs["MATCH"] == counts["Organization"])
    top = windows.top1_per_group(j, "ANCHOR", "MATCH", "RECORDS", "MATCH")
    return top.select("MATCH").distinct()


@query("win_anchor_top1", MATCHES_SQL)
def win_anchor_top1(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _matches(t, _pairs(t))


ANCHOR_VIEW_SQL = f"""
SELECT scored.ANCHOR, scored.MATCH, scored.SIMILARITY_SCORE FROM ({FUZZY_PAIRS_SQL}) scored
SEMI JOIN (SELECT MATCH AS wanted FROM ({MATCHES_SQL}) top WHERE contains(lower(MATCH), '{ANCHOR_FILTER.strip("%")}')) w
ON scored.ANCHOR = w.wanted"""


def _anchor_view(t: Tables):
    pairs = materialize(_pairs(t), "name-pairs")  # scored once, read by both sides
    m = _matches(t, pairs).filter(F.lower("MATCH").like(ANCHOR_FILTER))
    return pairs.join(m.select(F.col("MATCH").alias("_m")), pairs["ANCHOR"] == F.col("_m"), "left_semi")


@query("join_semi_anchor", ANCHOR_VIEW_SQL)
def join_semi_anchor(spark, sf_dir):
    return _anchor_view(Tables(spark, sf_dir))


@query("join_standard_org", f"""
WITH nc AS ({ANCHOR_VIEW_SQL})
SELECT th.Id, th.Organization, CAST(th.LDNumber AS INTEGER) AS LD_NUMBER,
       CAST(th.legislature AS INTEGER) AS LEGISLATURE, nc.ANCHOR AS STANDARD_ORG
FROM ({TESTIMONY_SQL}) th JOIN nc ON th.Organization = nc.MATCH""")
def join_standard_org(spark, sf_dir):
    """Testimony rows with the standard organisation of their name; a row
    fans out to every anchor its name is a match of.  The whole join is
    returned (the view's LIMIT 100 preview is left to the caller)."""
    t = Tables(spark, sf_dir)
    th = roles.testimony(t)
    nc = _anchor_view(t).select("ANCHOR", "MATCH")
    j = th.join(nc, th["Organization"] == nc["MATCH"])
    return j.select("Id", "Organization", F.col("LDNumber").cast("int").alias("LD_NUMBER"),
                    F.col("legislature").cast("int").alias("LEGISLATURE"), F.col("ANCHOR").alias("STANDARD_ORG"))


def _greedy(t: Tables):
    names = roles.testimony(t).select(F.col("Organization").alias("name"))
    return fuzzy.greedy_anchors(names, _pairs(t))


GREEDY_SQL = f"""
WITH RECURSIVE pairs AS ({FUZZY_PAIRS_SQL}),
e AS (SELECT ANCHOR AS a, MATCH AS b FROM pairs WHERE ANCHOR < MATCH),
nm AS (SELECT name, row_number() OVER (ORDER BY name) AS rn FROM ({DISTINCT_NAMES_SQL}) d),
q(rn, anchors) AS (
  SELECT 0, CAST([] AS VARCHAR[])
  UNION ALL
  SELECT q.rn + 1,
         CASE WHEN EXISTS (SELECT 1 FROM e WHERE e.b = nm.name AND list_contains(q.anchors, e.a))
              THEN q.anchors ELSE list_append(q.anchors, nm.name) END
  FROM q JOIN nm ON nm.rn = q.rn + 1),
fin AS (SELECT anchors FROM q WHERE rn = (SELECT max(rn) FROM q)),
lab AS (SELECT nm.name AS ORGANIZATION,
               CASE WHEN list_contains(fin.anchors, nm.name) THEN nm.name
                    ELSE (SELECT min(e.a) FROM e WHERE e.b = nm.name AND list_contains(fin.anchors, e.a)) END
               AS CLUSTER_ANCHOR
        FROM nm, fin)"""


@query("clu_greedy_anchor", GREEDY_SQL + "\nSELECT ORGANIZATION, CLUSTER_ANCHOR FROM lab")
def clu_greedy_anchor(spark, sf_dir):
    """Queue clustering of organisation names at score >= 80 (the reference
    compared against 0.8 and skipped names while mutating its queue; both
    are fixed).  The oracle walks the queue with a recursive CTE; the tests
    also compare with a brute-force queue."""
    g = _greedy(Tables(spark, sf_dir))
    return g.select(F.col("name").alias("ORGANIZATION"), F.col("anchor").alias("CLUSTER_ANCHOR"))


@query("clu_org_map", GREEDY_SQL + f"""
SELECT DISTINCT th.Organization AS ORGANIZATION, lab.CLUSTER_ANCHOR AS CLUSTER_LABEL
FROM ({TESTIMONY_SQL}) th JOIN lab ON th.Organization = lab.ORGANIZATION""")
def clu_org_map(spark, sf_dir):
    """Cluster map table (distinct organisation -> label) from the queue
    clustering, joined to every testimony name."""
    t = Tables(spark, sf_dir)
    g = _greedy(t)
    th = roles.testimony(t).select("Organization")
    m = th.join(g, th["Organization"] == g["name"]).select(
        F.col("Organization").alias("ORGANIZATION"), F.col("anchor").alias("CLUSTER_LABEL"))
    return m.distinct()
