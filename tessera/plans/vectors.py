"""Vector, clustering and parameter-search queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import vectors as vx
from tessera.operators import aggs, density, hdbscan, neighbours, sets, spanning, validity
from tessera.plans import roles
from tessera.plans.registry import query
from tessera.plans.roles import TESTIMONY_SQL
from tessera.session import materialize
from tessera.sources.tables import Tables

EPS = 0.65           # cosine eps for the test vectors (0.3 labels all noise)
MIN_SAMPLES = 4
GRID_EPS = [0.55, 0.6, 0.65]
GRID_MIN_SAMPLES = [3, 4]
SEARCH_SEED = 42
N_ITER = 3

VEC_SQL = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"


def _emb(t: Tables):
    return t.embeddings.select("vec_id", "embedding")


@query("vec_l2_normalize", f"""
WITH n AS ({VEC_SQL}),
u AS (SELECT vec_id, CASE WHEN sqrt(list_sum(list_transform(e, lambda x: x * x))) > 0
        THEN list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) ELSE e END AS u FROM n)
SELECT vec_id, round(sqrt(list_sum(list_transform(u, lambda x: x * x))), 6) AS norm,
       round(list_sum(u), 6) AS unit_sum, round(u[1], 6) AS unit_first FROM u""")
def vec_l2_normalize(spark, sf_dir):
    e = _emb(Tables(spark, sf_dir)).withColumn("u", vx.l2_normalize(F.col("embedding")))
    return e.select("vec_id", F.round(vx.norm2(F.col("u")), 6).alias("norm"),
                    F.round(F.aggregate("u", F.lit(0.0), lambda a, x: a + x), 6).alias("unit_sum"),
                    F.round(F.col("u")[0], 6).alias("unit_first"))


@query("join_eps_neighbours", f"""
WITH n AS ({VEC_SQL})
SELECT a.vec_id AS src, b.vec_id AS dst, round(1 - list_cosine_similarity(a.e, b.e), 6) AS dist
FROM n a JOIN n b ON a.vec_id < b.vec_id WHERE 1 - list_cosine_similarity(a.e, b.e) <= {EPS}""")
def join_eps_neighbours(spark, sf_dir):
    e = neighbours.eps_edges(_emb(Tables(spark, sf_dir)), "vec_id", "embedding", EPS)
    return e.select("src", "dst", F.round("dist", 6).alias("dist"))


def _topk_sql(k: int, value: str) -> str:
    return f"""
WITH n AS ({VEC_SQL}),
d AS (SELECT a.vec_id, b.vec_id AS nb, 1 - list_cosine_similarity(a.e, b.e) AS dist
      FROM n a JOIN n b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nb) AS rk FROM d)
SELECT vec_id, nb, {value}, CAST(rk AS BIGINT) AS rank FROM r WHERE rk <= {k}"""


@query("vec_cosine_topk", _topk_sql(5, "round(1 - dist, 6) AS similarity"))
def vec_cosine_topk(spark, sf_dir):
    t = neighbours.topk_neighbours(_emb(Tables(spark, sf_dir)), "vec_id", "embedding", 5)
    return t.select(F.col("id").alias("vec_id"), "nb", F.round(1 - F.col("dist"), 6).alias("similarity"),
                    F.col("rank").cast("long"))


@query("vec_knn_graph", _topk_sql(10, "round(dist, 6) AS dist"))
def vec_knn_graph(spark, sf_dir):
    t = neighbours.topk_neighbours(_emb(Tables(spark, sf_dir)), "vec_id", "embedding", 10)
    return t.select(F.col("id").alias("vec_id"), "nb", F.round("dist", 6).alias("dist"), F.col("rank").cast("long"))


def _dbscan_sql(settings, select: str) -> str:
    values = ", ".join(f"({s.param_id}, {s.eps}, {s.min_samples})" for s in settings)
    return f"""
WITH RECURSIVE params(param_id, eps, ms) AS (VALUES {values}),
n AS ({VEC_SQL}),
pr AS (SELECT p.param_id, a.vec_id AS i, b.vec_id AS j FROM n a JOIN n b ON a.vec_id <> b.vec_id
       JOIN params p ON 1 - list_cosine_similarity(a.e, b.e) <= p.eps),
cnt AS (SELECT p.param_id, n.vec_id, p.ms, 1 + count(pr.j) AS c FROM n CROSS JOIN params p
        LEFT JOIN pr ON pr.param_id = p.param_id AND pr.i = n.vec_id GROUP BY 1, 2, 3),
core AS (SELECT param_id, vec_id FROM cnt WHERE c >= ms),
ce AS (SELECT pr.param_id, pr.i, pr.j FROM pr
       JOIN core c1 ON c1.param_id = pr.param_id AND c1.vec_id = pr.i
       JOIN core c2 ON c2.param_id = pr.param_id AND c2.vec_id = pr.j),
reach(param_id, src, dst) AS (
  SELECT param_id, vec_id, vec_id FROM core
  UNION SELECT r.param_id, r.src, ce.j FROM reach r JOIN ce ON ce.param_id = r.param_id AND ce.i = r.dst),
comp AS (SELECT param_id, dst AS vec_id, min(src) AS root FROM reach GROUP BY 1, 2),
cl AS (SELECT param_id, vec_id, dense_rank() OVER (PARTITION BY param_id ORDER BY root) - 1 AS cluster FROM comp),
border AS (SELECT pr.param_id, pr.i AS vec_id, min(cl.cluster) AS cluster FROM pr
           JOIN cl ON cl.param_id = pr.param_id AND cl.vec_id = pr.j GROUP BY 1, 2),
lab AS (SELECT CAST(p.param_id AS BIGINT) AS param_id, n.vec_id,
               CAST(coalesce(cl.cluster, border.cluster, -1) AS BIGINT) AS cluster
        FROM n CROSS JOIN params p
        LEFT JOIN cl ON cl.param_id = p.param_id AND cl.vec_id = n.vec_id
        LEFT JOIN border ON border.param_id = p.param_id AND border.vec_id = n.vec_id)
{select}"""


ONE = [density.Setting(0, EPS, MIN_SAMPLES)]
REF_DEFAULT = [density.Setting(0, 0.3, MIN_SAMPLES)]
GRID = density.grid(GRID_EPS, GRID_MIN_SAMPLES)


def _dbscan(t: Tables, settings=ONE):
    return density.dbscan_grid(_emb(t), "vec_id", "embedding", settings).withColumn(
        "param_id", F.col("param_id").cast("long"))


@query("clu_dbscan", _dbscan_sql(ONE, "SELECT vec_id, cluster FROM lab"))
def clu_dbscan(spark, sf_dir):
    return _dbscan(Tables(spark, sf_dir)).select("vec_id", "cluster")


@query("clu_dbscan_reference_eps", _dbscan_sql(REF_DEFAULT, "SELECT vec_id, cluster FROM lab"))
def clu_dbscan_reference_eps(spark, sf_dir):
    """The reference default eps=0.3: on the test vectors every point is noise."""
    return _dbscan(Tables(spark, sf_dir), REF_DEFAULT).select("vec_id", "cluster")


@query("srch_dbscan_grid", _dbscan_sql(GRID, "SELECT param_id, vec_id, cluster FROM lab"))
def srch_dbscan_grid(spark, sf_dir):
    """All grid settings evaluated in one job (edges computed once)."""
    return _dbscan(Tables(spark, sf_dir), GRID).select("param_id", "vec_id", "cluster")


def _dbcv_sql(head: str, labels: str) -> str:
    """DBCV per ``param_id``: ``labels`` selects (param_id, vec_id, cluster).
    The spanning tree of a cluster is Prim's: each step keeps the points not yet
    in the tree with their best edge, ordered by (weight, ends)."""
    return f"""{head}
lb AS MATERIALIZED ({labels}),
dd AS MATERIALIZED (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.e, b.e) AS d FROM n a JOIN n b ON a.vec_id <> b.vec_id),
ls AS (SELECT a.param_id AS k, a.cluster AS c, a.vec_id AS i, dd.j, dd.d FROM lb a JOIN dd ON dd.i = a.vec_id
       JOIN lb b ON b.param_id = a.param_id AND b.cluster = a.cluster AND b.vec_id = dd.j WHERE a.cluster <> -1),
sz AS (SELECT param_id AS k, cluster AS c, count(*) AS n FROM lb WHERE cluster <> -1 GROUP BY ALL),
co AS MATERIALIZED (SELECT k, c, i, exp((mx + ln(sum(exp(lg - mx))) - ln(max(n) - 1)) / -max(dim)) AS core FROM (
  SELECT ls.*, sz.n, len(n.e) AS dim, -len(n.e) * ln(d) AS lg, max(-len(n.e) * ln(d)) OVER (PARTITION BY k, c, i) AS mx
  FROM ls JOIN sz USING (k, c) JOIN n ON n.vec_id = ls.i) GROUP BY k, c, i, mx),
pm(k, c, step, i, core, w, lo, hi) AS (
  SELECT s.k, s.c, 1, o.i, o.core, greatest(s.core, o.core, d), least(s.i, o.i), greatest(s.i, o.i)
  FROM (SELECT k, c, min(i) AS i, arg_min(core, i) AS core FROM co GROUP BY k, c) s JOIN co o ON o.k = s.k AND o.c = s.c AND o.i <> s.i
  JOIN dd ON dd.i = s.i AND dd.j = o.i
  UNION ALL
  SELECT k, c, step + 1, i, core, t[1], CAST(t[2] AS BIGINT), CAST(t[3] AS BIGINT) FROM (
    SELECT q.*, CASE WHEN [greatest(pc, core, d), least(pick, q.i), greatest(pick, q.i)] < [w, lo, hi]
                     THEN [greatest(pc, core, d), least(pick, q.i), greatest(pick, q.i)] ELSE [w, lo, hi] END AS t
    FROM (SELECT *, first_value(i) OVER o AS pick, first_value(core) OVER o AS pc FROM pm
          WINDOW o AS (PARTITION BY k, c ORDER BY w, lo, hi)) q
    JOIN dd ON dd.i = pick AND dd.j = q.i)),
tr AS MATERIALIZED (SELECT k, c, lo, hi, w FROM pm QUALIFY row_number() OVER (PARTITION BY k, c, step ORDER BY w, lo, hi) = 1),
dg AS (SELECT k, c, i FROM (SELECT k, c, lo AS i FROM tr UNION ALL SELECT k, c, hi FROM tr) GROUP BY k, c, i HAVING count(*) > 1),
sp AS (SELECT tr.k, tr.c, coalesce(max(w) FILTER (WHERE a.i IS NOT NULL AND b.i IS NOT NULL), max(w)) AS sparse
       FROM tr LEFT JOIN dg a ON a.k = tr.k AND a.c = tr.c AND a.i = lo LEFT JOIN dg b ON b.k = tr.k AND b.c = tr.c AND b.i = hi GROUP BY ALL),
inn AS MATERIALIZED (SELECT co.* FROM co LEFT JOIN dg USING (k, c, i)
        WHERE dg.i IS NOT NULL OR (k, c) NOT IN (SELECT (k, c) FROM dg)),
se AS (SELECT a.k, a.c, min(greatest(a.core, b.core, dd.d)) AS sep FROM inn a JOIN inn b ON a.k = b.k AND a.c <> b.c
       JOIN dd ON dd.i = a.i AND dd.j = b.i GROUP BY ALL),
va AS (SELECT sz.k, sum(sz.n * (sep - coalesce(sparse, 0)) / greatest(sep, coalesce(sparse, 0))) AS v
       FROM sz LEFT JOIN sp USING (k, c) LEFT JOIN se USING (k, c) GROUP BY sz.k),
scored AS (SELECT param_id, CAST(count(*) AS BIGINT) AS n_points,
       CAST(count(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS BIGINT) AS n_clusters,
       CAST(count(*) FILTER (WHERE cluster = -1) AS BIGINT) AS n_noise,
       CASE WHEN count(DISTINCT cluster) FILTER (WHERE cluster <> -1) <= 1 THEN CAST('-inf' AS DOUBLE) ELSE round(max(v) / count(*), 4) END AS score
  FROM lb LEFT JOIN va ON va.k = lb.param_id GROUP BY param_id)
"""


def _head(sql: str) -> str:
    """A statement's common tables, to go on with."""
    return sql.rstrip().removesuffix(",") + ","


def _search_tables(settings, sample: str = "TRUE") -> str:
    head = _dbscan_sql(settings, "").replace(f"n AS ({VEC_SQL})", f"n AS ({VEC_SQL} WHERE {sample})")
    return _dbcv_sql(_head(head), "SELECT param_id, vec_id, cluster FROM lab")


SEARCH_SQL = _search_tables(GRID)
BY_SCORE = """
SELECT scored.param_id, CAST(eps AS DOUBLE) AS eps, CAST(ms AS BIGINT) AS min_samples, n_points, n_clusters, n_noise, score,
       row_number() OVER (ORDER BY score DESC, scored.param_id) AS place
FROM scored JOIN params USING (param_id)"""


def _scored_search(df, settings):
    """(labels, settings with DBCV score, best first) of the rows of ``df``."""
    df = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    labels = density.dbscan_grid(df, "vec_id", "embedding", settings).withColumn("param_id", F.col("param_id").cast("long"))
    labels = materialize(labels, "search-labels")
    points = labels.join(df, "vec_id").select("param_id", F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "cluster")
    scored = validity.dbcv(points, ["param_id"]).withColumn("score", F.round("score", 4))
    eps = F.create_map(*[x for s in settings for x in (F.lit(s.param_id), F.lit(s.eps))])
    ms = F.create_map(*[x for s in settings for x in (F.lit(s.param_id), F.lit(s.min_samples))])
    key = F.col("param_id").cast("int")
    # one row per setting
    place = F.row_number().over(Window.orderBy(F.desc("score"), "param_id")).cast("long")
    return labels, scored.select("param_id", eps[key].alias("eps"), ms[key].cast("long").alias("min_samples"),
                                 "n_points", "n_clusters", "n_noise", "score").withColumn("place", place)


@query("srch_best_first", SEARCH_SQL + BY_SCORE)
def srch_best_first(spark, sf_dir):
    """Grid search: every setting with its DBCV score, best first (place 1 is
    the chosen setting)."""
    return _scored_search(_emb(Tables(spark, sf_dir)), GRID)[1].orderBy("place")


RANDOM = density.search_settings("random", GRID_EPS, GRID_MIN_SAMPLES, N_ITER, SEARCH_SEED)
SAMPLE_FRAC = 0.6


@query("srch_random_sample", _search_tables(
    RANDOM, f"CAST('0x' || substr(md5('{SEARCH_SEED}|' || CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) < {int(SAMPLE_FRAC * 2**32)}") + BY_SCORE)
def srch_random_sample(spark, sf_dir):
    """Random search on a row sample: ``N_ITER`` settings drawn without
    replacement, scored on the rows whose hash lies below the fraction."""
    rows = density.row_sample(_emb(Tables(spark, sf_dir)), "vec_id", SAMPLE_FRAC, SEARCH_SEED)
    return _scored_search(rows, RANDOM)[1].orderBy("place")


@query("clu_dbcv", _dbcv_sql(f"WITH RECURSIVE n AS ({VEC_SQL}),", "SELECT 0 AS param_id, vec_id, label AS cluster FROM embeddings")
       + "SELECT n_points, n_clusters, n_noise, score FROM scored")
def clu_dbcv(spark, sf_dir):
    """Validity of the given labels as a clustering of the vectors."""
    e = Tables(spark, sf_dir).embeddings
    points = e.select(F.lit(0).alias("param_id"), F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vec"),
                      F.col("label").cast("long").alias("cluster"))
    return validity.dbcv(points, ["param_id"]).select("n_points", "n_clusters", "n_noise", F.round("score", 4).alias("score"))


HDB_CLUSTER_SIZE, HDB_SAMPLES = 5, 3

# Prim on the mutual-reachability distances; equal weights do not change the sums
SPAN_SQL = f"""
WITH RECURSIVE n AS ({VEC_SQL}),
dd AS MATERIALIZED (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.e, b.e) AS d FROM n a, n b),
co AS MATERIALIZED (SELECT i, max(d) AS core FROM (SELECT i, d, row_number() OVER (PARTITION BY i ORDER BY d) AS r FROM dd) WHERE r <= {HDB_SAMPLES} GROUP BY i),
mr AS MATERIALIZED (SELECT dd.i, dd.j, greatest(a.core, b.core, d) AS w FROM dd JOIN co a ON a.i = dd.i JOIN co b ON b.i = dd.j),
pr(step, i, w) AS (
  SELECT 1, j, w FROM mr WHERE i = (SELECT min(vec_id) FROM n) AND j <> i
  UNION ALL
  SELECT step + 1, q.i, least(q.w, mr.w) FROM (SELECT *, first_value(i) OVER (ORDER BY w, i) AS pick FROM pr) q
  JOIN mr ON mr.i = pick AND mr.j = q.i WHERE q.i <> pick),
tr AS (SELECT step, min(w) AS w FROM pr GROUP BY step)
SELECT CAST(count(*) AS BIGINT) AS n_edges, round(sum(w), 6) AS total, round(min(w), 6) AS shortest, round(max(w), 6) AS longest FROM tr"""


@query("clu_span_tree", SPAN_SQL)
def clu_span_tree(spark, sf_dir):
    """The spanning tree under HDBSCAN: edges, total weight, extremes."""
    points = materialize(_emb(Tables(spark, sf_dir)).select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vec")), "span-points")
    points = materialize(points.join(spanning.core_distances(points, HDB_SAMPLES), "id"), "span-core")
    return spanning.spanning_tree(points).agg(
        F.count("*").alias("n_edges"), F.round(F.sum("w"), 6).alias("total"), F.round(F.min("w"), 6).alias("shortest"),
        F.round(F.max("w"), 6).alias("longest"))


@query("clu_hdbscan")
def clu_hdbscan(spark, sf_dir):
    return hdbscan.hdbscan(_emb(Tables(spark, sf_dir)), "vec_id", "embedding", HDB_CLUSTER_SIZE, HDB_SAMPLES)


def _grid_values_sql(settings) -> str:
    return ", ".join(f"({s.param_id}, {s.eps}, {s.min_samples})" for s in settings)


@query("srch_param_grid", f"""
SELECT CAST(p.param_id AS BIGINT) AS param_id, CAST(p.eps AS DOUBLE) AS eps, CAST(p.min_samples AS BIGINT) AS min_samples,
       CAST(c.n AS BIGINT) AS n_points
FROM (VALUES {_grid_values_sql(GRID)}) p(param_id, eps, min_samples), (SELECT count(*) AS n FROM embeddings) c""")
def srch_param_grid(spark, sf_dir):
    """The search space (cartesian product of the lists) attached to the
    data it will run on; generated by explode, not by a join."""
    n = _emb(Tables(spark, sf_dir)).agg(F.count(F.lit(1)).cast("long").alias("n_points"))
    arr = F.array(*[F.struct(F.lit(s.param_id).cast("long").alias("param_id"), F.lit(s.eps).alias("eps"),
                             F.lit(s.min_samples).cast("long").alias("min_samples")) for s in GRID])
    return n.select(F.explode(arr).alias("p"), "n_points").select("p.*", "n_points")


@query("srch_param_sample", f"""
SELECT CAST(param_id AS BIGINT) AS param_id, CAST(eps AS DOUBLE) AS eps, CAST(min_samples AS BIGINT) AS min_samples
FROM (VALUES {_grid_values_sql(GRID)}) p(param_id, eps, min_samples)
WHERE (SELECT count(*) FROM embeddings) > 0
ORDER BY md5('{SEARCH_SEED}|' || CAST(param_id AS VARCHAR)) LIMIT {N_ITER}""")
def srch_param_sample(spark, sf_dir):
    """A repeatable random subset of the grid (n_iter settings, seed 42)."""
    g = srch_param_grid(spark, sf_dir).filter(F.col("n_points") > 0).drop("n_points")
    key = F.md5(F.concat(F.lit(f"{SEARCH_SEED}|"), F.col("param_id").cast("string")))
    return sets.top_k(g, N_ITER, key)


NAMES_SQL = f"""
SELECT e.vec_id, p.p_name AS name, CAST(oc.cnt AS BIGINT) AS count FROM embeddings e
JOIN part p ON p.p_partkey = e.vec_id
JOIN (SELECT Organization, count(*) AS cnt FROM ({TESTIMONY_SQL}) th GROUP BY Organization) oc
  ON oc.Organization = p.p_name"""


def _names(t: Tables):
    """Organisation rows for clustering: one row per vector, named by the
    part with the same key, weighted by that name's testimony count."""
    counts = roles.testimony(t).groupBy("Organization").agg(F.count(F.lit(1)).cast("long").alias("count"))
    p = t.part.select(F.col("p_partkey").alias("vec_id"), F.col("p_name").alias("name"))
    return _emb(t).select("vec_id").join(p, "vec_id").join(counts, F.col("name") == F.col("Organization")) \
        .drop("Organization")


@query("agg_cluster_rep_max", _dbscan_sql(ONE, f"""
, nm AS ({NAMES_SQL}),
x AS (SELECT nm.*, lab.cluster FROM nm JOIN lab USING (vec_id)),
rep AS (SELECT cluster, arg_max(name, count * 1000000000 - vec_id) AS rep FROM x WHERE cluster <> -1 GROUP BY cluster)
SELECT x.vec_id, x.name, x.cluster, CASE WHEN x.cluster = -1 THEN x.name ELSE rep.rep END AS grouped_name
FROM x LEFT JOIN rep USING (cluster)""").replace("\n\n, nm AS", ",\nnm AS", 1))
def agg_cluster_rep_max(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = _names(t).join(_dbscan(t).select("vec_id", "cluster"), "vec_id")
    return aggs.representative_by_max(x, "cluster", "name", "count", "vec_id").select(
        "vec_id", "name", "cluster", "grouped_name")


@query("agg_cluster_rep_mode", _dbscan_sql(ONE, f"""
, nm AS ({NAMES_SQL}),
x AS (SELECT nm.*, lab.cluster FROM nm JOIN lab USING (vec_id)),
f AS (SELECT cluster, name, count(*) AS freq, min(vec_id) AS first FROM x WHERE cluster <> -1 GROUP BY 1, 2),
rep AS (SELECT cluster, arg_max(name, freq * 1000000000 - first) AS CLUSTER_LABEL FROM f GROUP BY cluster)
SELECT x.vec_id, x.name, x.cluster, rep.CLUSTER_LABEL FROM x LEFT JOIN rep USING (cluster)""").replace(
    "\n\n, nm AS", ",\nnm AS", 1))
def agg_cluster_rep_mode(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = _names(t).join(_dbscan(t).select("vec_id", "cluster"), "vec_id")
    return aggs.representative_by_mode(x, "cluster", "name", "vec_id").select(
        "vec_id", "name", "cluster", "CLUSTER_LABEL")


@query("srch_report", _dbscan_sql(GRID, f"""
, nm AS ({NAMES_SQL}),
x AS (SELECT nm.*, lab.param_id, lab.cluster FROM nm JOIN lab USING (vec_id)),
rep AS (SELECT param_id, cluster, arg_max(name, count * 1000000000 - vec_id) AS rep FROM x
        WHERE cluster <> -1 GROUP BY 1, 2),
g AS (SELECT x.*, CASE WHEN x.cluster = -1 THEN x.name ELSE rep.rep END AS grouped_name
      FROM x LEFT JOIN rep USING (param_id, cluster))
SELECT param_id, CAST(count(DISTINCT name) AS BIGINT) AS original_names,
       CAST(count(DISTINCT grouped_name) AS BIGINT) AS grouped_names,
       CAST(count(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS BIGINT) AS clusters,
       CAST(count(*) FILTER (WHERE cluster = -1) AS BIGINT) AS noise
FROM g GROUP BY param_id""").replace("\n\n, nm AS", ",\nnm AS", 1))
def srch_report(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = _names(t).join(_dbscan(t, GRID), "vec_id")
    key = F.struct(F.col("count"), (-F.col("vec_id")).alias("neg"))
    reps = (x.filter(F.col("cluster") != -1).groupBy("param_id", "cluster")
             .agg(F.max_by("name", key).alias("rep")))
    g = x.join(reps, ["param_id", "cluster"], "left").withColumn(
        "grouped_name", F.when(F.col("cluster") == -1, F.col("name")).otherwise(F.col("rep")))
    return g.groupBy("param_id").agg(
        F.countDistinct("name").cast("long").alias("original_names"),
        F.countDistinct("grouped_name").cast("long").alias("grouped_names"),
        F.countDistinct(F.when(F.col("cluster") != -1, F.col("cluster"))).cast("long").alias("clusters"),
        F.count_if(F.col("cluster") == -1).cast("long").alias("noise"))


@query("agg_cluster_summary", """
WITH x AS (SELECT e.label, p.p_name FROM embeddings e JOIN part p ON p.p_partkey = e.vec_id)
SELECT label, string_agg(DISTINCT p_name, ',' ORDER BY p_name) AS names, CAST(count(*) AS BIGINT) AS count
FROM x GROUP BY label ORDER BY count DESC, label ASC LIMIT 7""")
def agg_cluster_summary(spark, sf_dir):
    """Top-7 clusters by size with their sorted distinct names (a top-k
    report: the limit is the feature)."""
    t = Tables(spark, sf_dir)
    x = t.embeddings.select("vec_id", "label").join(
        t.part.select(F.col("p_partkey").alias("vec_id"), "p_name"), "vec_id")
    return aggs.cluster_summary(x, "label", "p_name", 7)


@query("dq_embedding_dim", """
SELECT CAST(len(embedding) AS BIGINT) AS dim, CAST(count(*) AS BIGINT) AS count FROM embeddings GROUP BY 1""")
def dq_embedding_dim(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    return e.groupBy(F.size("embedding").cast("long").alias("dim")).agg(F.count(F.lit(1)).cast("long").alias("count"))


# power iteration on the covariance, the second component after deflation
PCA_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
m AS (SELECT d, avg(v) AS mu FROM (SELECT unnest(x) AS v, unnest(range(len(x))) AS d FROM e) GROUP BY d),
z AS (SELECT vec_id, d, v - mu AS v FROM (SELECT vec_id, unnest(x) AS v, unnest(range(len(x))) AS d FROM e) JOIN m USING (d)),
cov AS (SELECT a.d AS i, list(s ORDER BY b) AS r FROM (SELECT p.d, q.d AS b, sum(p.v * q.v) / (SELECT count(*) - 1 FROM e) AS s
        FROM z p JOIN z q USING (vec_id) GROUP BY ALL) a GROUP BY a.d),
mat AS (SELECT list(r ORDER BY i) AS c FROM cov),
p1(k, u) AS (SELECT 0, list_transform(range(len(c)), lambda i: 1.0 + i / 100.0) FROM mat UNION ALL
  SELECT k + 1, list_transform(w, lambda t: t / sqrt(list_dot_product(w, w))) FROM (
    SELECT k, list_transform(c, lambda r: list_dot_product(r, u)) AS w FROM p1, mat WHERE k < 4000)),
v1 AS (SELECT u AS v1 FROM p1 WHERE k = 4000),
l1 AS (SELECT v1, list_dot_product(v1, list_transform(c, lambda r: list_dot_product(r, v1))) AS l FROM v1, mat),
p2(k, u) AS (SELECT 0, list_transform(range(len(c)), lambda i: 1.0 - i / 90.0) FROM mat UNION ALL
  SELECT k + 1, list_transform(w, lambda t: t / sqrt(list_dot_product(w, w))) FROM (
    SELECT k, list_transform(range(1, len(u) + 1), lambda i: list_dot_product(c[i], u) - l * v1[i] * list_dot_product(v1, u)) AS w
    FROM p2, mat, l1 WHERE k < 4000)),
v2 AS (SELECT u AS v2 FROM p2 WHERE k = 4000)
SELECT vec_id, round(abs(list_dot_product(x, v1)), 4) AS pc1, round(abs(list_dot_product(x, v2)), 4) AS pc2 FROM e, v1, v2"""


@query("vec_pca2", PCA_SQL)
def vec_pca2(spark, sf_dir):
    """Absolute scores on two principal components (pyspark.ml PCA; the sign
    of a component is arbitrary)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    e = _emb(Tables(spark, sf_dir)).withColumn("features", array_to_vector("embedding"))
    model = PCA(k=2, inputCol="features", outputCol="pca").fit(e)
    out = model.transform(e).withColumn("pc", vector_to_array("pca"))
    return out.select("vec_id", F.round(F.abs(F.col("pc")[0]), 4).alias("pc1"), F.round(F.abs(F.col("pc")[1]), 4).alias("pc2"))
