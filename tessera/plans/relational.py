"""Relational queries: filters, projections, aggregates, windows, joins,
sets, sort/limit/sample over the role views (see ``roles``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.strings import like
from tessera.operators import aggs, filters, joins, sets, windows
from tessera.operators.ordering import with_position
from tessera.plans import roles
from tessera.plans.registry import query
from tessera.plans.roles import BILLS_SQL, FULL_TEXT_SQL, TESTIMONY_FULL_SQL, TESTIMONY_SQL, with_views
from tessera.sources import landing
from tessera.sources.tables import Tables

# The stance patterns of the reference's classification
# script (case-sensitive LIKE), in its order.
STANCE_PATTERNS = {
    "IN_SUPPORT_COUNT": "%in%support%of%",
    "IN_OPPOSITION_COUNT": "%in%opposition%to%",
    "NEITHER": "%neither%for%nor%against%",
}
# The invented test prose has none of the stance words; a second pattern
# set with words that occur exercises the same plan with non-zero counts.
PROBE_PATTERNS = {
    "IN_SUPPORT_COUNT": "%in%the%of%",
    "IN_OPPOSITION_COUNT": "%and%the%",
    "NEITHER": "%de%la%",
}


def _stance(df, patterns):
    return aggs.conditional_counts(
        df, "doc_text", patterns,
        both={"SUPPORT_AND_OPP": ("IN_SUPPORT_COUNT", "IN_OPPOSITION_COUNT")})


def _stance_sql(p):
    return f"""
SELECT count(*) FILTER (WHERE doc_text LIKE '{p['IN_SUPPORT_COUNT']}') AS IN_SUPPORT_COUNT,
       count(*) FILTER (WHERE doc_text LIKE '{p['IN_OPPOSITION_COUNT']}') AS IN_OPPOSITION_COUNT,
       count(*) FILTER (WHERE doc_text LIKE '{p['NEITHER']}') AS NEITHER,
       count(*) FILTER (WHERE doc_text LIKE '{p['IN_SUPPORT_COUNT']}'
                        AND doc_text LIKE '{p['IN_OPPOSITION_COUNT']}') AS SUPPORT_AND_OPP,
       count(*) AS TOTAL
FROM ft"""


@query("agg_stance_counts", with_views(_stance_sql(STANCE_PATTERNS), ft=FULL_TEXT_SQL))
def agg_stance_counts(spark, sf_dir):
    return _stance(roles.full_text(Tables(spark, sf_dir)), STANCE_PATTERNS)


@query("agg_stance_counts_probe", with_views(_stance_sql(PROBE_PATTERNS), ft=FULL_TEXT_SQL))
def agg_stance_counts_probe(spark, sf_dir):
    return _stance(roles.full_text(Tables(spark, sf_dir)), PROBE_PATTERNS)


@query("agg_stance_by_session", with_views(f"""
SELECT session,
       count(*) FILTER (WHERE doc_text LIKE '{PROBE_PATTERNS['IN_SUPPORT_COUNT']}') AS IN_SUPPORT_COUNT,
       count(*) AS TOTAL
FROM ft GROUP BY session""", ft=FULL_TEXT_SQL))
def agg_stance_by_session(spark, sf_dir):
    ft = roles.full_text(Tables(spark, sf_dir))
    c = F.col("doc_text")
    return ft.groupBy("session").agg(
        F.count_if(like(c, PROBE_PATTERNS["IN_SUPPORT_COUNT"])).cast("long").alias("IN_SUPPORT_COUNT"),
        F.count(F.lit(1)).cast("long").alias("TOTAL"))


# ---------------------------------------------------------------- filters
@query("flt_usable_text", with_views("""
SELECT doc_id, session, CAST(length(doc_text) AS BIGINT) AS n_chars FROM ft
WHERE doc_text IS NOT NULL AND doc_text <> 'null' AND length(doc_text) > 10""", ft=FULL_TEXT_SQL))
def flt_usable_text(spark, sf_dir):
    ft = filters.usable_text(roles.full_text(Tables(spark, sf_dir)))
    return ft.select("doc_id", "session", F.length("doc_text").cast("long").alias("n_chars"))


@query("flt_session_gate", with_views("""
SELECT doc_id, session FROM ft WHERE session >= 126""", ft=FULL_TEXT_SQL))
def flt_session_gate(spark, sf_dir):
    return filters.session_gate(roles.full_text(Tables(spark, sf_dir))).select("doc_id", "session")


@query("flt_testimony_active", f"""
SELECT legislature, CAST(count(*) AS BIGINT) AS n_active,
       CAST(count(*) FILTER (WHERE Inactive IS NULL) AS BIGINT) AS n_null_flag,
       CAST(count(*) FILTER (WHERE LastName IS NULL) AS BIGINT) AS n_null_name
FROM ({TESTIMONY_FULL_SQL}) a
WHERE (Inactive IS NULL OR NOT Inactive) AND NOT coalesce(starts_with(LastName, '@'), FALSE)
GROUP BY legislature""")
def flt_testimony_active(spark, sf_dir):
    a = filters.active_testimony(roles.testimony_full(Tables(spark, sf_dir)))
    return a.groupBy("legislature").agg(
        F.count(F.lit(1)).cast("long").alias("n_active"),
        F.count_if(F.col("Inactive").isNull()).cast("long").alias("n_null_flag"),
        F.count_if(F.col("LastName").isNull()).cast("long").alias("n_null_name"))


@query("src_testimony_attrs", f"""
SELECT a.*, row_number() OVER (ORDER BY LastName NULLS FIRST, FirstName NULLS FIRST, Organization NULLS FIRST, Id) - 1 AS position FROM ({TESTIMONY_FULL_SQL}) a
SEMI JOIN (SELECT DISTINCT paperNumber, legislature FROM ({BILLS_SQL}) b) r
  ON r.paperNumber = a.LDNumber AND r.legislature = a.legislature
WHERE (Inactive IS NULL OR NOT Inactive) AND NOT coalesce(starts_with(LastName, '@'), FALSE)""")
def src_testimony_attrs(spark, sf_dir):
    """All testimony fields for every requested (paper, session), in the
    interface's order, which ``position`` states: the per-paper calls become
    one semi-join against the bill list (in ``testimony_full``).  The nested request is flattened to dotted columns."""
    t = Tables(spark, sf_dir)
    a = filters.active_testimony(roles.testimony_full(t, papers=roles.bills(t)))
    out = landing.flatten(a)
    return with_position(out, [*(F.asc_nulls_first(c) for c in ("LastName", "FirstName", "Organization")), "Id"], "position")


@query("flt_like_lower", """
SELECT p_partkey, p_name FROM part
WHERE lower(p_name) LIKE '%red%' OR lower(p_name) LIKE '%gear%'""")
def flt_like_lower(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name")
    return filters.like_any_lower(p, "p_name", ["RED", "gear"])


@query("flt_label_eq", with_views("""
SELECT Id, Organization FROM th WHERE Organization = 'red widget'""", th=TESTIMONY_SQL))
def flt_label_eq(spark, sf_dir):
    th = roles.testimony(Tables(spark, sf_dir))
    return th.filter(F.col("Organization") == "red widget").select("Id", "Organization")


@query("flt_not_null_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS filed
FROM orders WHERE o_orderdate IS NOT NULL""")
def flt_not_null_date(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    o = filters.not_null(o, "o_orderdate")
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("filed"))


UNION_SQL = """
SELECT CAST(c_nationkey AS BIGINT) AS id, 'customer' AS src FROM customer
UNION ALL SELECT CAST(s_nationkey AS BIGINT) AS id, 'supplier' AS src FROM supplier
UNION ALL SELECT CAST(NULL AS BIGINT) AS id, 'null_row' AS src FROM region WHERE r_regionkey = 0
"""


def _union(t):
    c = t.customer.select(F.col("c_nationkey").cast("long").alias("id"), F.lit("customer").alias("src"))
    s = t.supplier.select(F.col("s_nationkey").cast("long").alias("id"), F.lit("supplier").alias("src"))
    n = t.region.filter(F.col("r_regionkey") == 0).select(F.lit(None).cast("long").alias("id"),
                                                          F.lit("null_row").alias("src"))
    return sets.union_all(c, s, n)


@query("set_union_all", UNION_SQL)
def set_union_all(spark, sf_dir):
    return _union(Tables(spark, sf_dir))


@query("flt_model_ref", f"SELECT id, src FROM ({UNION_SQL}) u WHERE id = 1")
def flt_model_ref(spark, sf_dir):
    return _union(Tables(spark, sf_dir)).filter(F.col("id") == 1)


@query("set_distinct", with_views("SELECT DISTINCT Organization, PolicyArea FROM th", th=TESTIMONY_SQL))
def set_distinct(spark, sf_dir):
    return roles.testimony(Tables(spark, sf_dir)).select("Organization", "PolicyArea").distinct()


@query("prj_bill_detail", f"SELECT * EXCLUDE (body) FROM ({roles.bills_full_sql()}) x")
def prj_bill_detail(spark, sf_dir):
    """Every bill text field but the text itself."""
    return roles.bills_full(Tables(spark, sf_dir)).drop("body")


@query("prj_bill_text", roles.bills_full_sql())
def prj_bill_text(spark, sf_dir):
    return roles.bills_full(Tables(spark, sf_dir))


@query("prj_query_urls", with_views("""
SELECT paperNumber, legislature,
       'https://api.example/testimony?' || 'paperNumber=' || replace(url_encode(CAST(paperNumber AS VARCHAR)), '%20', '+')
       || '&legislature=' || replace(url_encode(CAST(legislature AS VARCHAR)), '%20', '+')
       || '&type=' || replace(url_encode(requestItemType), '%20', '+') AS query_url
FROM b""", b=BILLS_SQL))
def prj_query_urls(spark, sf_dir):
    b = roles.bills(Tables(spark, sf_dir)).select("paperNumber", "legislature", "requestItemType")
    return filters.query_urls(b, "https://api.example/testimony",
                              {"paperNumber": "paperNumber", "legislature": "legislature",
                               "type": "requestItemType"}).drop("requestItemType")


# ------------------------------------------------------------ aggregates
@query("agg_watermark_session", with_views(
    "SELECT CAST(coalesce(max(legislature), 122) AS BIGINT) AS latest_session FROM b", b=BILLS_SQL))
def agg_watermark_session(spark, sf_dir):
    return aggs.max_with_default(roles.bills(Tables(spark, sf_dir)), "legislature", 122, "latest_session")


@query("agg_org_counts", with_views(
    "SELECT Organization, CAST(count(*) AS BIGINT) AS RECORDS FROM th GROUP BY Organization", th=TESTIMONY_SQL))
def agg_org_counts(spark, sf_dir):
    return aggs.group_count(roles.testimony(Tables(spark, sf_dir)), ["Organization"], "RECORDS")


@query("agg_cardinality", with_views("""
SELECT CAST(count(DISTINCT Organization) + max(CASE WHEN Organization IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_Organization,
       CAST(count(DISTINCT PolicyArea) + max(CASE WHEN PolicyArea IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_PolicyArea,
       CAST(count(DISTINCT LDNumber) + max(CASE WHEN LDNumber IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_LDNumber
FROM th""", th=TESTIMONY_SQL))
def agg_cardinality(spark, sf_dir):
    return aggs.cardinality(roles.testimony(Tables(spark, sf_dir)), ["Organization", "PolicyArea", "LDNumber"])


@query("agg_value_counts", with_views("""
SELECT PolicyArea, CAST(count(*) AS BIGINT) AS count FROM th
WHERE PolicyArea IS NOT NULL GROUP BY PolicyArea""", th=TESTIMONY_SQL))
def agg_value_counts(spark, sf_dir):
    return aggs.value_counts(roles.testimony(Tables(spark, sf_dir)), "PolicyArea")


EVENT_CARDS = {"click": ["click"], "view_or_purchase": ["view", "purchase"], "error": ["error"]}


@query("agg_filtered_cards", """
SELECT CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS click,
       CAST(count(*) FILTER (WHERE event_type IN ('view', 'purchase')) AS BIGINT) AS view_or_purchase,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS error,
       CAST(count(*) FILTER (WHERE event_type IS NULL
              OR event_type NOT IN ('click', 'view', 'purchase', 'error')) AS BIGINT) AS other,
       CAST(count(*) AS BIGINT) AS total
FROM events""")
def agg_filtered_cards(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_type")
    et = F.col("event_type")
    known = [v for vs in EVENT_CARDS.values() for v in vs]
    preds = {name: et.isin(vals) for name, vals in EVENT_CARDS.items()}
    preds["other"] = et.isNull() | ~et.isin(known)
    preds["total"] = F.lit(True)
    return aggs.filtered_counts(ev, preds)


@query("agg_year_bins", """
SELECT strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year_start, o_orderpriority,
       CAST(count(*) AS BIGINT) AS count
FROM orders GROUP BY 1, 2""")
def agg_year_bins(spark, sf_dir):
    return aggs.time_bins(Tables(spark, sf_dir).orders, "o_orderdate", "year", "o_orderpriority")


@query("agg_event_day_bins", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day_start, event_type,
       CAST(count(*) AS BIGINT) AS count
FROM events GROUP BY 1, 2""")
def agg_event_day_bins(spark, sf_dir):
    return aggs.time_bins(Tables(spark, sf_dir).events, "ts", "day", "event_type")


CUST_REGION_SQL = """
SELECT c.c_custkey, n.n_name, r.r_name FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""


def _cust_region(t):
    n = F.broadcast(t.nation)   # 25 rows by schema
    r = F.broadcast(t.region)   # 5 rows by schema
    c = t.customer.select("c_custkey", "c_nationkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey)
             .select("c_custkey", "n_name", "r_name"))


@query("agg_group_sorted", f"""
WITH c AS (SELECT r_name, n_name, CAST(count(*) AS BIGINT) AS cnt FROM ({CUST_REGION_SQL}) x GROUP BY 1, 2),
     f AS (SELECT *, CAST(sum(cnt) OVER (PARTITION BY r_name) AS BIGINT) AS family_total FROM c)
SELECT r_name, n_name, cnt, family_total,
       CAST(dense_rank() OVER (ORDER BY family_total DESC, r_name ASC) AS BIGINT) AS family_rank
FROM f""")
def agg_group_sorted(spark, sf_dir):
    return aggs.counts_with_group_rank(_cust_region(Tables(spark, sf_dir)), "r_name", "n_name")


TOP_FAMILIES = 3


def _families(t):
    """Customer -> region 'family'; regions outside the top 3 by customer
    count, and customers with no region, become 'Other'."""
    cr = _cust_region(t)
    top = (cr.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), F.asc("r_name")).limit(TOP_FAMILIES)
             .select("r_name", F.lit(True).alias("_top")))
    n = t.nation.select("n_nationkey", "n_regionkey")
    lk = (n.join(F.broadcast(t.region), n.n_regionkey == F.col("r_regionkey"))
           .join(F.broadcast(top), "r_name", "left")
           .select("n_nationkey", F.when(F.col("_top"), F.col("r_name")).alias("family")))
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return joins.lookup_with_default(c, lk, "n_nationkey", "family")


FAMILY_SQL = f"""
WITH cr AS ({CUST_REGION_SQL}),
top AS (SELECT r_name FROM cr GROUP BY r_name ORDER BY count(*) DESC, r_name ASC LIMIT {TOP_FAMILIES}),
lk AS (SELECT n.n_nationkey, trim(t.r_name) AS family FROM nation n
       JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN top t ON t.r_name = r.r_name)
SELECT c.c_custkey, c.c_nationkey, coalesce(lk.family, 'Other') AS family
FROM customer c LEFT JOIN lk ON c.c_nationkey = lk.n_nationkey
"""


@query("join_lookup_other", FAMILY_SQL)
def join_lookup_other(spark, sf_dir):
    return _families(Tables(spark, sf_dir)).withColumnRenamed("n_nationkey", "c_nationkey") \
        .select("c_custkey", "c_nationkey", "family")


@query("agg_domain_order", f"""
SELECT family, CAST(count(*) AS BIGINT) AS count,
       CAST(row_number() OVER (ORDER BY count(*) DESC, family ASC) AS BIGINT) AS position
FROM ({FAMILY_SQL}) f WHERE family <> 'Other' GROUP BY family""")
def agg_domain_order(spark, sf_dir):
    f = _families(Tables(spark, sf_dir)).filter(F.col("family") != "Other")
    cnt = aggs.group_count(f, ["family"])
    from pyspark.sql import Window
    return cnt.withColumn("position",
                          F.row_number().over(Window.orderBy(F.desc("count"), F.asc("family"))).cast("long"))


@query("agg_grouped_ols", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY l_returnflag""")
def agg_grouped_ols(spark, sf_dir):
    return aggs.grouped_ols(Tables(spark, sf_dir).lineitem, "l_returnflag", "l_extendedprice", "l_quantity")


@query("agg_type_profile", with_views("""
SELECT requestItemType, CAST(count(*) AS BIGINT) AS count FROM b GROUP BY ROLLUP (requestItemType)""",
                                      b=BILLS_SQL))
def agg_type_profile(spark, sf_dir):
    return aggs.profile_with_total(roles.bills(Tables(spark, sf_dir)), "requestItemType")


@query("agg_trend_names", with_views("""
SELECT legislature, Organization, CAST(count(*) AS BIGINT) AS name_records,
       CAST(sum(count(*)) OVER (PARTITION BY legislature) AS BIGINT) AS records,
       CAST(count(Organization) OVER (PARTITION BY legislature) AS BIGINT) AS distinct_names
FROM th GROUP BY legislature, Organization QUALIFY Organization IS NOT NULL""", th=TESTIMONY_SQL))
def agg_trend_names(spark, sf_dir):
    return aggs.trend_with_names(roles.testimony(Tables(spark, sf_dir)), "legislature", "Organization")


@query("agg_policy_breadth", with_views("""
WITH per AS (SELECT Organization, legislature, count(DISTINCT PolicyArea) AS areas FROM th GROUP BY 1, 2)
SELECT Organization, round(avg(areas), 6) AS avg_areas, CAST(max(areas) AS BIGINT) AS max_areas,
       CAST(count(*) AS BIGINT) AS sessions
FROM per GROUP BY Organization""", th=TESTIMONY_SQL))
def agg_policy_breadth(spark, sf_dir):
    return aggs.breadth(roles.testimony(Tables(spark, sf_dir)), "Organization", "legislature", "PolicyArea")


@query("agg_weighted_repeat", with_views("""
WITH w AS (SELECT Organization, count(*) AS weight FROM th GROUP BY Organization)
SELECT w.Organization, CAST(w.weight AS BIGINT) AS weight, CAST(count(*) AS BIGINT) AS repeated_rows
FROM w, range(w.weight) r GROUP BY w.Organization, w.weight""", th=TESTIMONY_SQL))
def agg_weighted_repeat(spark, sf_dir):
    w = aggs.group_count(roles.testimony(Tables(spark, sf_dir)), ["Organization"], "weight")
    rep = aggs.repeat_by_weight(w, "weight")
    return rep.groupBy("Organization", "weight").agg(F.count(F.lit(1)).cast("long").alias("repeated_rows"))


# ----------------------------------------------------- window semantics
@query("win_org_count", with_views("""
SELECT Id, Organization, CAST(count(*) OVER (PARTITION BY Organization) AS BIGINT) AS count FROM th""",
                                   th=TESTIMONY_SQL))
def win_org_count(spark, sf_dir):
    th = roles.testimony(Tables(spark, sf_dir)).select("Id", "Organization")
    return windows.count_over(th, "Organization")


@query("win_first_seen", with_views("""
SELECT legislature, LDNumber, Id, Organization FROM (
  SELECT *, row_number() OVER (PARTITION BY legislature, LDNumber ORDER BY Id) AS rn FROM th) x
WHERE rn = 1""", th=TESTIMONY_SQL))
def win_first_seen(spark, sf_dir):
    th = roles.testimony(Tables(spark, sf_dir))
    return windows.first_per_key(th, ["legislature", "LDNumber"], "Id", ["Organization"])


# ------------------------------------------------------------------ joins
@query("join_anti_unprocessed", with_views("""
SELECT t.doc_id, t.session, CAST(length(t.doc_text) AS BIGINT) AS n_chars FROM ft t
WHERE t.doc_text IS NOT NULL AND t.doc_text <> 'null' AND length(t.doc_text) > 10
  AND NOT EXISTS (SELECT 1 FROM labels s WHERE s.doc_id = t.doc_id)""", ft=FULL_TEXT_SQL))
def join_anti_unprocessed(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ft = filters.usable_text(roles.full_text(t))
    todo = joins.unprocessed(ft, roles.processed_docs(t))
    return todo.select("doc_id", "session", F.length("doc_text").cast("long").alias("n_chars"))


@query("join_bill_testimony", with_views("""
SELECT b.legislature, b.paperNumber, CAST(count(*) AS BIGINT) AS n_testimony
FROM (SELECT DISTINCT legislature, paperNumber FROM b) b
JOIN th ON th.LDNumber = b.paperNumber AND th.legislature = b.legislature
GROUP BY b.legislature, b.paperNumber""", b=BILLS_SQL, th=TESTIMONY_SQL))
def join_bill_testimony(spark, sf_dir):
    t = Tables(spark, sf_dir)
    b = roles.bills(t).select("legislature", "paperNumber")
    th = roles.testimony(t).select("legislature", F.col("LDNumber").alias("paperNumber"), "Id")
    j = joins.parent_child(b, th, ["legislature", "paperNumber"])  # a paper number recurs in every session
    return aggs.group_count(j, ["legislature", "paperNumber"], "n_testimony")


def _name_key(c):
    """Normalised token-sorted key of a name (the costly per-name step)."""
    toks = F.split(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " ")), " ")
    return F.array_join(F.array_sort(toks), " ")


@query("join_distinct_mapback", with_views("""
SELECT Id, Organization,
       array_to_string(list_sort(string_split(trim(regexp_replace(lower(Organization), '[^\\p{L}\\p{N}_]+', ' ', 'g')), ' ')), ' ') AS name_key
FROM th""", th=TESTIMONY_SQL))
def join_distinct_mapback(spark, sf_dir):
    th = roles.testimony(Tables(spark, sf_dir)).select("Id", "Organization")
    return joins.compute_on_distinct(th, "Organization", _name_key, "name_key")


# -------------------------------------------------------- sort / sample
@query("sort_distinct_pairs", with_views("""
SELECT DISTINCT legislature, LDNumber AS paperNumber FROM th WHERE LDNumber IS NOT NULL""", th=TESTIMONY_SQL))
def sort_distinct_pairs(spark, sf_dir):
    th = roles.testimony(Tables(spark, sf_dir))
    return (th.filter(F.col("LDNumber").isNotNull())
              .select("legislature", F.col("LDNumber").alias("paperNumber")).distinct()
              .orderBy("legislature", "paperNumber"))


@query("sort_topk", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 20""")
def sort_topk(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return sets.top_k(o, 20, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("smp_hash_fraction", """
SELECT doc_id, lang FROM documents
WHERE CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 < 200""")
def smp_hash_fraction(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang")
    return sets.hash_fraction(d, "doc_id", 0.2)


# -------------------------------------------------------- session plans
@query("src_session_range", with_views("""
SELECT CAST(s AS BIGINT) AS session
FROM (SELECT coalesce(max(legislature), 122) AS lo FROM b WHERE status = 'F') w,
     (SELECT max(legislature) AS hi FROM b) c,
     range(w.lo, c.hi + 1) r(s)""", b=BILLS_SQL))
def src_session_range(spark, sf_dir):
    """Sessions to (re)load: from the latest fully loaded session (inclusive)
    to the current one."""
    b = roles.bills(Tables(spark, sf_dir))
    bounds = b.agg(
        F.coalesce(F.max(F.when(F.col("status") == "F", F.col("legislature"))), F.lit(122)).alias("lo"),
        F.max("legislature").alias("hi"))
    return bounds.select(F.explode(F.sequence(F.col("lo").cast("long"), F.col("hi").cast("long"))).alias("session"))


PAGE_SIZE = 500


@query("src_page_plan", with_views(f"""
WITH tot AS (SELECT legislature, count(*) AS total FROM b GROUP BY legislature)
SELECT CAST(legislature AS BIGINT) AS legislature, CAST(o AS BIGINT) AS page_offset
FROM tot, range(0, total, {PAGE_SIZE}) r(o) WHERE total > 0""", b=BILLS_SQL))
def src_page_plan(spark, sf_dir):
    """Page offsets 0, L, 2L, ... below each session's hit total (page 0 once)."""
    b = roles.bills(Tables(spark, sf_dir))
    tot = b.groupBy("legislature").agg(F.count(F.lit(1)).alias("total")).filter(F.col("total") > 0)
    return tot.select(F.col("legislature").cast("long").alias("legislature"),
                      F.explode(F.sequence(F.lit(0).cast("long"), (F.col("total") - 1).cast("long"),
                                 F.lit(PAGE_SIZE).cast("long"))).alias("page_offset"))
