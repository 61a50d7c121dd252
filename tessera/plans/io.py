"""Source and sink queries.  Each lands data from a driver table into a
fresh folder under the shared checkpoint root, reads it back with the
source under test and reports per-group aggregates, which the oracle
computes from the original table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.operators import aggs
from tessera.plans import roles
from tessera.plans.vectors import SEARCH_SQL
from tessera.plans.registry import ORACLES, QUERIES, query
from tessera.plans.roles import BILLS_SQL, FULL_TEXT_SQL, with_views
from tessera.session import scratch_dir
from tessera.sources import landing, sinks
from tessera.sources.tables import TABLE_NAMES, Tables

PAGE_KEYS = 500  # bill keys per landed response page

BILL_SOURCE = StructType([
    StructField("paperNumber", LongType()), StructField("ldNumber", LongType()),
    StructField("legislature", LongType()), StructField("requestItemType", StringType()),
    StructField("title", StringType()),
])


def _land_bill_pages(spark, t: Tables) -> str:
    """Write bills as search-API pages: {"hits": {"total": {"value": n},
    "hits": [{"_source": {...}}, ...]}}, one page per key range of a
    session (at most PAGE_KEYS hits each)."""
    b = roles.bills(t).select(F.col("paperNumber").cast("long"), F.col("ldNumber").cast("long"),
                              F.col("legislature").cast("long"), "requestItemType", "title")
    totals = b.groupBy("legislature").agg(F.count(F.lit(1)).alias("total"))
    pages = (b.withColumn("page", F.floor(F.col("paperNumber") / PAGE_KEYS))
              .groupBy("legislature", "page")
              .agg(F.collect_list(F.struct(F.struct(*BILL_SOURCE.fieldNames()).alias("_source"))).alias("hits")))
    pages = pages.join(totals, "legislature")
    doc = pages.select(F.struct(F.struct(F.col("total").alias("value")).alias("total"),
                                F.col("hits").alias("hits")).alias("hits"))
    path = scratch_dir(spark, "bill-pages")
    doc.write.mode("overwrite").json(path)
    return path


@query("src_json_hits", with_views("""
SELECT CAST(legislature AS BIGINT) AS legislature, CAST(count(*) AS BIGINT) AS bills,
       CAST(sum(paperNumber) AS BIGINT) AS key_sum, CAST(count(DISTINCT requestItemType) AS BIGINT) AS types
FROM b GROUP BY legislature""", b=BILLS_SQL))
def src_json_hits(spark, sf_dir):
    t = Tables(spark, sf_dir)
    src = landing.read_hits(spark, _land_bill_pages(spark, t), BILL_SOURCE)
    return src.groupBy("legislature").agg(
        F.count(F.lit(1)).cast("long").alias("bills"), F.sum("paperNumber").cast("long").alias("key_sum"),
        F.countDistinct("requestItemType").cast("long").alias("types"))


@query("src_bad_pages", with_views("""
SELECT CAST(legislature AS BIGINT) AS legislature, CAST(1 AS BIGINT) AS bad_pages, CAST(count(*) AS BIGINT) AS bills
FROM b GROUP BY legislature""", b=BILLS_SQL))
def src_bad_pages(spark, sf_dir):
    """Landed pages plus one page per session that broke off after its first
    hit: the good pages' bills are read, the bad pages are counted."""
    t = Tables(spark, sf_dir)
    path = _land_bill_pages(spark, t)
    torn = (roles.bills(t).select(F.col("legislature").cast("long").alias("legislature")).distinct()
            .select(F.format_string('{"hits":{"total":{"value":1},"hits":[{"_source":{"legislature":%d,', "legislature")))
    torn.write.mode("append").text(path)
    bills = landing.read_hits(spark, path, BILL_SOURCE).groupBy("legislature").agg(F.count("*").alias("bills"))
    bad = landing.read_bad_pages(spark, path, BILL_SOURCE).groupBy(
        F.regexp_extract("page", r'"legislature":(\d+)', 1).cast("long").alias("legislature")).agg(F.count("*").alias("bad_pages"))
    return bad.join(bills, "legislature").select("legislature", "bad_pages", "bills")


@query("src_flatten_nested", with_views(f"""
SELECT CAST(t.total AS BIGINT) AS "hits.total.value", CAST(count(*) AS BIGINT) AS n_hits
FROM b JOIN (SELECT legislature, count(*) AS total FROM b GROUP BY 1) t USING (legislature)
GROUP BY b.legislature, floor(b.paperNumber / {PAGE_KEYS}), t.total""", b=BILLS_SQL))
def src_flatten_nested(spark, sf_dir):
    t = Tables(spark, sf_dir)
    raw = spark.read.schema(landing.hits_schema(BILL_SOURCE)).json(_land_bill_pages(spark, t)).drop("_corrupt_record")
    flat = landing.flatten(raw)
    return flat.select(F.col("`hits.total.value`").alias("hits.total.value"),
                       F.size("`hits.hits`").cast("long").alias("n_hits"))


PAGES_SQL = """
SELECT page_id, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS session, html FROM pages"""


def _pages(t: Tables):
    return t.pages.select("page_id", F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1).alias("session"),
                          "html")


@query("src_doc_blobs", f"""
SELECT page_id AS doc_id, session, CAST(strlen(html) AS BIGINT) AS n_bytes FROM ({PAGES_SQL}) p""")
def src_doc_blobs(spark, sf_dir):
    """Land every page as <root>/<session>/<page_id>.html, then scan the
    folder with the binaryFile source."""
    root = scratch_dir(spark, "doc-blobs")
    landing.land_files(_pages(Tables(spark, sf_dir)), root, "page_id", "session", "html") \
        .write.format("noop").mode("overwrite").save()
    blobs = landing.read_doc_blobs(spark, root)
    return blobs.select("doc_id", "session", F.col("n_bytes").cast("long"))


@query("sink_incremental_land", f"""
WITH p AS ({PAGES_SQL}),
f AS (SELECT * FROM p WHERE page_id IN (SELECT doc_id FROM labels))
SELECT session, CAST(count(*) FILTER (WHERE page_id IN (SELECT page_id FROM f)) AS BIGINT) AS first_run,
       CAST(count(*) FILTER (WHERE page_id NOT IN (SELECT page_id FROM f)) AS BIGINT) AS second_run
FROM p GROUP BY session""")
def sink_incremental_land(spark, sf_dir):
    """Two landing runs into one folder: the first lands the pages already
    known to the labels table, the second all pages and must write only
    the missing ones."""
    t = Tables(spark, sf_dir)
    root = scratch_dir(spark, "incremental")
    pages = _pages(t)
    first = landing.land_new(pages.join(t.labels.select(F.col("doc_id").alias("page_id")), "page_id", "left_semi"),
                             root, "page_id", "session", "html")
    second = landing.land_new(pages, root, "page_id", "session", "html")
    runs = first.select("session", F.lit(1).alias("run")).unionByName(second.select("session", F.lit(2).alias("run")))
    return runs.groupBy("session").agg(F.count_if(F.col("run") == 1).cast("long").alias("first_run"),
                                       F.count_if(F.col("run") == 2).cast("long").alias("second_run"))


EXTRACT_SQL = f"""
SELECT page_id, session,
  nullif(trim(regexp_replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
                                  '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')), '') AS doc_text
FROM ({PAGES_SQL}) p"""


@query("src_doc_extract", EXTRACT_SQL)
def src_doc_extract(spark, sf_dir):
    p = _pages(Tables(spark, sf_dir))
    return p.select("page_id", "session", landing.html_to_text(F.col("html")).alias("doc_text"))


@query("sink_json_snapshot", """
SELECT doc_id, CAST(to_json({'doc_id': doc_id, 'lang': lang, 'source': source}) AS VARCHAR) AS record,
       row_number() OVER (ORDER BY doc_id) - 1 AS line
FROM documents ORDER BY doc_id LIMIT 10""")
def sink_json_snapshot(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang", "source")
    snap = sinks.json_snapshot(d, ["doc_id"], 10)
    path = scratch_dir(spark, "json-snapshot")
    snap.select("record").coalesce(1).write.mode("overwrite").text(path)
    back = spark.read.text(path)  # one file of ten rows: the row counter is the line number
    return back.select(F.get_json_object("value", "$.doc_id").cast("long").alias("doc_id"),
                       F.col("value").alias("record"), F.monotonically_increasing_id().alias("line"))


@query("sink_csv_roundtrip", """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS customers, round(sum(c_acctbal), 2) AS balance,
       CAST(count(DISTINCT c_name) AS BIGINT) AS names
FROM customer GROUP BY c_mktsegment""")
def sink_csv_roundtrip(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    path = scratch_dir(spark, "csv")
    c.write.mode("overwrite").option("header", True).csv(path)
    back = spark.read.schema(c.schema).option("header", True).csv(path)
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).cast("long").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"),
        F.countDistinct("c_name").cast("long").alias("names"))


@query("sink_catalog_copy", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", CAST(count(*) AS BIGINT) AS rows FROM {n}" for n in TABLE_NAMES))
def sink_catalog_copy(spark, sf_dir):
    """The source database lists the given files as tables; the copy takes its
    list from the catalog."""
    root = scratch_dir(spark, "catalog")
    source, target = (f"{kind}_{root.rsplit('-', 1)[1]}" for kind in ("bronze", "copy"))
    for db in (source, target):
        spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}'")
    t = Tables(spark, sf_dir)
    for n in TABLE_NAMES:
        spark.catalog.createTable(f"{source}.{n}", path=t.path(n), source="parquet")
    return sinks.catalog_copy(spark, source, target)


@query("src_tsv", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src_tsv(spark, sf_dir):
    """TSV with a header and padded values, read back and trimmed."""
    n = Tables(spark, sf_dir).nation
    path = scratch_dir(spark, "tsv")
    n.select(F.col("n_nationkey").cast("string"), F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("n_name"),
             F.col("n_regionkey").cast("string")) \
        .write.mode("overwrite").option("header", True).option("sep", "\t") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = spark.read.option("header", True).option("sep", "\t").csv(path)
    return back.select(F.trim("n_nationkey").cast("int").alias("n_nationkey"), F.trim("n_name").alias("n_name"),
                       F.trim("n_regionkey").cast("int").alias("n_regionkey"))


@query("src_json_array", "SELECT r_regionkey AS id, r_name AS name FROM region")
def src_json_array(spark, sf_dir):
    """A static JSON array document (the region dimension, five rows by
    schema) read with multiLine and inferred types."""
    r = Tables(spark, sf_dir).region
    path = scratch_dir(spark, "json-array")
    doc = r.agg(F.to_json(F.array_sort(F.collect_list(
        F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))))).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)
    back = spark.read.option("multiLine", True).json(path)
    return back.select(F.col("id").cast("int").alias("id"), "name")


def _silver_summary(t: Tables, version: int):
    ft = roles.full_text(t)
    return ft.select("doc_id", F.length("doc_text").cast("long").alias("n_chars"),
                     F.lit(version).cast("long").alias("version"))


@query("sink_merge_upsert", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS BIGINT) AS version
FROM documents WHERE lang = 'en' OR doc_id IN (SELECT doc_id FROM labels)""")
def sink_merge_upsert(spark, sf_dir):
    """Target: the documents of an earlier run (those with labels), v1.
    Batch: a later run over the English documents, v2, twice (duplicates in
    the batch).  The merge updates, inserts and keeps target rows."""
    t = Tables(spark, sf_dir)
    first = _silver_summary(t, 1).join(t.labels.select("doc_id"), "doc_id", "left_semi")
    path = scratch_dir(spark, "merge")
    sinks.merge_upsert(spark, path, first, ["doc_id"], order_col="version")
    english = t.documents.where(F.col("lang") == "en").select("doc_id")
    later = _silver_summary(t, 2).join(english, "doc_id", "left_semi")
    batch = later.unionByName(later)
    merged = sinks.merge_upsert(spark, path, batch, ["doc_id"], order_col="version")
    return merged.select("doc_id", "n_chars", "version")


@query("sink_replace_append", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS rows FROM orders GROUP BY o_orderstatus""")
def sink_replace_append(spark, sf_dir):
    """Overwrite with one status, overwrite again (replace), then append
    the others: the table ends with every order exactly once."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    path = scratch_dir(spark, "replace-append")
    o.filter(F.col("o_orderstatus") == "F").write.mode("overwrite").parquet(path)
    o.filter(F.col("o_orderstatus") == "F").write.mode("overwrite").parquet(path)
    o.filter(F.col("o_orderstatus") != "F").write.mode("append").parquet(path)
    back = spark.read.parquet(path)
    return aggs.group_count(back, ["o_orderstatus"], "rows")


RUN_ID = "run-0"


def _experiment_log(spark, sf_dir):
    """Two log tables of the run, read back: settings with scores, labels."""
    from tessera.plans.vectors import GRID, _emb, _scored_search

    labels, settings = _scored_search(_emb(Tables(spark, sf_dir)), GRID)
    out = []
    for name, df in (("settings", settings), ("labels", labels)):
        path = scratch_dir(spark, f"experiment-{name}")
        df.withColumn("run_id", F.lit(RUN_ID)).write.mode("overwrite").partitionBy("run_id").parquet(path)
        out.append(spark.read.parquet(path))
    return out


@query("sink_experiment_log", SEARCH_SQL + f"""
SELECT '{RUN_ID}' AS run_id, lab.param_id, CAST(eps AS DOUBLE) AS eps, CAST(ms AS BIGINT) AS min_samples, score, lab.vec_id, lab.cluster
FROM lab JOIN scored USING (param_id) JOIN params USING (param_id)""")
def sink_experiment_log(spark, sf_dir):
    """Logged run, partitioned by run id: parameters and score of every
    setting with the label of every point."""
    settings, labels = _experiment_log(spark, sf_dir)
    return settings.join(labels, ["run_id", "param_id"]).select(
        "run_id", "param_id", "eps", "min_samples", "score", "vec_id", "cluster")


# ---------------------------------------------------------- data quality
@query("dq_key_tests", """
SELECT 'orders' AS "table", 'o_orderkey' AS "column", 'unique' AS test,
       CAST(count(o_orderkey) - count(DISTINCT o_orderkey) AS BIGINT) AS failures FROM orders
UNION ALL SELECT 'orders', 'o_orderkey', 'not_null', CAST(count(*) FILTER (WHERE o_orderkey IS NULL) AS BIGINT) FROM orders
UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber', 'unique',
       CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM lineitem
UNION ALL SELECT 'model', 'id', 'unique', CAST(count(id) - count(DISTINCT id) AS BIGINT)
       FROM (SELECT 1 AS id FROM region WHERE r_regionkey = 0 UNION ALL SELECT NULL FROM region WHERE r_regionkey = 0) m
UNION ALL SELECT 'model', 'id', 'not_null', CAST(count(*) FILTER (WHERE id IS NULL) AS BIGINT)
       FROM (SELECT 1 AS id FROM region WHERE r_regionkey = 0 UNION ALL SELECT NULL FROM region WHERE r_regionkey = 0) m""")
def dq_key_tests(spark, sf_dir):
    """Column tests as rows (table, column, test, failures); the model
    table (rows 1 and null) must fail not_null once."""
    t = Tables(spark, sf_dir)

    def failures(df, table: str, column: str, keys: list[str], tests: tuple[str, ...]):
        """One aggregate per table, turned into one row per test."""
        null = F.greatest(F.lit(0), *[F.col(k).isNull().cast("int") for k in keys])
        found = df.agg((F.sum(1 - null) - F.countDistinct(*keys)).cast("long").alias("unique"), F.sum(null).cast("long").alias("not_null"))
        stacked = F.stack(F.lit(len(tests)), *[x for n in tests for x in (F.lit(n), F.coalesce(F.col(n), F.lit(0)))]).alias("test", "failures")
        return found.select(F.lit(table).alias("table"), F.lit(column).alias("column"), stacked)

    r0 = t.region.filter(F.col("r_regionkey") == 0)
    model = r0.select(F.lit(1).alias("id")).unionByName(r0.select(F.lit(None).cast("int").alias("id")))
    return (failures(t.orders, "orders", "o_orderkey", ["o_orderkey"], ("unique", "not_null"))
            .unionByName(failures(t.lineitem, "lineitem", "l_orderkey,l_linenumber", ["l_orderkey", "l_linenumber"], ("unique",)))
            .unionByName(failures(model, "model", "id", ["id"], ("unique", "not_null"))))


@query("dq_error_rows", with_views("""
SELECT session, CAST(count(*) AS BIGINT) AS docs,
       CAST(count(*) FILTER (WHERE doc_text LIKE 'Error:%') AS BIGINT) AS error_rows,
       CAST(count(*) FILTER (WHERE doc_text IS NULL OR doc_text = 'null') AS BIGINT) AS empty_rows
FROM ft GROUP BY session""", ft=FULL_TEXT_SQL))
def dq_error_rows(spark, sf_dir):
    ft = roles.full_text(Tables(spark, sf_dir))
    c = F.col("doc_text")
    return ft.groupBy("session").agg(
        F.count(F.lit(1)).cast("long").alias("docs"),
        F.count_if(c.startswith("Error:")).cast("long").alias("error_rows"),
        F.count_if(c.isNull() | (c == "null")).cast("long").alias("empty_rows"))


@query("dq_malformed_json", """
SELECT event_type, CAST(count(*) AS BIGINT) AS events,
       CAST(count(*) FILTER (WHERE NOT coalesce(json_valid(props), FALSE)) AS BIGINT) AS malformed
FROM events GROUP BY event_type""")
def dq_malformed_json(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).cast("long").alias("events"),
        F.count_if(F.try_parse_json("props").isNull()).cast("long").alias("malformed"))


# ------------------------------------------------------------------ dates
def _date_text():
    return F.concat(F.date_format("o_orderdate", "yyyy MMM "), F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, " "),
                    F.lit(" 12:00 UTC"))


@query("fn_parse_date", """
SELECT o_orderkey, strftime(strptime(regexp_replace(substr(strftime(o_orderdate, '%Y %b ') || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, ' ') || ' 12:00 UTC', 1, 11), '\\s+', ' ', 'g'), '%Y %b %d'), '%Y-%m-%d') AS launch_date
FROM orders""")
def fn_parse_date(spark, sf_dir):
    """'%Y %b %_d' (space-padded day) from the first 11 characters of a
    launch-log text; unparsable -> null."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", _date_text().alias("launch"))
    txt = F.regexp_replace(F.substring("launch", 1, 11), r"\s+", " ")
    d = F.try_to_timestamp(txt, F.lit("yyyy MMM d"))
    return o.select("o_orderkey", F.date_format(d, "yyyy-MM-dd").alias("launch_date"))


def _strip_tags_py(html: str) -> str:
    """Pure-Python extractor used as the plug-in (same rules as the native
    extraction); refuses documents without a body."""
    import re

    if "<body" not in html:
        raise ValueError("no body")
    t = re.sub(r"(?is)<script[^>]*>.*?</script>", " ", html)
    t = re.sub(r"(?is)<style[^>]*>.*?</style>", " ", t)
    t = re.sub(r"(?s)<[^>]*>", " ", t)
    t = t.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")
    t = re.sub(r"[ \t\n\r\f\v]+", " ", t).strip()
    return t or None


@query("src_doc_extract_plugin", f"""
WITH p AS ({PAGES_SQL}), e AS ({EXTRACT_SQL})
SELECT p.page_id, p.session, CASE WHEN p.html LIKE '%<body%' THEN e.doc_text END AS doc_text,
       CASE WHEN p.html LIKE '%<body%' THEN NULL ELSE 'Error: no body' END AS error
FROM p JOIN e USING (page_id)""")
def src_doc_extract_plugin(spark, sf_dir):
    """Extraction through the pluggable per-document extractor: a failing
    document becomes an 'Error: ...' row and never fails the run."""
    p = _pages(Tables(spark, sf_dir))
    return landing.extract_with(p, "html", _strip_tags_py, keep=("page_id", "session"))


@query("join_anti_first_run", with_views("""
SELECT doc_id, session FROM ft WHERE doc_text IS NOT NULL AND doc_text <> 'null' AND length(doc_text) > 10""",
                                         ft=FULL_TEXT_SQL))
def join_anti_first_run(spark, sf_dir):
    """Unprocessed documents when no silver table exists yet (first run):
    every usable bronze document."""
    from tessera.operators import filters, joins, silver

    t = Tables(spark, sf_dir)
    existing = silver.silver_table_or_none(spark, "silver_not_made_yet")
    todo = joins.unprocessed(filters.usable_text(roles.full_text(t)), existing)
    return todo.select("doc_id", "session")
