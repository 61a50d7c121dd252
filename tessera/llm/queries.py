"""The registered queries of the operators: thin digests of their results."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import audit, decontam, licenses, lines, mixing, pii, quality, simhash, suffix, tokens, urls, vectorcodes, warc
from tessera.llm.common import ASCII_LOWER, ASCII_UPPER
from tessera.session import scratch_dir, ship_package
from tessera.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def _words_sql(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    rules = quality.learn_rules(t.documents, t.labels)
    return quality.judge(t.documents, rules, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(Tables(spark, sf_dir).documents)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


OP3_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_words_sql('text')} AS w FROM documents),
b AS (SELECT item_id, {_words_sql('text')} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, unnest([w[i:i + least(10, len(w)) - 1] for i in range(1, len(w) - least(10, len(w)) + 2)]) AS gram
      FROM b WHERE len(w) > 0),
n AS (SELECT DISTINCT len(gram) AS n FROM g),
p AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, n WHERE len(w) >= n),
h AS (SELECT p.r, p.i, p.n, g.item_id FROM p JOIN g ON p.w[p.i:p.i + p.n - 1] = g.gram),
c AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)"""


@query("op3_benchmark_decontamination", OP3_SQL)
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    hits = decontam.find_hits(t.documents, t.benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"] + 1)
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query("op10_token_ids")
def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.tokenise_and_check(Tables(spark, sf_dir).documents, public_tokenizers.path("word_bpe_49k.json"))


@query("op5_source_mixing")
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draws(Tables(spark, sf_dir).documents, ["doc_id"])
    return drawn.select("doc_id", "size", "source_size", "target",
                        (F.size("shards") * F.col("size")).alias("taken"), "shards")


_TEMPLATES_SQL = ", ".join(
    f"({k}, '{label}', {base}, {text.split()})" for k, (label, text, base) in enumerate(
        [(label, text, True) for text, label in licenses.PHRASES] + [(label, text, False) for label, text in licenses.TEXTS]))

OP2_SQL = f"""
WITH t(tid, label, base, tw) AS (VALUES {_TEMPLATES_SQL}),
g AS (SELECT tid, label, base, least({licenses.K}, len(tw)) AS k, len(tw) - least({licenses.K}, len(tw)) + 1 AS ng, tw FROM t),
gg AS (SELECT tid, label, base, k, ng, tpos, tw[tpos + 1:tpos + k] AS gram FROM (SELECT *, unnest(range(0, ng)) AS tpos FROM g)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql('text')} AS w FROM documents),
p AS (SELECT r, k, w, unnest(range(0, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM gg) WHERE len(w) >= k),
h AS (SELECT p.r, tid, label, base, ng, i, i - tpos AS diag FROM p JOIN gg ON gg.k = p.k AND gg.gram = p.w[p.i + 1:p.i + p.k]),
dg AS (SELECT r, tid, label, base, ng, diag, count(*) AS votes, min(i) AS f, max(i) AS l FROM h GROUP BY ALL),
s AS (SELECT *, CASE WHEN base OR coalesce(diag - lag(diag) OVER o, 999) > {licenses.DRIFT} THEN 1 ELSE 0 END AS fresh
      FROM dg WINDOW o AS (PARTITION BY r, tid ORDER BY diag)),
gr AS (SELECT *, sum(fresh) OVER (PARTITION BY r, tid ORDER BY diag) AS grp FROM s),
sp AS (SELECT r, tid, label, base, grp, sum(votes) AS votes, min(f) AS f, max(l) AS l, least(1.0, sum(votes) / ng) AS cover
       FROM gr GROUP BY r, tid, label, base, grp, ng HAVING least(1.0, sum(votes) / ng) >= {licenses.MIN_COVER}),
a AS (SELECT r, sum(votes) FILTER (WHERE base) AS n_base, min(f) FILTER (WHERE base) AS first_word, max(l) FILTER (WHERE base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score FROM sp GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN a USING (r)"""


@query("op2_license_scan", OP2_SQL)
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(Tables(spark, sf_dir).documents)


@query("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return urls.judge(t.pages, t.labels)


# five hex digits of the SHA-1 are four base32 digits
_BASE32_SQL = " || ".join(
    f"substr('{warc.BASE32}', CAST((CAST('0x' || substr(h, {5 * k + 1}, 5) AS BIGINT) >> {s}) & 31 AS INTEGER) + 1, 1)"
    for k in range(8) for s in (15, 10, 5, 0))

OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT page_id, strlen(html) AS bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, {_BASE32_SQL} AS payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM k"""


@query("op9_warc", OP9_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "llm-warc")
    warc.write(Tables(spark, sf_dir).pages, path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_members(Tables(spark, sf_dir).documents)


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(Tables(spark, sf_dir).documents, digest=True).withColumnRenamed("kept", "kept_sha256")


def _lloyd_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Codebook rounds as CTEs: b<k> the codebooks, a<k> the assignment to them."""
    near = """a{k} AS (SELECT r, p, min_by(e, (d, e)) AS e, min(d) AS d FROM (
  SELECT q.r, q.p, b.e, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - b.v[i]) * (q.v[i] - b.v[i]))) AS d
  FROM q JOIN b{k} b ON b.p = q.p) GROUP BY r, p)"""
    step = """m{k} AS (SELECT p, e, list(CAST(m AS BIGINT) ORDER BY i) AS v FROM (
  SELECT a.p, a.e, i, floor(sum(q.v[i]) / count(*)) AS m FROM a{j} a JOIN q USING (r, p), range(1, {w}) t(i) WHERE i <= len(q.v) GROUP BY ALL) GROUP BY p, e),
b{k} AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{j} b LEFT JOIN m{k} m ON m.p = b.p AND m.e = b.e)"""
    ctes = [near.format(k=0)]
    for k in range(1, rounds + 1):
        ctes += [step.format(k=k, j=k - 1, w=1025), near.format(k=k)]
    body = ",\n".join(ctes)
    hexes = " || ".join(f"printf('%02x', max(e) FILTER (WHERE p = {p}))" for p in range(parts))
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
  list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v FROM kept, range(0, {parts}) t(p)),
b0 AS (SELECT p, r - 1 AS e, v FROM q WHERE r <= {entries}),
{body},
c AS (SELECT r, {hexes} AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM c JOIN kept USING (r), s"""


@query("op13_vector_codes", _lloyd_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vectorcodes.compress(Tables(spark, sf_dir).embeddings)
    return vectorcodes.with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(vectorcodes.books_digest(books)).alias("codebooks_sha256"))


OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
u AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS lang_n FROM u GROUP BY lang, term HAVING count(*) >= {audit.MIN_DOCS}),
c AS (SELECT lang, source, term, sum(u.n) AS n FROM u JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS terms, sum(lang_n) AS lang_total FROM k GROUP BY lang),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        CAST(1 + {audit.ONE} * (coalesce(c.n, 0) + 1) // (coalesce(t.total, 0) + v.terms) AS BIGINT) AS p,
        CAST(1 + {audit.ONE} * (k.lang_n + 1) // (v.lang_total + v.terms) AS BIGINT) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM z
WHERE part = 'pair' OR rank <= {audit.TOP}"""


@query("op11_source_audit", OP11_SQL)
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(Tables(spark, sf_dir).documents)


# the base patterns of the contract, without possessive runs
_PII_SQL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "id": f"[^{pii.DELIMITER}0-9]*[0-9][^{pii.DELIMITER}]*".replace("'", "''"),
}


def _units_sql(text: str) -> str:
    cut = pii.DELIMITER.replace("'", "''")
    return (f"list_filter(string_split_regex(translate({text}, '{ASCII_UPPER}123456789', '{ASCII_LOWER}000000000'), '[{cut}]+'), "
            "lambda x: x <> '')")


def _pii_matches_sql(kind: str) -> str:
    pattern = _PII_SQL[kind]
    size = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    return f"""SELECT r, {pii.KINDS.index(kind)} AS kind, t, h[k] AS value,
  CAST({size.format('p[1:k]')} + {size.format('h[1:k - 1]')} AS BIGINT) AS start FROM (
  SELECT r, t, p, h, unnest(range(1, len(h) + 1)) AS k FROM (
    SELECT r, t, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS h FROM d WHERE regexp_matches(t, '{pattern}')))"""


_PII_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_PII_ROUNDS = ",\n".join(f"""g{k} AS (SELECT pattern FROM bp JOIN pl USING (pattern) WHERE seed {f'OR value IN (SELECT value FROM a{k - 1})' if k > 1 else ''}
  GROUP BY pattern, places HAVING count(DISTINCT value) >= {pii.MIN_VALUES} AND 100 * sum(n) >= {pii.TRUST} * places),
a{k} AS (SELECT value FROM e WHERE NOT seed GROUP BY value
  HAVING 2 * coalesce(sum(n) FILTER (WHERE one IN (SELECT pattern FROM g{k}) OR coalesce(two IN (SELECT pattern FROM g{k}), FALSE)), 0) >= sum(n))"""
                         for k in range(1, pii.ROUNDS + 1))

OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_pii_matches_sql(k) for k in pii.KINDS)}),
n AS (SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM (
  SELECT r, kind, t, start, CASE WHEN kind = 4 THEN regexp_replace(value, '[.!?]+$', '') ELSE value END AS value FROM m)),
f AS (SELECT r, kind, t, value, start, start + length(value) AS stop FROM n WHERE CASE kind
  WHEN 1 THEN regexp_full_match(value, '{_PII_BYTE}(\\.{_PII_BYTE}){{3}}')
  WHEN 2 THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(digits), i, 1) AS INTEGER) ELSE
      CAST(substr(reverse(digits), i, 1) AS INTEGER) * 2 - CASE WHEN substr(reverse(digits), i, 1) > '4' THEN 9 ELSE 0 END END)) % 10 = 0
  WHEN 3 THEN length(digits) BETWEEN 9 AND 15
  WHEN 4 THEN length(value) >= {pii.MIN_CHARS} AND length(digits) >= {pii.MIN_DIGITS} ELSE TRUE END),
o AS (SELECT f.r, f.kind, f.value, f.start, f.stop, {_units_sql(f"substr(t, greatest(1, f.start - {pii.REACH - 1}), least(f.start, {pii.REACH}))")} AS u
      FROM f WHERE kind < 4 OR NOT EXISTS (SELECT 1 FROM f s WHERE s.kind < 4 AND s.r = f.r AND s.start < f.stop AND f.start < s.stop)),
e AS (SELECT value, kind < 4 AS seed, u[-1] AS one, u[-2] || ' ' || u[-1] AS two, count(*) AS n FROM o WHERE len(u) > 0 GROUP BY ALL),
bp AS (SELECT pattern, value, seed, sum(n) AS n FROM (SELECT value, seed, n, unnest([one, two]) AS pattern FROM e) WHERE pattern IS NOT NULL GROUP BY ALL),
w AS (SELECT {_units_sql('t')} AS u FROM d),
pl AS (SELECT pattern, count(*) AS places FROM (SELECT unnest(u) AS pattern FROM w UNION ALL
       SELECT unnest(list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1])) FROM w)
       WHERE pattern IN (SELECT pattern FROM bp) GROUP BY pattern),
{_PII_ROUNDS},
s AS (SELECT r, kind, start, ['email', 'ip', 'card', 'phone', 'id'][kind + 1] || ':' || start || ':' || stop AS span FROM o
      WHERE kind < 4 OR value IN (SELECT value FROM a{pii.ROUNDS})),
c AS (SELECT r, count(*) FILTER (WHERE kind = 0) AS n0, count(*) FILTER (WHERE kind = 1) AS n1, count(*) FILTER (WHERE kind = 2) AS n2,
        count(*) FILTER (WHERE kind = 3) AS n3, string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 4) AS base,
        string_agg(span, ',' ORDER BY start, kind) AS spans FROM s GROUP BY r)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_email, CAST(coalesce(n1, 0) AS BIGINT) AS n_ip, CAST(coalesce(n2, 0) AS BIGINT) AS n_card,
       CAST(coalesce(n3, 0) AS BIGINT) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN c USING (r)"""


@query("op12_pii", OP12_SQL)
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(Tables(spark, sf_dir).documents)
    base = F.filter("spans", lambda s: s["kind"] < len(pii.BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == pii.KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in pii.BASE_KINDS),
                        F.sha2(pii.span_list(base), 256).alias("base_sha256"), pii.span_list(F.col("spans")).alias("spans"))
