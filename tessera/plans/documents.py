"""Document text queries: cleaning, sentences, hashing encoder, silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import vectors as vx
from tessera.operators import silver
from tessera.plans import roles
from tessera.plans.registry import query
from tessera.plans.roles import FULL_TEXT_SQL, with_views
from tessera.plans.sqltext import clean_function_sql, clean_pipeline_sql, sentences_sql
from tessera.sources.tables import Tables

DIM = silver.DEFAULT_DIM
USABLE = "doc_text IS NOT NULL AND doc_text <> 'null' AND length(doc_text) > 10"


@query("txt_clean", f"SELECT doc_id, {clean_function_sql('text')} AS cleaned FROM documents")
def txt_clean(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return d.select("doc_id", tx.clean_text(F.col("text"), "function").alias("cleaned"))


@query("txt_clean_pipeline", f"SELECT doc_id, {clean_pipeline_sql('text')} AS cleaned FROM documents")
def txt_clean_pipeline(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return d.select("doc_id", tx.clean_text(F.col("text"), "pipeline").alias("cleaned"))


CLEANED_SQL = f"SELECT doc_id, {clean_pipeline_sql('doc_text')} AS cleaned FROM ft WHERE {USABLE}"


@query("txt_sentences", with_views(sentences_sql("cl"), ft=FULL_TEXT_SQL, cl=CLEANED_SQL))
def txt_sentences(spark, sf_dir):
    ft = roles.full_text(Tables(spark, sf_dir))
    return silver.sentences(silver.cleaned_documents(ft, None))


SENT_SQL = sentences_sql("cl")

HASH_SQL = f"""
WITH s AS ({SENT_SQL}),
tok AS (SELECT doc_id, sentence_index,
               unnest(string_split_regex(lower(sentence), '[^\\p{{L}}\\p{{N}}_]+')) AS token FROM s)
SELECT doc_id, sentence_index,
       CAST(CAST(('0x' || substr(md5(token), 1, 8)) AS BIGINT) % {DIM} AS BIGINT) AS bucket,
       CAST(count(*) AS BIGINT) AS cnt
FROM tok WHERE token <> '' GROUP BY 1, 2, 3"""


@query("vec_hash_encode", with_views(HASH_SQL, ft=FULL_TEXT_SQL, cl=CLEANED_SQL))
def vec_hash_encode(spark, sf_dir):
    """Sparse view of the hashed sentence vectors: one row per non-zero
    bucket (doc_id, sentence_index, bucket, cnt)."""
    ft = roles.full_text(Tables(spark, sf_dir))
    return silver.document_hash_counts(silver.cleaned_documents(ft, None), DIM)


@query("vec_dense_encode", with_views(f"""
WITH h AS ({HASH_SQL})
SELECT doc_id, sentence_index, bucket, CAST(cnt AS DOUBLE) AS raw,
       round(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY doc_id, sentence_index)), 5) AS unit
FROM h""", ft=FULL_TEXT_SQL, cl=CLEANED_SQL))
def vec_dense_encode(spark, sf_dir):
    """Silver sentence vectors as the encoder writes them, raw and
    normalised, one row per non-zero component."""
    ft = roles.full_text(Tables(spark, sf_dir))
    v = silver.sentence_vectors(silver.sentences(silver.cleaned_documents(ft, None)))
    v = v.withColumn("unit", vx.l2_normalize(F.col("embedding")))
    both = F.transform(F.arrays_zip("embedding", "unit"), lambda e, i: F.struct(i.alias("bucket"), e["embedding"].alias("embedding"), e["unit"].alias("unit")))
    e = v.select("doc_id", "sentence_index", F.explode(F.filter(both, lambda e: e["embedding"] != 0)).alias("e"))
    return e.select(
        "doc_id", "sentence_index", F.col("e")["bucket"].cast("long").alias("bucket"),
        F.col("e")["embedding"].cast("double").alias("raw"), F.round(F.col("e")["unit"].cast("double"), 5).alias("unit"))


SILVER_SQL = f"""
WITH todo AS (SELECT doc_id, session FROM ft t WHERE {USABLE}
              AND NOT EXISTS (SELECT 1 FROM labels s WHERE s.doc_id = t.doc_id)),
s AS ({SENT_SQL}),
tok AS (SELECT doc_id, sentence_index, length(sentence) AS n_chars,
               len(list_filter(string_split_regex(lower(sentence), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '')) AS n_tok
        FROM s)
SELECT todo.doc_id, todo.session,
       CAST(count(tok.doc_id) AS BIGINT) AS n_sentences,
       CAST(coalesce(sum(tok.n_chars), 0) AS BIGINT) AS sentence_chars,
       CAST(coalesce(sum(tok.n_tok), 0) AS BIGINT) AS token_mass,
       CAST(CASE WHEN count(tok.doc_id) > 0 THEN {DIM} END AS BIGINT) AS embedding_dimension
FROM todo LEFT JOIN tok ON tok.doc_id = todo.doc_id
GROUP BY todo.doc_id, todo.session"""


@query("silver_documents", with_views(SILVER_SQL, ft=FULL_TEXT_SQL, cl=CLEANED_SQL))
def silver_documents(spark, sf_dir):
    """Flagship: the silver stage for all unprocessed usable documents, with
    every sentence encoded, summarised per document (sentence count,
    characters, mass and dimension of its vectors)."""
    t = Tables(spark, sf_dir)
    docs = silver.cleaned_documents(roles.full_text(t), roles.processed_docs(t))
    return silver.document_summary(docs)


@query("vec_embedding_table", with_views(f"""
WITH s AS ({SENT_SQL})
SELECT doc_id, sentence_index, sentence, '{silver.HASH_MODEL}' AS model_name,
       CAST({DIM} AS BIGINT) AS embedding_dimension,
       CAST(len(list_filter(string_split_regex(lower(sentence), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '')) AS BIGINT) AS token_mass
FROM s""", ft=FULL_TEXT_SQL, cl=CLEANED_SQL))
def vec_embedding_table(spark, sf_dir):
    """Silver sentence-vector table: raw vector, metadata; the vector is
    summarised by its mass (sum of components) for the oracle."""
    ft = roles.full_text(Tables(spark, sf_dir))
    v = silver.sentence_vectors(silver.sentences(silver.cleaned_documents(ft, None)))
    mass = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x).cast("long")
    return v.select("doc_id", "sentence_index", "sentence", "model_name", "embedding_dimension",
                    mass.alias("token_mass"))


@query("dq_no_text", """
SELECT lang, CAST(count(*) FILTER (WHERE text IS NULL OR NOT regexp_matches(text, '[A-Za-z0-9]')) AS BIGINT) AS no_text,
       CAST(count(*) AS BIGINT) AS docs
FROM documents GROUP BY lang""")
def dq_no_text(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    c = F.col("text")
    return d.groupBy("lang").agg(
        F.count_if(c.isNull() | ~c.rlike("[A-Za-z0-9]")).cast("long").alias("no_text"),
        F.count(F.lit(1)).cast("long").alias("docs"))


@query("txt_json_roundtrip", """
SELECT lang, CAST(count(*) AS BIGINT) AS docs, CAST(count(*) AS BIGINT) AS roundtrip_equal
FROM documents GROUP BY lang""")
def txt_json_roundtrip(spark, sf_dir):
    """Encode each text as a JSON document and decode it again; every text
    must come back unchanged (counted per language)."""
    d = Tables(spark, sf_dir).documents
    enc = F.to_json(F.struct(F.col("text").alias("doc_text")))
    dec = F.from_json(enc, "doc_text string")["doc_text"]
    return d.groupBy("lang").agg(
        F.count(F.lit(1)).cast("long").alias("docs"),
        F.count_if(dec.eqNullSafe(F.col("text"))).cast("long").alias("roundtrip_equal"))
