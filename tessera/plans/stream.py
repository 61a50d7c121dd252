"""Streaming query: the silver stage as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import roles
from tessera.plans.documents import CLEANED_SQL, SENT_SQL
from tessera.plans.registry import query
from tessera.plans.roles import FULL_TEXT_SQL, with_views
from tessera.session import scratch_dir
from tessera.sources.tables import Tables
from tessera.streaming.silver_stream import read_silver, run_silver_stream, summarize


@query("stream_silver", with_views(f"""
WITH s AS ({SENT_SQL})
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_sentences, CAST(sum(length(sentence)) AS BIGINT) AS sentence_chars,
       CAST(sum(len(list_filter(string_split_regex(lower(sentence), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> ''))) AS BIGINT) AS token_mass
FROM s GROUP BY doc_id""", ft=FULL_TEXT_SQL, cl=CLEANED_SQL))
def stream_silver(spark, sf_dir):
    """Land the bronze text in two drops (documents an earlier run knew of,
    then the rest), stream them into silver, and summarise silver per
    document."""
    t = Tables(spark, sf_dir)
    ft = roles.full_text(t)
    bronze = scratch_dir(spark, "bronze")
    known = ft.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    known.write.mode("overwrite").parquet(f"{bronze}/drop=1")
    ft.join(t.labels.select("doc_id"), "doc_id", "left_anti").write.mode("overwrite").parquet(f"{bronze}/drop=2")
    silver_path = scratch_dir(spark, "silver")
    run_silver_stream(spark, f"{bronze}/*", ft.schema, silver_path, scratch_dir(spark, "stream-ckpt"),
                      files_per_trigger=4)
    return summarize(read_silver(spark, silver_path)).select("doc_id", "n_sentences", "sentence_chars",
                                                              F.col("token_mass"))
