"""Bronze -> silver as a Structured Streaming job (K1).

New bronze text files are picked up by a file stream.  Each micro-batch is
reduced to one row per document, cleaned, split into sentences and encoded; its
sentences then replace those that silver holds of the same documents
(``sinks.replace_keys``), so a changed document changes in silver, a
document that lands in several files counts once, and a micro-batch that is
replayed after a failure leaves the same table.  A document whose new
text has no sentence left keeps none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators import silver
from tessera.sources import sinks


def silver_batch(batch: DataFrame) -> DataFrame:
    docs = silver.cleaned_documents(batch, None)
    return silver.sentence_vectors(silver.sentences(docs))


def run_silver_stream(spark: SparkSession, bronze_path: str, schema: StructType, silver_path: str,
                      checkpoint: str, files_per_trigger: int = 1) -> None:
    """Process every bronze file available now, then stop."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # of a repeated document the largest row counts, whatever the order
        rest = [c for c in batch.columns if c != "doc_id"]
        batch = batch.groupBy("doc_id").agg(F.max(F.struct(*rest)).alias("_r")).select("doc_id", "_r.*")
        sinks.replace_keys(spark, silver_path, silver_batch(batch), ["doc_id"], keys_of=batch)

    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
                   .parquet(bronze_path))
    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def read_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The silver rows; an empty table if no batch was written yet."""
    found = sinks.read_keyed(spark, silver_path)
    if found is None:
        none = spark.createDataFrame([], "doc_id long, doc_text string")
        return silver_batch(none)
    return found


def summarize(sent_vectors: DataFrame) -> DataFrame:
    mass = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x)
    return sent_vectors.groupBy("doc_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_sentences"),
        F.sum(F.length("sentence")).cast("long").alias("sentence_chars"),
        F.sum(mass).cast("long").alias("token_mass"))
