"""Bronze -> silver document vectorisation (the reference's silver stage).

usable text (F2) -> not yet processed (J1) -> clean (T15b) -> sentences
(T16) -> encode (V1) -> rows keyed (doc_id, sentence_index) (V4).

Everything up to the encoder is row-local: one document row becomes its
sentence rows by ``posexplode`` of a row-computed array, so the only
shuffle in the plan is the anti-join against the silver table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tessera.functions import text as tx
from tessera.functions import vectors as vx
from tessera.operators import filters, joins
from tessera.session import materialize

DEFAULT_DIM = 64
HASH_MODEL = "md5-feature-hash"

Encoder = Callable[[Column], Column]


def hash_encoder(dim: int = DEFAULT_DIM) -> Encoder:
    return lambda c: vx.hash_vector(c, dim)


def cleaned_documents(bronze: DataFrame, silver: DataFrame | None, mode: str = "pipeline",
                      text: str = "doc_text") -> DataFrame:
    todo = joins.unprocessed(filters.usable_text(bronze, text), silver)
    return todo.withColumn("doc_text", tx.clean_text(F.col(text), mode))


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "doc_text") -> DataFrame:
    """(key, sentence_index, sentence) for kept sentences."""
    s = docs.select(key, F.explode(tx.kept_sentences(F.col(text))).alias("_s"))
    return s.select(key, F.col("_s.sentence_index").cast("long").alias("sentence_index"),
                    F.col("_s.sentence").alias("sentence"))


def sentence_vectors(sents: DataFrame, encoder: Encoder | None = None,
                     model_name: str = HASH_MODEL) -> DataFrame:
    enc = encoder or hash_encoder()
    v = sents.withColumn("embedding", enc(F.col("sentence")))
    return v.withColumn("model_name", F.lit(model_name)) \
            .withColumn("embedding_dimension", F.size("embedding").cast("long"))


def document_summary(docs: DataFrame, encoder: Encoder | None = None, key: str = "doc_id",
                     text: str = "doc_text") -> DataFrame:
    """Per document: sentence count, sentence characters, and mass and dimension
    of the sentence vectors the encoder returns.  Only these numbers are
    shuffled, added up before; a document without sentences keeps its row."""
    extra = [c for c in docs.columns if c not in (key, text)]
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.select("_row", key, *extra, F.explode_outer(tx.kept_sentences(F.col(text))).alias("_s"))
    rows = sentence_vectors(rows.select("_row", key, *extra, F.col("_s.sentence").alias("sentence")), encoder)
    found = F.col("sentence").isNotNull()
    mass = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x)
    zero = F.lit(0).cast("long")
    return rows.groupBy("_row", key, *extra).agg(
        F.count("sentence").cast("long").alias("n_sentences"),
        F.coalesce(F.sum(F.length("sentence")), zero).cast("long").alias("sentence_chars"),
        F.coalesce(F.sum(F.when(found, mass)), zero).cast("long").alias("token_mass"),
        F.max(F.when(found, F.col("embedding_dimension"))).cast("long").alias("embedding_dimension")).drop("_row")


def sparse_hash_counts(sents: DataFrame, dim: int = DEFAULT_DIM,
                       keys: tuple[str, ...] = ("doc_id", "sentence_index")) -> DataFrame:
    """Sparse hashed vectors: one row (keys, bucket, cnt) per non-zero bucket.

    The entries of a sentence are counted in its own row, so the groups, which
    add up sentences of equal keys, shuffle only the final sparse entries.
    """
    return sentence_counts(sents, dim, keys).groupBy(*keys, "bucket").agg(F.sum("cnt").cast("long").alias("cnt"))


def sentence_counts(sents: DataFrame, dim: int = DEFAULT_DIM,
                    keys: tuple[str, ...] = ("doc_id", "sentence_index")) -> DataFrame:
    """``sparse_hash_counts`` row by row, without a shuffle: sentences of equal
    keys stay apart."""
    return sents.withColumn("_e", vx.hash_entries(F.col("sentence"), dim)).select(*keys, F.explode("_e").alias("_e")).select(*keys, "_e.*")


def document_hash_counts(docs: DataFrame, dim: int = DEFAULT_DIM, key: str = "doc_id") -> DataFrame:
    """(key, sentence_index, bucket, cnt) of cleaned documents.  A document whose
    key is its own needs no group; only the sentences of keys that are
    null or repeat are shuffled and added up."""
    again = docs.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1))
    again = materialize(again.select(F.col(key).alias("_again")), "hash-repeated")
    if again.isEmpty():
        return sentence_counts(sentences(docs, key), dim, (key, "sentence_index"))
    same = F.col(key).eqNullSafe(F.col("_again"))
    once, more = docs.join(again, same, "left_anti"), docs.join(again, same, "left_semi")
    return sentence_counts(sentences(once, key), dim, (key, "sentence_index")).unionByName(
        sparse_hash_counts(sentences(more, key), dim, (key, "sentence_index")))


def model_encoder(load_model: Callable[[], object], dim: int) -> Encoder:
    """Plug-in encoder: an iterator pandas UDF that loads the model once per
    Python worker (``load_model`` returns an object with
    ``encode(list[str]) -> array (n, dim)``) and encodes Arrow batches; the
    batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``.  A batch
    on which the model fails yields empty vectors (dimension 0)."""
    @F.pandas_udf(ArrayType(FloatType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for s in batches:
            texts = s.fillna("").tolist()
            try:
                vecs = np.asarray(model.encode(texts), dtype=np.float32).reshape(len(texts), dim)
            except Exception:  # a batch the model fails on gets empty vectors; the run goes on
                vecs = [np.zeros(0, np.float32)] * len(texts)
            yield pd.Series(list(vecs))

    return lambda c: _encode.asNondeterministic()(c)


def silver_table_or_none(spark, table: str | None):
    """The silver table when the catalog has it (it is absent on the first run,
    in which case every usable bronze document is unprocessed)."""
    if table is None or not spark.catalog.tableExists(table):
        return None
    return spark.table(table)
