"""Vector expressions on ``array<float>`` columns.

Dense per-row vector math is written with higher-order functions so it
stays in the JVM; pair-wise work over many vectors is done in blocks with
numpy inside ``applyInPandas`` (see ``operators.neighbours``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"


def tokens(col: Column) -> Column:
    """Lower-cased word tokens (Unicode letters, digits, underscore)."""
    return F.array_remove(F.split(F.lower(col), TOKEN_SPLIT), "")


def md5_bucket(col: Column, dim: int) -> Column:
    """Bucket of a token: first 8 hex digits of md5 as an integer, mod dim.
    Reproducible in any engine with md5 (unlike Spark's internal hashes)."""
    return F.pmod(F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("long"), F.lit(dim))


def hash_buckets(col: Column, dim: int) -> Column:
    """array<int> of the md5 bucket of every token, as a JVM expression
    (used where the bucket ids themselves are the output)."""
    return F.transform(tokens(col), lambda t: md5_bucket(t, dim).cast("int"))


def _md5_bucket_py(token: str, dim: int) -> int:
    return int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16) % dim


def _hash_counts(rows: pa.Array, dim: int) -> np.ndarray:
    """Token counts per bucket, (rows, dim), of one Arrow batch of token arrays;
    a null array counts as empty.  Each distinct token of the batch is hashed
    once; the counting is one ``np.bincount`` over the whole batch."""
    n = len(rows)
    lens = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = rows.flatten().dictionary_encode()
    hashed = np.array([_md5_bucket_py(t, dim) for t in coded.dictionary.to_pylist()], dtype=np.int64)
    buckets = hashed[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, dtype=np.int64)
    row_of = np.repeat(np.arange(n, dtype=np.int64), lens)
    return np.bincount(row_of * dim + buckets, minlength=n * dim).reshape(n, dim)


def hash_vector(col: Column, dim: int) -> Column:
    """Feature-hashing encoder: token counts per md5 bucket, ``array<float>``
    of length ``dim``.  Tokenising stays in the JVM; hashing and counting run
    per Arrow batch (the slot a neural encoder would take)."""

    @F.arrow_udf(ArrayType(FloatType()))
    def _vec(rows: pa.Array) -> pa.Array:
        counts = _hash_counts(rows, dim)
        ends = np.arange(len(counts) + 1, dtype=np.int32) * dim
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(counts.astype(np.float32).ravel()))

    # Marked non-deterministic only so the optimizer never duplicates the
    # Python evaluation (e.g. for filters it infers from a later explode).
    return _vec.asNondeterministic()(tokens(col))


def hash_entries(col: Column, dim: int) -> Column:
    """The non-zero components of ``hash_vector``: array<struct<bucket, cnt>>."""

    @F.arrow_udf("array<struct<bucket:long,cnt:long>>")
    def _entries(rows: pa.Array) -> pa.Array:
        counts = _hash_counts(rows, dim)
        row, bucket = np.nonzero(counts)
        ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(counts))))).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(bucket.astype(np.int64)), pa.array(counts[row, bucket].astype(np.int64))], ["bucket", "cnt"])
        return pa.ListArray.from_arrays(pa.array(ends), pairs)

    return _entries.asNondeterministic()(tokens(col))


def norm2(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column) -> Column:
    """Unit-length vector in double precision; a zero vector stays zero."""
    def divided(n: Column) -> Column:
        return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))

    return F.get(F.transform(F.array(norm2(v)), divided), F.lit(0))  # the norm once a row, not once a component


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm2(a) * norm2(b))


def to_float_array(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("float"))
