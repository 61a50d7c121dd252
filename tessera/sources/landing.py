"""Sources (S1-S6, S11, S12, S15): landed files -> DataFrames.

Every reader takes an explicit schema where the shape is known, so no
inference pass runs over the landed data and malformed records land in
``_corrupt_record`` instead of failing the job.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tessera.session import materialize


def hits_schema(source: StructType) -> StructType:
    """Shape of one search-API response page: hits.total.value and
    hits.hits[*]._source."""
    return StructType([
        StructField("hits", StructType([
            StructField("total", StructType([StructField("value", LongType())])),
            StructField("hits", ArrayType(StructType([StructField("_source", source)]))),
        ])),
        StructField("_corrupt_record", StringType()),
    ])


def read_hits(spark: SparkSession, path: str, source: StructType) -> DataFrame:
    """One row per ``_source`` of every landed page."""
    return _pages(spark, path, source).select(F.explode("hits.hits").alias("h")).select("h._source.*")


def read_bad_pages(spark: SparkSession, path: str, source: StructType) -> DataFrame:
    """(file, page) of every landed page that is not valid JSON: ``read_hits``
    has no row of it, so it is reported here instead of vanishing."""
    pages = _pages(spark, path, source).withColumn("file", F.input_file_name())
    # a corrupt-record column cannot be read alone, hence the second column
    return pages.where(F.col("_corrupt_record").isNotNull() & F.col("hits").isNull()).select(
        "file", F.col("_corrupt_record").alias("page"))


def _pages(spark: SparkSession, path: str, source: StructType) -> DataFrame:
    return (spark.read.schema(hits_schema(source)).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> dotted top-level columns (json_normalize).  Only
    the schema is walked on the driver; arrays are kept as they are."""
    cols: list[Column] = []

    def walk(dtype, path: list[str]):
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))

    walk(df.schema, [])
    return df.select(*cols)


def read_doc_blobs(spark: SparkSession, root: str, glob: str = "*/*") -> DataFrame:
    """Document files under ``<root>/<session>/<doc_id>.<ext>`` (S5): the
    binaryFile source, with session and doc id parsed from the path."""
    df = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{glob}")
    return df.select(
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("session"),
        F.regexp_extract("path", r"/([^/.]+)\.[^/.]+$", 1).cast("long").alias("doc_id"),
        "path", "content", F.col("length").alias("n_bytes"))


def html_to_text(html: Column) -> Column:
    """Native text extraction from HTML: drop script/style blocks, tags and
    a few entities, collapse whitespace, strip; empty -> null (S6, T18)."""
    t = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    # &amp; last: "&amp;lt;" is the text "&lt;", not "<"
    t = F.replace(F.replace(F.replace(t, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")),
                  F.lit("&amp;"), F.lit("&"))
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return F.when(t != "", t)


EXTRACT_ROWS = 64  # documents whose content and text a task's Python holds besides the Arrow batch


def extract_with(df: DataFrame, content: str, extractor, out_schema: str = "doc_text string, error string",
                 keep: tuple[str, ...] = (), tries: int = 3) -> DataFrame:
    """Run a pluggable per-document extractor (e.g. a PDF parser) in Arrow
    batches.  Each document is tried up to ``tries`` times; one that still
    fails yields ``error = 'Error: <msg>'`` and a null text, so the job
    itself never fails on one bad file."""
    fields = [f.strip().split()[0] for f in out_schema.split(",")]

    def run(batches):
        import pyarrow as pa

        for part in (batch.slice(s, EXTRACT_ROWS) for batch in batches for s in range(0, batch.num_rows, EXTRACT_ROWS)):
            texts, errors = [], []
            for blob in part.column(content).to_pylist():
                last = None
                for _ in range(max(1, tries)):
                    try:
                        texts.append(extractor(blob))
                        errors.append(None)
                        break
                    except Exception as e:  # one bad document must not stop the batch
                        last = e
                else:
                    texts.append(None)
                    errors.append(f"Error: {last}")
            out = [part.column(k) for k in keep] + [pa.array(texts, pa.string()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=[*keep, *fields])

    schema = ", ".join([f"{k} {df.schema[k].dataType.simpleString()}" for k in keep] + [out_schema])
    return df.select(*dict.fromkeys([*keep, content])).mapInArrow(run, schema)


def _fs_path(uri: str):
    """(pyarrow filesystem, path) for a local, HDFS or object-store URI."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        uri = "file://" + os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


def land_files(df: DataFrame, root: str, key: str, session: str, content: str, ext: str = "html") -> DataFrame:
    """Write one file per row to ``<root>/<session>/<key>.<ext>`` from the
    executors (S7), through a filesystem client that works for local, HDFS
    and object-store roots.  A file that already exists is skipped
    (incremental landing); a new one is written under a temp name and
    renamed, so a lost task never leaves a partial file.
    Returns (key, session, landed)."""

    def run(batches):
        from pyarrow import fs as pafs

        filesystem, base = _fs_path(root)
        for pdf in batches:
            landed = []
            for k, s, c in zip(pdf[key], pdf[session], pdf[content]):
                d = f"{base.rstrip('/')}/{s}"
                target = f"{d}/{k}.{ext}"
                if filesystem.get_file_info(target).type != pafs.FileType.NotFound:
                    landed.append(False)
                    continue
                filesystem.create_dir(d, recursive=True)
                tmp = target + ".tmp"
                with filesystem.open_output_stream(tmp) as fh:
                    fh.write(c.encode("utf-8") if isinstance(c, str) else bytes(c))
                filesystem.move(tmp, target)
                landed.append(True)
            yield pd.DataFrame({key: pdf[key], session: pdf[session].astype("string"), "landed": landed})

    schema = f"{key} {df.schema[key].dataType.simpleString()}, {session} string, landed boolean"
    return df.select(key, session, content).mapInPandas(run, schema)


def landed_keys(spark: SparkSession, root: str, key: str) -> DataFrame:
    """(key, session) of the files under ``root``; contents are not read."""
    from pyspark.errors import AnalysisException

    try:
        return read_doc_blobs(spark, root).select(F.col("doc_id").alias(key), "session")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{key} long, session string")


def land_new(df: DataFrame, root: str, key: str, session: str, content: str, ext: str = "html") -> DataFrame:
    """Land the rows of ``df`` that have no file yet and return their
    manifest (key, session).  What is missing is fixed in a written table
    before anything lands, so the manifest can be read any number of times
    and a retried task changes nothing."""
    spark = df.sparkSession
    done = landed_keys(spark, root, key).withColumnRenamed("session", session)
    todo = materialize(df.select(key, session).join(done, [key, session], "left_anti"), "land-todo")
    rows = df.join(todo, [key, session], "left_semi")
    land_files(rows, root, key, session, content, ext).write.format("noop").mode("overwrite").save()
    return todo
