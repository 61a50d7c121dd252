"""Sinks (S8-S10, S13, S14, S18)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialize


BUCKETS = 32


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a table written by ``replace_keys``, None before the first."""
    found = existing(spark, path)
    return None if found is None else found.where("_live").drop("_live", "bucket")


def replace_keys(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], buckets: int = BUCKETS,
                 keys_of: DataFrame | None = None) -> DataFrame:
    """Put ``batch`` into the table at ``path`` in place of all rows with its
    keys, or with those of ``keys_of``; a key may have many rows.

    The table is partitioned by a hash of the keys.  Only the partitions that
    hold rows of such a key are read, merged and overwritten (dynamic partition
    overwrite), the files of the others stay and new rows are added beside
    them.  A row that is not live keeps a partition in the overwrite whose last
    rows go.  The rows are written to the scratch folder before the first file is
    replaced, and applying the same batch again gives the same table (what a
    failed run has added is found and overwritten), so a failed run is repeated."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    new = materialize(batch.withColumns({"bucket": bucket, "_live": F.lit(True)}), "merge-batch")
    gone = (batch if keys_of is None else keys_of).select(*keys).unionByName(new.select(*keys)).distinct()
    gone = materialize(gone.withColumn("bucket", bucket), "merge-keys")
    target, hit = existing(spark, path), []
    if target is not None:
        live = target.where("_live")
        old = gone.select(*(F.col(k).alias(f"_gone_{k}") for k in keys))
        same = [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys]
        held = live.select("bucket", *keys).join(old, same, "left_semi").select("bucket").distinct()
        hit = [r["bucket"] for r in held.collect()]  # at most ``buckets`` numbers
    if hit:
        merged = new.where(F.col("bucket").isin(hit)).unionByName(live.where(F.col("bucket").isin(hit)).join(old, same, "left_anti"))
        kept = gone.where(F.col("bucket").isin(hit)).select("bucket").distinct().withColumn("_live", F.lit(False))
        merged = materialize(merged.unionByName(kept, allowMissingColumns=True), "merge-new")
        merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    new.where(~F.col("bucket").isin(hit)).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(path)
    found = read_keyed(spark, path)
    return batch if found is None else found.select(*batch.columns)


def merge_upsert(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], order_col: str | None = None,
                 buckets: int = BUCKETS) -> DataFrame:
    """Keyed merge (upsert) without a lake format: de-duplicate the batch
    by key (latest ``order_col`` wins, remaining ties by the row's other
    values, so the result does not depend on row order), then ``replace_keys``."""
    rest = [c for c in batch.columns if c not in keys and c != order_col]
    last = F.struct(*[F.col(c) for c in ([order_col] if order_col else []) + rest])
    batch = batch.groupBy(*keys).agg(F.max(last).alias("_last")).select(*keys, "_last.*").select(*batch.columns)
    return replace_keys(spark, path, batch, keys, buckets)


def json_snapshot(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows by ``order`` as JSON records (TakeOrdered, then
    to_json per row)."""
    return df.orderBy(*order).limit(n).select(*order, F.to_json(F.struct(*df.columns)).alias("record"))


def catalog_copy(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy every table that the catalog lists in database ``source`` into
    database ``target`` and return a manifest (table, rows) counted on the
    copies.  Temporary views are not part of a database and are skipped."""
    names = sorted(t.name for t in spark.catalog.listTables(source) if not t.isTemporary)
    parts = []
    for name in names:
        spark.table(f"{source}.{name}").write.mode("overwrite").saveAsTable(f"{target}.{name}")
        parts.append(spark.table(f"{target}.{name}").agg(F.count(F.lit(1)).cast("long").alias("rows"))
                     .select(F.lit(name).alias("table"), "rows"))
    out = spark.createDataFrame([], "table string, rows long")
    for p in parts:
        out = out.unionByName(p)
    return out
