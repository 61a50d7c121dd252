"""Spark session helpers.

Library code never creates its own cluster settings: it reads what the
session has.  ``get_spark`` is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only below this size; larger sides fall back to a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}

# removes the shuffle files of a query when it ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "tessera") -> SparkSession:
    builder = SparkSession.builder.master(master or "local[8]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when nothing is configured (unit tests, laptops) a
    private scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that
    Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-pkg-"), "tessera.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tessera", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._tessera_shipped = True


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables under the checkpoint root.

    Written tables (rather than in-memory caches) cut lineage and survive
    executor loss because they live on the shared checkpoint storage.
    """
    import uuid

    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tessera-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, tag: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back.  Used by iterative jobs to cut lineage each round: a fresh scan
    carries neither the lineage nor the optimizer constraints of the
    rounds before (``Dataset.checkpoint`` keeps the latter, and they grow
    with every round), and the files survive the loss of any executor.

    Once the table is written nothing reads the shuffle files of its job
    again: Spark removes them then, not at some later collection of the
    driver's heap.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.parquet(path)
    out.written = path
    return out


def discard(df) -> None:
    """Delete a table that ``materialize`` wrote and that nothing reads again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.written)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
