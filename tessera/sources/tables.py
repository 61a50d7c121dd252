"""Access to the parquet tables of one scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy handles: ``Tables(spark, d).lineitem`` is a parquet scan.

    Nothing is read until an action runs, so projections and filters
    written later are pushed into the scan by Catalyst.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def register_views(self) -> None:
        for name in TABLE_NAMES:
            getattr(self, name).createOrReplaceTempView(name)
