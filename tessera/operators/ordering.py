"""Dense positions in a global order without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import materialize

_LOW = 33  # a row counter holds the task in the bits above, the row below


def with_position(df: DataFrame, order: list, name: str = "pos") -> DataFrame:
    """``df`` with ``name``, 0 .. n-1 in the given order (unique keys make it
    repeatable).  Rows are range-partitioned, sorted and written with their
    place in the task; the offsets come from one count per task."""
    rows = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    rows = materialize(rows, "ordered")
    part = F.shiftright("_place", _LOW)
    sizes = rows.groupBy(part.alias("_task")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    offset = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.withColumn("_task", part).join(F.broadcast(offset), "_task")  # else the wide rows are shuffled again
    row = F.col("_place").bitwiseAND(F.lit((1 << _LOW) - 1))
    return placed.withColumn(name, F.col("_before") + row).drop("_task", "_place", "_before")
