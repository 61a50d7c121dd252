"""Query registry: name -> (plan, oracle SQL).

A plan is ``fn(spark, sf_dir) -> DataFrame``.  The oracle is an ANSI SQL
string that DuckDB runs over the same parquet tables; it is omitted for
iterative algorithms that SQL cannot state.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ship_package

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def shipped(fn: Plan) -> Plan:
    """The plan, with the package sent to the executors before it is built."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


def query(name: str, sql: str | None = None):
    def deco(fn: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = shipped(fn)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco
