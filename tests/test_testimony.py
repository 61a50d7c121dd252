import datetime

from pyspark.sql import functions as F

from tessera.operators import filters
from tessera.operators.ordering import with_position
from tessera.plans import roles
from tessera.sources.tables import Tables
from tests.conftest import SF_SMALL


def test_rows_of_papers_with_null_and_repeated_keys(spark):
    rows = [(1, 2020, "a"), (1, 2021, "b"), (1, None, "c"), (None, 2020, "d"), (2, 2020, "e"), (2, 2020, "e"), (3, 2020, "f")]
    papers = [(1, 2020), (1, 2020), (1, None), (1, 2022), (2, 2019), (2, 2020), (None, 2020), (3, None)]
    a = spark.createDataFrame(rows, "LDNumber long, legislature int, v string")
    got = roles.of_papers(a, spark.createDataFrame(papers, "paperNumber long, legislature int"), "LDNumber", F.col("legislature"))
    assert got.columns == a.columns
    assert sorted(r["v"] for r in got.collect()) == ["a", "e", "e"]


def test_testimony_is_dealt_by_paper_once(spark):
    t, key = Tables(spark, SF_SMALL), "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = filters.active_testimony(roles.testimony_full(t, papers=roles.bills(t)))._jdf.queryExecution().executedPlan().toString()
        placed = with_position(spark.createDataFrame([(datetime.date(2020, 1, k % 9 + 1), k) for k in range(50)], "d date, k long"), ["d", "k"])
        sides = placed._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["pos"] for r in placed.select(F.col("pos")).collect()) == list(range(50))
    finally:
        spark.conf.set(key, old)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 5 and sum("hashpartitioning(l_orderkey" in line for line in dealt) == 1
    assert "BroadcastHashJoin" in sides and "SortMergeJoin" not in sides
