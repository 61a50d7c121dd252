"""Blocked co-occurrence product against a brute-force pair count."""

import itertools
from collections import Counter

from tessera.operators import cooccur


def test_blocked_product_matches_pairs(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    p = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    rows = li.join(p, li.l_partkey == p.p_partkey).select("p_name", "l_orderkey").distinct().collect()
    by_bill = {}
    for r in rows:
        by_bill.setdefault(r.l_orderkey, set()).add(r.p_name)
    want = Counter()
    for orgs in by_bill.values():
        for a, b in itertools.combinations(sorted(orgs), 2):
            want[(a, b)] += 1
    df = spark.createDataFrame([(r.p_name, r.l_orderkey) for r in rows], "org string, bill long")
    inc = cooccur.incidence(df, "org", "bill")
    for kw in ({}, {"heavy": 3, "pairs_per_task": 500}, {"heavy": 1}):  # light, mixed, heavy baskets only
        got = cooccur.cooccurrence(inc, **kw)
        assert {(r.item_a, r.item_b): r.shared for r in got.collect()} == dict(want)
    assert cooccur.cooccurrence(inc.limit(0)).collect() == []
