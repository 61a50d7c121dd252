"""keyed_block_pairs visits every unordered pair of a key's rows exactly once."""

import itertools

import pandas as pd
import pytest

from tessera.operators.spanning import keyed_block_pairs


def _all_pairs(left, right, same):
    if same:
        pairs = [(a, b) for a, b in itertools.combinations(left["id"].tolist(), 2)]
    else:
        pairs = [(a, b) for a in left["id"].tolist() for b in right["id"].tolist()]
    pairs = [(min(a, b), max(a, b)) for a, b in pairs]
    return pd.DataFrame({"a": pd.Series([p[0] for p in pairs], dtype="int64"),
                         "b": pd.Series([p[1] for p in pairs], dtype="int64")})


@pytest.mark.parametrize("chunk", [1, 7, 16, 100])
def test_each_pair_once(spark, chunk):
    n = 60
    df = spark.range(n)
    got = [(r.a, r.b) for r in keyed_block_pairs(df, [], "id", _all_pairs, "a long, b long", chunk_rows=chunk).collect()]
    assert len(got) == len(set(got)) == n * (n - 1) // 2
    assert set(got) == set(itertools.combinations(range(n), 2))


def test_pairs_stay_inside_their_key(spark):
    df = spark.range(60).selectExpr("id", "id % 3 AS k").where("k < 2 or id < 6")
    got = [(r.a, r.b) for r in keyed_block_pairs(df, ["k"], "id", _all_pairs, "a long, b long", chunk_rows=7).collect()]
    rows = [(r.id, r.k) for r in df.collect()]
    assert sorted(got) == sorted((a, b) for (a, x), (b, y) in itertools.combinations(sorted(rows), 2) if x == y)
