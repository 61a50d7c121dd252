import hashlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import vectorcodes as vc

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("rid", T.StringType()), T.StructField("q", T.StringType())])


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain Lloyd over Python integers: {row number: (code, error)}, digest."""
    kept = {i: [int(np.floor(max(min(float(np.float32(x)) * 1024, 2**26), -2**26))) for x in r[1]] for i, r in enumerate(rows)
            if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])}
    order = sorted(kept, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, kept[i]))
    if not order:
        return {}, ""
    dim = len(kept[order[0]])
    order = [i for i in order if len(kept[i]) == dim]
    width = -(-dim // parts)
    cut = {i: [(kept[i] + [0] * (parts * width - dim))[p * width:(p + 1) * width] for p in range(parts)] for i in order}
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def best(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for i in order:
                members.setdefault(best(cut[i][p], books[p])[1], []).append(cut[i][p])
            for k, found in members.items():
                books[p][k] = [sum(col) // len(found) for col in zip(*found)]
    out = {}
    for i in order:
        near = [best(cut[i][p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in near), sum(d for d, _ in near))
    text = ",".join(str(x) for book in books for e in book for x in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    codes, books = vc.compress(df, **kw)
    got = sorted(((str(r["vec_id"]), str(r["label"]), r["code"], r["error"], r["label_error"])
                  for r in vc.with_label_error(codes).collect()))
    want, digest = brute(rows, **kw)
    totals = {}
    for i, (_, err) in want.items():
        totals[rows[i][2]] = totals.get(rows[i][2], 0) + err
    assert got == sorted((str(rows[i][0]), str(rows[i][2]), code, err, totals[rows[i][2]]) for i, (code, err) in want.items())
    assert not want or vc.books_digest(books) == digest


def test_against_plain_lloyd(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 8).astype(np.float32)], int(rng.integers(3))) for i in rng.permutation(150)]
    rows += [(200 + i, rows[0][1], None) for i in range(80)]  # one vector holds a third of all rows
    check(spark, rows, entries=16)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5, -0.25, 0.1, 0.0, -0.0005, 0.3, 0.7]
    rows = [(5, good, 1), (3, [x + 1 for x in good], 1), (3, [x - 1 for x in good], None), (None, good, None), (1, None, 2),
            (0, [nan] + good[1:], 2), (2, [None] + good[1:], 2), (4, [inf] + good[1:], 2), (9, good[:4], 2), (10, [], 2),
            (11, [3e38] + good[1:], 4), (12, [-3e38] + good[1:], 4)]
    check(spark, rows)
    check(spark, [(1, [], 1), (2, [], 2)])
    check(spark, [(1, None, 1)])
    codes, _ = vc.compress(spark.createDataFrame([], SCHEMA))
    assert vc.with_label_error(codes).collect() == []


def test_residents_do_not_move(spark):
    """Only parts that change their entry go through a shuffle: the union of
    residents and arrivals keeps the partitions of the members."""
    sc = spark.sparkContext
    owners = vc.Owners(4, 2, 1)
    part = np.arange(12).reshape(-1, 1)
    ids = np.arange(12)
    blocks = [b for e in range(4) for b in owners.dealt(0, ids[e::4], part[e::4], np.full(3, e))]
    members = sc.parallelize(blocks).partitionBy(3).mapPartitions(owners.gather, preservesPartitioning=True)
    after, books = vc.lloyd(members, owners, [part[:4].copy()], 2)
    assert after.getNumPartitions() == 3 and after.partitioner == members.partitioner
    assert sorted(i for _, b in after.collect() for i in owners.unpack(b)[0].tolist()) == ids.tolist()


@pytest.mark.parametrize("peak", [10, 2**26])
def test_nearest_is_exact(peak):
    rng = np.random.default_rng(1)
    part, book = rng.integers(-peak, peak + 1, (50, 5)), rng.integers(-peak, peak + 1, (9, 5))
    book[7] = book[2]
    index, dist = vc.nearest(part, book)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book)) for v in part]
    assert list(zip(dist.tolist(), index.tolist())) == want
