import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import suffix


def brute(rows, length):
    """rows: (doc_id, text) in document order; keeps a set of all strings seen."""
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), int(gone[:len(raw)].sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def made(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefé") for _ in range(rnd.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(40) for _ in range(4)]
    rows = []
    for k in range(70):
        t = text(rnd.randrange(5, 80))
        kind = rnd.randrange(7)
        if kind < 2:
            t += " " + rnd.choice(shared) + " " + text(10)
        elif kind == 2:
            s = rnd.choice(shared)
            t = s[rnd.randrange(60):] + t
        elif kind == 3 and rows:
            t = rnd.choice(rows)[1]
        elif kind == 4 and rows:
            old = rnd.choice(rows)[1] or "x"
            at = rnd.randrange(len(old))
            t = old[:at] + "ZZ" + old[at + 1:]
        elif kind == 5:
            t = t[:150] * 4
        rows.append((k, t))
    rows[5] = (5, None)
    rows[6] = (6, "")
    rows[7] = (7, "a" * 500)
    rows[8] = (8, "ab" * 300 + "a" * 120)
    rows[9] = (9, "short")
    return rows


@pytest.mark.parametrize(("length", "gram"), [(100, 32), (40, 16)])
def test_against_brute_force(spark, length, gram):
    rows = made(length)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, doc string, low string").repartition(5)
    got = sorted(map(tuple, suffix.remove_repeats(df, length, gram, digest=True).collect()))
    assert got == brute(rows, length)
    assert sum(r[2] for r in got) > 2000


def test_pieces_of_long_texts(spark, monkeypatch):
    rows = made(7)
    long = " ".join(t or "" for _, t in rows)
    rows += [(100, long), (101, long[37:] + "tail" + long[:5000])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffix, "PIECE", 1500)
    got = {}
    for start, part in [(0, df)]:
        found = []
        for texts in [[suffix.utf8(t) for _, t in rows]]:
            for r, o, parts in suffix.pieces(texts, 100):
                assert sum(map(len, parts)) <= 1500
                found += list(zip(r, o, parts))
    starts = {}
    for r, o, part in found:  # every start of every text lies in exactly one part
        for p in range(len(part) - 99):
            assert (r, o + p) not in starts
            starts[r, o + p] = 1
    assert len(starts) == sum(max(0, len(suffix.utf8(t)) - 99) for _, t in rows)


def test_repeated_and_null_ids(spark):
    t = made(3)[20][1] + "x" * 150
    rows = [(None, t), (1, t), (1, t), (2, "other " * 3), (2, None)]
    got = sorted(map(tuple, suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    n = len(t.encode())
    whole = [r for r in got if r[0] is None]
    assert whole[0][1] == n and whole[0][2] < n
    assert [r[2] for r in got if r[0] == 1] == [n, n] and all(r[3] == 1 for r in got if r[0] == 1)
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark):
    from tessera.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(map(tuple, QUERIES["op6_suffix_dedup"](spark, sf).collect())) == brute(rows, 100)


def test_contexts_of_one_anchor_are_dealt_out(spark):
    # rank 1: 3000 contexts, one of them repeated; rank 2: one context, repeated; rank 3: alone
    rows = [(1, c, 10 + c, 5, 3) for c in range(3000)] + [(1, 7, 9000, 2, 4), (2, 1, 4, 0, 1), (2, 1, 4, 50, 1), (3, 1, 5, 0, 2),
                                                          (99, 1, 6, 0, 2 + suffix.SETTLED)]
    found = spark.createDataFrame(rows, "rank long, context long, doc long, low long, span int").repartition(3)
    want = {(10 + c, 5, 8, True) for c in range(3000)} | {(9000, 2, 6, False), (4, 50, 51, False), (6, 0, 2, False)}
    got = [tuple(r) for r in suffix.settled(found).collect()]
    assert len(got) == len(want) and set(got) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = suffix.earliest(found).where("rank = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 2000


def test_open_intervals_are_settled_by_blocks(spark):
    rnd = random.Random(11)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = text(3000)
    rows = []
    for k in range(60):  # the passage is entered and left at other places by every document
        at = rnd.randrange(2500)
        rows.append((k, text(60) + passage[at:at + rnd.randrange(120, 500)] + text(60)))
    df = suffix.numbered(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    found = suffix.settled(suffix.anchors(df, 100, 32)).where("open").select("doc", "low", "high").cache()
    opened = suffix.with_intervals(df, found, keep_rest=False)
    blocks = suffix.settled(suffix.block_rows(opened, 100, 32)).cache()
    starts = F.sum(F.col("high") - F.col("low") + 1)
    before, after = found.agg(starts).first()[0], blocks.where("open").agg(starts).first()[0]
    assert before > 500 and after < before / 2
    inside = {(r["doc"], p) for r in found.collect() for p in range(r["low"], r["high"] + 1)}
    assert {(r["doc"], p) for r in blocks.collect() for p in range(r["low"], r["high"] + 1)} <= inside
    got = sorted(map(tuple, suffix.remove_repeats(df, digest=True).collect()))
    assert got == brute(rows, 100)


def test_anchors_of_intervals(spark):
    data = np.frombuffer(made(9)[20][1].encode() * 2, np.uint8)
    h = suffix.Hashes(data)
    low, high, rank, _ = suffix.anchor_rows(data, np.array([len(data)]), 100, 32)
    anchor = suffix.anchor_of(h, low, 100, 32)
    assert (h.at(anchor, anchor + 32) == rank).all()
    assert (suffix.anchor_of(h, high, 100, 32) == anchor).all() and (high <= anchor).all()
