"""The locate-chain LIKE equals Spark's LIKE on random strings and patterns."""

import random

from pyspark.sql import functions as F

from tessera.functions.strings import like


def test_like_matches_spark_like(spark):
    rnd = random.Random(7)
    alpha = "abc "
    texts = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 12))) for _ in range(300)] + [None]
    pieces = ["", "a", "b", "ab", "ba", "aa", "c a", "abc"]
    patterns = set()
    for _ in range(60):
        k = rnd.randint(1, 4)
        parts = [rnd.choice(pieces) for _ in range(k)]
        lead = "%" if rnd.random() < 0.7 else ""
        trail = "%" if rnd.random() < 0.7 else ""
        patterns.add(lead + "%".join(parts) + trail)
    patterns |= {"%", "%%", "a%", "%a", "a%a", "%aa%a%", "ab%ba"}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    cols = []
    for j, p in enumerate(sorted(patterns)):
        cols.append((F.col("t").like(p).eqNullSafe(like(F.col("t"), p))).alias(f"ok{j}"))
    row = df.select(*cols).agg(*[F.min(F.col(f"ok{j}").cast("int")).alias(f"m{j}")
                                 for j in range(len(patterns))]).first()
    bad = [p for j, p in enumerate(sorted(patterns)) if row[f"m{j}"] != 1]
    assert bad == []
