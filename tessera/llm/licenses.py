"""License scans by diagonal voting, in DataFrame functions only.

All rolling word pairs of a text are hashed and joined with the template
table (a broadcast: its rows are the words of the template list).  A hit must
repeat the template's whole k-gram word by word.  Hits vote for their
diagonal (word position - template position); neighbouring diagonals of one
template are merged into a span, so inserted or dropped words do not break
it, and a span is accepted if enough of the template's k-grams voted.  A
phrase of at most k words is one k-gram: each hit is an exact place.

Every text adds one marker row that joins a marker template, so texts
without hits stay in the result and the corpus is read and cut once.

Edge cases: null and wordless texts have no places; repeated rows and equal
doc_ids are counted row by row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import alnum_words, indices

K = 4
DRIFT = 6
MIN_COVER = 0.4

# Phrases whose places are counted, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Opening passages of well-known license texts.
TEXTS = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
             "lesser general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license you may obtain a copy of the license at"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def templates(spark: SparkSession, phrases=None, texts=None) -> DataFrame:
    """(pair, tid, label, base, tpos, n_grams, n_words, gram); row -1 is the
    marker that every text meets once."""
    phrases, texts = PHRASES if phrases is None else phrases, TEXTS if texts is None else texts
    rows = [(-1, "", True, 0, 1, 0, [])]
    for tid, (label, text, base) in enumerate([(b, a, True) for a, b in phrases] + [(a, b, False) for a, b in texts]):
        words = text.split()
        if len(words) < 2 or (base and len(words) > K):
            raise ValueError(f"a phrase has 2 to {K} words, a text at least 2: {text}")
        k = min(K, len(words))
        n = len(words) - k + 1
        rows += [(tid, label, base, i, n, len(words), words[i:i + k]) for i in range(n)]
    df = spark.createDataFrame(rows, "tid int, label string, base boolean, tpos int, n_grams int, t_words int, gram array<string>")
    return df.withColumn("pair", F.when(F.col("tid") < 0, F.lit(0).cast("long")).otherwise(
        F.xxhash64(F.get("gram", F.lit(0)), F.get("gram", F.lit(1)))))


def hits(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(rid, doc_id, n_words, tid, label, base, tpos, n_grams, word): verified
    k-gram hits, and the marker row (tid -1) of every text."""
    df = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", alnum_words(F.col("text")).alias("words"))
    pairs = F.transform(indices(F.size("words") - 1),
                        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1)))
    df = df.select("rid", "doc_id", "words", F.concat(F.array(F.lit(0).cast("long")), pairs).alias("pairs"))
    df = df.select("rid", "doc_id", "words", F.posexplode("pairs").alias("pos", "pair"))
    same = F.slice(F.col("words"), F.col("pos"), F.size("gram")) == F.col("gram")
    ok = F.when(F.col("pos") == 0, F.col("tid") < 0).otherwise((F.col("tid") >= 0) & same)
    return (df.join(F.broadcast(table), "pair").where(ok)
            .select("rid", "doc_id", F.size("words").cast("long").alias("n_words"), "tid", "label", "base", "tpos",
                    "n_grams", "t_words", (F.col("pos") - 1).cast("long").alias("word")))


def spans(found: DataFrame, drift: int = DRIFT, min_cover: float = MIN_COVER) -> DataFrame:
    """Accepted spans of the hits (rid, doc_id, n_words, tid, label, base,
    first, last, votes, cover); votes of a phrase count its exact places.
    Marker rows pass through, so every text keeps one row."""
    text, kind = ["rid", "doc_id", "n_words"], ["tid", "label", "base", "n_grams"]
    diagonal = (found.withColumn("diag", F.col("word") - F.col("tpos")).groupBy(*text, *kind, "diag")
                .agg(F.count("*").alias("votes"), F.min("word").alias("first"), F.max("word").alias("last")))
    order = Window.partitionBy("rid", "tid").orderBy("diag")
    step = F.col("diag") - F.lag("diag").over(order)
    new = step.isNull() | (step > drift) | F.col("base")  # places of a phrase are never merged
    group = F.sum(new.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    merged = (diagonal.withColumn("group", group).groupBy(*text, *kind, "group")
              .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last")))
    cover = F.least(F.lit(1.0), F.col("votes") / F.col("n_grams"))
    return merged.withColumn("cover", cover).where(F.col("cover") >= min_cover)


def scan(docs: DataFrame, phrases=None, texts=None) -> DataFrame:
    """One row per row of ``docs`` with places, labels and score."""
    found = spans(hits(docs, templates(docs.sparkSession, phrases, texts)))
    real = F.col("tid") >= 0
    place = real & F.col("base")
    listed = lambda ok: F.array_join(F.array_sort(F.collect_set(F.when(ok, F.col("label")))), ",")
    return found.groupBy("rid", "doc_id", "n_words").agg(
        F.coalesce(F.sum(F.when(place, F.col("votes"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(place, F.col("first"))).alias("first_word"),
        F.max(F.when(place, F.col("last"))).alias("last_word"),
        listed(place).alias("base_labels"), listed(real).alias("labels"),
        F.coalesce(F.max(F.when(real, F.col("cover"))), F.lit(0.0)).alias("score")).drop("rid")
