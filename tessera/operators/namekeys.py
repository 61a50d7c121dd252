"""Keys under which two names must meet if their combined score reaches a
threshold T: the exact candidate index of the fuzzy name join.

The combined score is the mean of the token-sort and the token-set ratio, so one
of the two is at least T.

* Names with a shared token meet under that token.
* Without one, token-set is the plain ratio of the distinct tokens in order, so
  for one of the two strings (all tokens, distinct tokens) the longest common
  subsequence is K >= r (l + m) / 2 with r = (T - 0.5) / 100.  A bigram of
  one string survives in the other unless one of its characters is dropped
  (at most 2 (l - K) bigrams) or something is inserted between them (at
  most m - K), which leaves (1.5 r - 1) (l + m) - 1 common bigrams.  By the
  prefix rule two such names share one of their rarest bigrams.
* Strings too short for that bound share one of their rarest characters.

Repeated grams are numbered, so that multisets become sets.  Below ``MIN_T``
the bigram bound is empty and every name has the one key ``*``: all pairs are
then compared, in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ratios import processed
from tessera.session import materialize

MIN_T = 68


def _numbered(grams: Column) -> Column:
    count = lambda g, i: F.size(F.filter(F.slice(grams, 1, i + 1), lambda x: x == g))
    return F.transform(grams, lambda g, i: F.concat(g, F.lit("#"), count(g, i).cast("string")))


def _grams(s: Column, q: int) -> Column:
    n = F.char_length(s) - q + 1
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.substring(s, i, F.lit(q)))


def key_rows(names: DataFrame, threshold: int) -> DataFrame:
    """(key, name, s, keys): one row per name and key; ``s`` are the name's
    tokens in order, ``keys`` the hashes of all its keys."""
    tokens = F.array_sort(F.filter(F.split(processed(F.col("name")), " +"), lambda x: x != ""))
    df = names.select("name", tokens.alias("tokens"))
    df = df.select("name", "tokens", F.array_join("tokens", " ").alias("s"), F.array_join(F.array_distinct("tokens"), " ").alias("u"))
    if threshold < MIN_T:
        return df.select(F.lit("*").alias("key"), "name", "s", F.array(F.hash(F.lit("*"))).alias("keys"))
    r = (threshold - 0.5) / 100
    shortest = r / (2 - r)                       # a partner has at least this share of the length
    bound = 1.5 * r - 1
    short = 2 / bound * (2 - r) / 2              # up to here a pair may have no common bigram
    text = df.select("name", F.explode(F.array_distinct(F.array("s", "u"))).alias("x")).where("x != ''")
    text = text.withColumn("l", F.char_length("x"))
    common = F.greatest(F.lit(1), F.ceil(bound * (1 + shortest) * F.col("l") - 1 - 1e-9))
    chars = F.ceil(shortest * F.col("l") - 1e-9)
    two = F.struct(F.lit("g").alias("kind"), (F.col("l") - common).alias("take"), _numbered(_grams(F.col("x"), 2)).alias("grams"))
    one = F.struct(F.lit("c").alias("kind"), (F.col("l") - chars + 1).alias("take"),
                   F.when(F.col("l") <= short, _numbered(_grams(F.col("x"), 1))).otherwise(F.array().cast("array<string>")).alias("grams"))
    text = text.select("name", "x", F.inline(F.array(two, one)))
    grams = materialize(text.select("name", "x", "take", F.explode(F.transform("grams", lambda g: F.concat("kind", F.lit(":"), g))).alias("gram")),
                        "name-grams")
    rarity = grams.groupBy("gram").agg(F.count("*").alias("n"))
    # a group is the grams of one name
    chosen = grams.join(rarity, "gram").groupBy("name", "x", F.substring("gram", 1, 1).alias("kind"), "take").agg(
        F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    chosen = chosen.select("name", F.explode(F.slice("grams", F.lit(1), F.col("take").cast("int"))).alias("g")).select("name", F.col("g.gram").alias("key"))
    keys = df.select("name", F.explode(F.transform(F.array_distinct("tokens"), lambda t: F.concat(F.lit("t:"), t))).alias("key"))
    keys = keys.unionByName(chosen).groupBy("name").agg(F.collect_set("key").alias("all"))
    hashes = F.array_sort(F.transform("all", lambda k: F.hash(k)))
    return df.select("name", "s").join(keys, "name").select(F.explode("all").alias("key"), "name", "s", hashes.alias("keys"))
