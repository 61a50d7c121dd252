"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize, ship_package

# The two word classes of the query contracts.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def spaced_words(text: Column) -> Column:
    """Words between ASCII white space; null and blank texts give none."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1)
    return F.array_remove(parts, "")


def alnum_words(text: Column) -> Column:
    """A-Z lower-cased words of letters, digits and all non-ASCII characters."""
    low = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_LOWER)
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def indices(n: Column) -> Column:
    """Array 0 .. n-1; empty for n <= 0 (plain ``sequence`` would count down)."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(
        F.array().cast("array<int>"))


def pinned(value: Column) -> Column:
    """The same value, evaluated where it is written: a row counter in
    the expression keeps the optimizer from copying it into later filters and
    lambdas, where it would run once per element."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: later jobs then
    neither recompute the rows nor depend on one executor's memory."""
    ship_package(df.sparkSession)
    return materialize(df, f"llm-{tag}")


def maybe_in(df: DataFrame, key: str, keys: DataFrame, words: int = 1 << 19) -> DataFrame:
    """``df`` with a boolean ``_maybe``: false only where ``key`` is surely
    not among ``keys.key``.  The broadcast is a bitmap of at most ``words``
    rows of 64 bits, whatever the number of keys; when it fills up it lets
    more rows through and the exact join behind it does the rest."""
    bit = F.xxhash64(F.col(key), F.lit("maybe"))
    word, place = F.pmod(F.shiftrightunsigned(bit, 6), F.lit(words)), F.pmod(bit, F.lit(64)).cast("int")
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    bitmap = keys.select(word.alias("_word"), mark.alias("_mark")).groupBy("_word").agg(F.bit_or("_mark").alias("_bits"))
    return (df.withColumn("_word", word).join(F.broadcast(bitmap), "_word", "left")
            .withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(mark) != 0, F.lit(False))).drop("_word", "_bits"))
