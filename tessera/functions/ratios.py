"""Token ratios of two name columns as plain Spark expressions.

Same definitions as ``functions.fuzzy``.  The longest common subsequence is
bit-parallel: a fold over the characters of the second string keeps, in words of
``WORD`` bits, the rows of the first string where the match length grows; the
addition's carry runs on from word to word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 62  # the sum of two words stays below 2^63


def processed(name: Column) -> Column:
    """``functions.fuzzy.process`` as an expression."""
    ascii_only = F.regexp_replace(name, r"[^\x00-\x7f]", "")
    return F.trim(F.lower(F.regexp_replace(ascii_only, "[^A-Za-z0-9_]", " ")))


def _upto(n: Column) -> Column:
    """0 .. n-1, empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _once(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _shift(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings."""
    zero = F.lit(0).cast("long")

    def masks(chars: Column) -> Column:
        """character -> its places in ``chars``, in words."""
        def word(ch: Column, w: Column) -> Column:
            part = F.slice(chars, w * WORD + 1, WORD)
            return F.aggregate(_upto(F.size(part)), zero, lambda m, i: F.when(F.get(part, i) == ch, m.bitwiseOR(_shift(i))).otherwise(m))

        words = _upto(F.ceil(F.size(chars) / WORD).cast("int"))
        return F.map_from_entries(F.transform(F.array_distinct(chars), lambda ch: F.struct(ch, F.transform(words, lambda w: word(ch, w)))))

    def fold(s: Column) -> Column:
        n, found = s["n"], s["masks"]
        words = _upto(F.ceil(n / WORD).cast("int"))
        full = F.transform(words, lambda w: _shift(F.least(F.lit(WORD), n - w * WORD)) - 1)

        def add(v: Column, m: Column, f: Column):
            def one(t: Column, w: Column) -> Column:
                old = F.get(v, w)
                hit = old.bitwiseAND(F.get(m, w))
                total = old + hit + t["carry"]
                new = total.bitwiseOR(old - hit).bitwiseAND(F.get(f, w))
                return F.struct(F.shiftright(total, WORD).alias("carry"), F.concat(t["out"], F.array(new)).alias("out"))

            start = F.struct(zero.alias("carry"), F.array().cast("array<long>").alias("out"))
            return F.aggregate(words, start, one, lambda t: t["out"])

        def run(f: Column) -> Column:
            step = lambda v, c: F.when(F.map_contains_key(found, c), add(v, F.element_at(found, c), f)).otherwise(v)
            left = F.aggregate(F.split(b, ""), f, step)
            return n - F.aggregate(left, F.lit(0), lambda k, x: k + F.bit_count(x))

        return _once(full, run)

    chars = F.split(a, "")
    state = F.struct(F.char_length(a).alias("n"), masks(chars).alias("masks"))
    return F.when((a == "") | (b == ""), F.lit(0)).otherwise(_once(state, fold))


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def token_sort(ta: Column, tb: Column) -> Column:
    """Ratio of two token arrays in order, rounded half to even."""
    def of(s: Column) -> Column:
        total = F.char_length(s["x"]) + F.char_length(s["y"])
        indel = total - 2 * lcs_length(s["x"], s["y"])
        return F.when(total == 0, F.lit(100.0)).otherwise((1.0 - indel / total) * 100)

    both = F.struct(_joined(F.array_sort(ta)).alias("x"), _joined(F.array_sort(tb)).alias("y"))
    return F.rint(_once(both, of)).cast("int")


def token_set(ta: Column, tb: Column) -> Column:
    """Best ratio among the shared tokens, and those with either side's own."""
    def of(s: Column) -> Column:
        c, x, y = F.char_length(s["c"]), F.char_length(s["x"]), F.char_length(s["y"])
        gap = F.when(c > 0, 1).otherwise(0)          # the blank after the shared tokens
        lx, ly = c + gap + x, c + gap + y            # lengths of shared + own
        share = lambda d, n: 100 - 100 * d / n       # noqa: E731
        plain = share(x + y - 2 * lcs_length(s["x"], s["y"]), lx + ly)  # the shared prefix is in the subsequence
        best = F.when(c > 0, F.greatest(plain, share(lx - c, c + lx), share(ly - c, c + ly))).otherwise(plain)
        return F.when((x == 0) | (y == 0), F.lit(100.0)).otherwise(best)

    own = lambda a, b: _joined(F.array_sort(F.array_except(a, b)))
    parts = F.struct(_joined(F.array_sort(F.array_intersect(ta, tb))).alias("c"), own(ta, tb).alias("x"), own(tb, ta).alias("y"))
    return F.when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0)).otherwise(F.rint(_once(parts, of)).cast("int"))


def pair_scores(a: Column, b: Column) -> Column:
    """struct<token_sort, token_set, score> of two name columns; null names
    give nulls."""
    tokens = lambda c: F.filter(F.split(processed(c), " +"), lambda x: x != "")

    def of(s: Column) -> Column:
        scores = F.struct(token_sort(s["a"], s["b"]).alias("token_sort"), token_set(s["a"], s["b"]).alias("token_set"))
        return _once(scores, lambda r: F.struct(
            r["token_sort"].alias("token_sort"), r["token_set"].alias("token_set"),
            F.floor((r["token_sort"] + r["token_set"]) / 2).cast("int").alias("score")))

    none = F.struct(*(F.lit(None).cast("int").alias(c) for c in ("token_sort", "token_set", "score")))
    return F.when(a.isNull() | b.isNull(), none).otherwise(_once(F.struct(tokens(a).alias("a"), tokens(b).alias("b")), of))
