"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

1. Seeds: e-mail, address, card and phone patterns.  A text is split at the
   matches of a pattern; the running sum of piece and match lengths gives the
   positions.  The patterns never step back over a long run.
2. Candidates: units (runs without blanks and delimiters) of at least
   ``MIN_CHARS`` characters with ``MIN_DIGITS`` digits that no seed overlaps.
3. The graph: every seed and candidate occurrence links its value with two
   lexical patterns, the unit before it and the two units before it (A-Z
   lower-cased, digits as 0).  Occurrences are counted per (patterns, value), so
   frequent ones are one row.  One scan counts how often each pattern
   with enough values stands in the corpus, whatever follows.
4. Rounds: a pattern is trusted if at least ``MIN_VALUES`` accepted values follow
   it and they make up ``TRUST`` percent of all its places; a candidate value is
   accepted if trusted patterns precede at least half of its occurrences.  Seeds
   stay accepted.  All scores are integer counts, so reruns agree.
5. Every occurrence of an accepted candidate is a span of kind ``id``.

The context of an occurrence are the last two units within ``REACH`` characters
before it.

Edge cases: null and empty texts have no spans and keep their row; repeated rows
and equal doc_ids are separate texts; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import ASCII_LOWER, ASCII_UPPER, indices, maybe_in, pinned, saved

DELIMITER = r"""\x00-\x20\x7F"'(),:;<=>\[\]{}|"""
#: kind -> pattern: possessive runs, begun only where no longer run could begin
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "id": rf"(?<![^{DELIMITER}])[^{DELIMITER}0-9]*+[0-9][^{DELIMITER}]*+",
}
KINDS = list(PATTERNS)
BASE_KINDS = KINDS[:4]
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
MARKER = -1
MIN_CHARS, MIN_DIGITS, MIN_VALUES, TRUST, ROUNDS, REACH = 6, 3, 3, 60, 3, 160


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _valid(kind: Column, v: Column) -> Column:
    """Whether a match passes the check of its kind."""
    digits = _digits(v)
    is_kind = lambda k: kind == KINDS.index(k)
    return (F.when(is_kind("ip"), v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
            .when(is_kind("card"), F.length(digits).between(12, 19) & F.call_function("luhn_check", digits))
            .when(is_kind("phone"), F.length(digits).between(9, 15))
            .when(is_kind("id"), (F.length(v) >= MIN_CHARS) & (F.length(digits) >= MIN_DIGITS))
            .otherwise(F.lit(True)))


def _units(text: Column) -> Column:
    """Lower-cased units of a text, digits as 0."""
    plain = F.translate(text, ASCII_UPPER + "123456789", ASCII_LOWER + "0" * 9)
    return F.array_remove(F.split(plain, f"[{DELIMITER}]+", -1), "")


def _matches(kind: str, pieces: Column, hits: Column) -> Column:
    """Array of the matches of one pattern: order, length of the text since the
    match before, value and the text before it."""

    def row(k: Column) -> Column:
        at = lambda a, i: F.coalesce(F.get(a, i), F.lit(""))
        before = F.concat(at(hits, k - 3), at(pieces, k - 2), at(hits, k - 2), at(pieces, k - 1), at(hits, k - 1), at(pieces, k))
        value = F.get(hits, k)
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), k.alias("k"), F.length(F.get(pieces, k)).alias("gap"),
                        F.length(value).alias("len"), value.alias("value"), F.right(before, F.lit(REACH)).alias("before"))

    return F.transform(indices(F.size(hits)), row)


def occurrences(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, kind, start, stop, value, l1, l2): checked matches of
    all patterns, candidates (kind ``id``) only where no seed overlaps, and a
    marker row of every text."""
    df = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind, pattern in PATTERNS.items():
        df = df.withColumn(f"p_{kind}", pinned(F.split("text", pattern, -1)))
        df = df.withColumn(f"h_{kind}", pinned(F.when(
            F.size(f"p_{kind}") > 1, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
            .otherwise(F.array().cast("array<string>"))))
    marker = F.array(F.struct(F.lit(MARKER).alias("kind"), F.lit(0).alias("k"), F.lit(0).alias("gap"), F.lit(0).alias("len"),
                              F.lit("").alias("value"), F.lit("").alias("before")))
    df = df.select("rid", "doc_id", F.inline(F.concat(
        marker, *(_matches(k, F.col(f"p_{k}"), F.col(f"h_{k}")) for k in KINDS))))
    units = _units(F.col("before"))
    df = df.withColumn("units", units).select(
        "rid", "doc_id", "kind", "k", "gap", "len", "value",
        F.get("units", F.size("units") - 1).alias("l1"), F.get("units", F.size("units") - 2).alias("l2"))
    df = df.repartition("rid")  # both windows below share this one shuffle
    run = Window.partitionBy("rid", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("start", F.sum(F.col("gap") + F.col("len")).over(run) - F.col("len"))
    tail = F.when(F.col("kind") == KINDS.index("id"), F.regexp_replace("value", "[.!?]+$", "")).otherwise(F.col("value"))
    df = df.withColumn("value", tail).withColumn("stop", F.col("start") + F.length("value"))
    df = df.where((F.col("kind") == MARKER) | _valid(F.col("kind"), F.col("value")))
    seed = F.col("kind").between(0, len(BASE_KINDS) - 1)
    order = Window.partitionBy("rid").orderBy("start")
    reach = F.max(F.when(seed, F.col("stop"))).over(order.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(seed, F.col("start"))).over(order.rangeBetween(0, Window.unboundedFollowing))
    free = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("stop")) >= F.col("stop"))
    return df.withColumn("free", free).where((F.col("kind") != KINDS.index("id")) | F.col("free")).select(
        "rid", "doc_id", "kind", "start", "stop", "value", "l1", "l2")


def _pair(a: Column, b: Column) -> Column:
    """The two-unit pattern; null where a unit is missing."""
    return F.concat(a, F.lit(" "), b)


def graph(found: DataFrame) -> DataFrame:
    """(value, seed, one, two, n): occurrence counts per value and patterns."""
    real = found.where((F.col("kind") != MARKER) & F.col("l1").isNotNull())
    return real.groupBy("value", (F.col("kind") != KINDS.index("id")).alias("seed"), F.col("l1").alias("one"),
                        _pair(F.col("l2"), F.col("l1")).alias("two")).agg(F.count("*").alias("n"))


def _by_pattern(edges: DataFrame) -> DataFrame:
    """(pattern, value, seed, n) of both patterns of every edge."""
    rows = edges.select("value", "seed", "n", F.explode(F.array("one", "two")).alias("pattern"))
    return rows.where(F.col("pattern").isNotNull()).groupBy("pattern", "value", "seed").agg(F.sum("n").alias("n"))


def corpus_counts(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, places): how often each pattern stands in the texts.  A bitmap
    of bounded size drops most of the other places before the count."""
    units = docs.select(pinned(_units(F.coalesce("text", F.lit("")))).alias("u"))
    places = units.select(F.explode(F.transform(indices(F.size("u")), lambda i: F.struct(
        F.get("u", i).alias("one"), F.get("u", i - 1).alias("before")))).alias("p")).select("p.*")
    # a two-unit pattern of enough values implies its one-unit pattern
    keys = patterns.select("pattern")
    places = maybe_in(places, "one", keys.toDF("one")).where("_maybe").select(
        F.explode(F.array("one", _pair(F.col("before"), F.col("one")))).alias("pattern")).where(F.col("pattern").isNotNull())
    places = maybe_in(places, "pattern", keys).where("_maybe").groupBy("pattern").agg(F.count("*").alias("places"))
    return places.join(patterns.select("pattern"), "pattern")


def accepted_values(edges: DataFrame, places: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value): candidates that trusted patterns discover."""
    by_pattern = saved(_by_pattern(edges).join(places, "pattern"), "pii-patterns")
    candidates = edges.where(~F.col("seed"))
    trusted_by = lambda c: F.coalesce(F.col(c), F.lit(False))
    accepted = None
    for _ in range(rounds):
        rows = by_pattern
        if accepted is None:
            rows = rows.where("seed")
        else:
            rows = rows.join(accepted.withColumn("ok", F.lit(True)), "value", "left").where(F.col("seed") | F.col("ok"))
        good = rows.groupBy("pattern").agg(F.sum("n").alias("n"), F.count_distinct("value").alias("values"), F.max("places").alias("places"))
        good = good.where((F.col("values") >= MIN_VALUES) & (100 * F.col("n") >= TRUST * F.col("places")))
        good = good.select("pattern", F.lit(True).alias("good"))
        hits = (candidates.join(good.toDF("one", "good1"), "one", "left").join(good.toDF("two", "good2"), "two", "left")
                .withColumn("hit", trusted_by("good1") | trusted_by("good2")))
        accepted = hits.groupBy("value").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("hit"), F.col("n"))).alias("hits"))
        accepted = saved(accepted.where(2 * F.col("hits") >= F.col("n")).select("value"), "pii-values")
    return accepted


def find(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(rid, doc_id, spans) for every text; spans are sorted (start, kind, stop)
    with ``kind`` an index of ``KINDS``, and the text's matches checked."""
    found = saved(occurrences(docs), "pii-occurrences")
    edges = saved(graph(found), "pii-graph")
    patterns = _by_pattern(edges).groupBy("pattern").agg(F.count_distinct("value").alias("values"))
    patterns = saved(patterns.where(F.col("values") >= MIN_VALUES).select("pattern"), "pii-candidates")
    places = saved(corpus_counts(docs, patterns), "pii-places")
    values = accepted_values(edges, places, rounds)
    is_id = F.col("kind") == KINDS.index("id")
    kept = found.where(~is_id).drop("value").unionByName(found.where(is_id).join(values, "value", "left_semi").drop("value"))
    span = F.when(F.col("kind") != MARKER, F.struct("start", "kind", "stop"))
    return kept.groupBy("rid", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
