"""Quality rules as a learned decision list.

``measures`` states the row-local statistics of a text as DataFrame
expressions.  ``learn_rules`` runs sequential covering over labelled
documents: each rule is a conjunction of thresholds, grown one condition at a
time by FOIL gain on two thirds of the labelled rows, pruned from its last
condition on the other third, and kept only if it is precise there.  Every
step reads counts per (statistic, bin, label) from one Spark aggregate, so
the driver sees a table of fixed size.  ``rules_column`` turns the list into
one ordered conditional expression.

Edge cases: null text has no words and every measure is 0; empty label
tables, labels of one class and unlabelled corpora give an empty list, which
keeps every document; repeated labels of a document count once (the lowest
quality wins); repeated documents are judged row by row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import indices, pinned, saved, spaced_words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: Statistics the rules may test, as ratios of the measures.
STATS = ("words", "word_len", "symbols_per_word", "dup_line_share", "repeat_share",
         "bangs_per_word", "upper_share")
BINS = 32


def measures(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus the measures of each row; map-only."""
    keep = docs.columns if keep is None else keep
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*keep, t.alias("_q_t"), spaced_words(t).alias("_q_w"))
    lines = F.filter(F.split("_q_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.transform(indices(F.size("_q_w") - F.lit(WINDOW - 1)),
                          lambda i: F.xxhash64(F.slice("_q_w", i + 1, WINDOW)))
    df = df.select(*keep, "_q_t", "_q_w", lines.alias("_q_l"), windows.alias("_q_h"))
    # only a text with an equal pair of windows is sorted
    ordered = F.when(F.size(F.array_distinct("_q_h")) < F.size("_q_h"),
                     F.sort_array(F.transform("_q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.select(*keep, "_q_t", "_q_w", "_q_l", pinned(ordered).alias("_q_s"))
    def equal(j: Column, e: Column) -> Column:
        return F.coalesce(F.get("_q_s", j)["h"] == e["h"], F.lit(False))

    starts = F.sort_array(F.filter(
        F.transform("_q_s", lambda e, j: F.when(equal(j - 1, e) | equal(j + 1, e), e["i"])),
        lambda i: i.isNotNull()))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"])
    count = lambda pattern: (F.size(F.split("_q_t", pattern, -1)) - 1).cast("long")
    return df.select(
        *keep,
        F.size("_q_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_q_w", "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("_q_l") - F.size(F.array_distinct("_q_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        count("!").alias("n_bangs"),
        count(r"\p{Lu}").alias("n_upper"),
        F.size("_q_l").cast("long").alias("n_lines"))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_bangs", "n_upper", "n_lines"]


def base_failed() -> Column:
    """The fixed rules: too few words, or too many inside repeated windows."""
    return ((F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))


def stat(name: str) -> Column:
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_len": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "bangs_per_word": per("n_bangs", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
    }[name]


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def column(self) -> Column:
        return stat(self.name) > self.cut if self.above else stat(self.name) <= self.cut


Rule = tuple[Condition, ...]


def rule_column(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def rules_column(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects the row, null if none does."""
    out = F.lit(None).cast("int")
    for k in reversed(range(len(rules))):
        out = F.when(rule_column(rules[k]), F.lit(k)).otherwise(out)
    return out


def labelled(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """Measures of at most ``max_labelled`` labelled documents that pass the
    base rules.  The sample is the smallest hashes of doc_id, so it is the
    same in every run; its size bounds the broadcast."""
    picked = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("_q_quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return (measures(rows, keep=["doc_id", "_q_quality"])
            .where(~base_failed())
            .select(F.col("_q_quality").alias("quality"), *MEASURES,
                    (F.pmod(F.xxhash64("doc_id", F.lit("split")), F.lit(3)) == 0).alias("prune")))


def learn_rules(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000,
                max_rules: int = 8, max_conditions: int = 3, min_cover: int = 8,
                min_precision: float = 0.95) -> list[Rule]:
    """Sequential covering; ``quality`` 0 is the class to reject."""
    rows = saved(labelled(docs, labels, max_labelled), "quality-labelled")
    stats = [stat(s).alias(s) for s in STATS]
    rows = rows.select((F.col("quality") == 0).alias("bad"), "prune", *MEASURES, *stats)
    steps = [k / BINS for k in range(1, BINS)]
    bad = rows.where("bad").agg(*[F.percentile_approx(s, steps, 1000).alias(s) for s in STATS]).first()
    good = rows.where("not bad").agg(*[F.percentile_approx(s, steps, 1000).alias(s) for s in STATS]).first()
    cuts = {s: sorted({*(bad[s] or []), *(good[s] or [])}) for s in STATS}
    if not all(cuts.values()):
        return []

    def bin_of(s: str) -> Column:
        """Number of cuts below the value: 0 .. len(cuts)."""
        return F.size(F.filter(F.array(*map(F.lit, cuts[s])), lambda c: F.col(s) > c))

    bins = F.explode(F.array(*[F.struct(F.lit(k).alias("s"), bin_of(s).alias("b"))
                               for k, s in enumerate(STATS)])).alias("x")

    def histogram(df: DataFrame) -> dict[tuple[int, int, bool], int]:
        got = df.select("bad", bins).groupBy("x.s", "x.b", "bad").count().collect()
        return {(r["s"], r["b"], r["bad"]): r["count"] for r in got}

    def best(df: DataFrame) -> Condition | None:
        h = histogram(df)
        found: tuple[float, list[Condition]] | None = None
        p0, n0 = (sum(v for (s, _, y), v in h.items() if s == 0 and y is y0) for y0 in (True, False))
        if not p0 or not n0:
            return None
        for k, s in enumerate(STATS):
            p, n = 0, 0
            for b, cut in enumerate(cuts[s]):
                p, n = p + h.get((k, b, True), 0), n + h.get((k, b, False), 0)
                for above, (i, j) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    if i < min_cover:
                        continue
                    gain = i * (math.log2(i / (i + j)) - math.log2(p0 / (p0 + n0)))
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = gain, [Condition(s, above, cut)]
                    elif found and abs(gain - found[0]) <= 1e-9 and (s, above) == (found[1][0].name, found[1][0].above):
                        found[1].append(Condition(s, above, cut))
        # equally good cuts: the middle one leaves the widest margin
        return found and found[1][len(found[1]) // 2]

    def precision(df: DataFrame, rule: Rule) -> tuple[float, float, int]:
        """Smoothed precision (to compare rules), plain precision, hits."""
        r = df.where(rule_column(rule)).agg(
            F.count("*").alias("n"), F.coalesce(F.sum(F.col("bad").cast("int")), F.lit(0)).alias("p")).first()
        return (r["p"] + 1) / (r["n"] + 2), r["p"] / max(r["n"], 1), r["p"]

    rules: list[Rule] = []
    while len(rules) < max_rules:
        rest = rows.where(rules_column(rules).isNull()) if rules else rows
        grow, prune = rest.where("not prune"), rest.where("prune")
        rule: Rule = ()
        while len(rule) < max_conditions and (step := best(grow.where(rule_column(rule)))):
            rule = (*rule, step)
        if not rule:
            break
        value, kept = precision(prune, rule), rule
        while len(kept) > 1:
            shorter = precision(prune, kept[:-1])
            if shorter[0] < value[0]:
                break
            value, kept = shorter, kept[:-1]
        if value[1] < min_precision or value[2] < min_cover // 2:
            break
        rules.append(kept)
    return rules


def judge(docs: DataFrame, rules: list[Rule], keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, measures, ``base_failed``, ``rule`` and ``kept``."""
    df = measures(docs, keep=keep)
    return (df.withColumn("base_failed", base_failed())
            .withColumn("rule", rules_column(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))
