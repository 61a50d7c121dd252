"""Source divergence audit by one-hot level products.

Each language keeps the terms that enough of its documents hold.  A group
(language, source) gives every kept term a smoothed integer probability that
depends on its count only, the group's *level* of the term.  So the
divergence of two groups needs no term list but the joint table of their levels.

1. Each task counts terms per (lang, source) in a bounded dictionary;
   the partial counts are shuffled once, by (lang, term).
2. Sources of a language are numbered and cut into blocks of ``BLOCK``; the
   terms are dealt by hash into buckets of a bounded number of entries.
3. One group per (lang, bucket, block, block) holds the counts of its
   terms.  It cuts them into chunks and writes each chunk as an indicator matrix
   with one column per (source, count level), zero included.  The product of
   the matrix of one block with the transpose of the other is the joint
   table of every source pair at once: exact, as its cells are small counts.
4. Each cell is priced once, in 64-bit integers, and added to its source pair.
   Terms that neither block holds have both levels zero and are added
   at the end from the number of terms seen.
5. The leading terms of a group come from a rank-limited window.

Edge cases: null text, lang and source count as ''; every occurring group and
pair of groups has its rows, also without kept terms (value 0); texts without
terms, repeated rows and equal doc_ids count row by row; an empty table
gives no rows.  Only the three named columns are read.  Sums stay below 2^63 while a language
keeps fewer than 2 * 10^9 terms; counts use decimals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import ASCII_LOWER, ASCII_UPPER, saved

MIN_DOCS = 3
ONE = 1_000_000_000
TOP = 200
BLOCK = 64
TASK_CELLS = 200_000       # counts of one product group
CHUNK_CELLS = 1 << 23      # cells of one indicator matrix
CHUNK_COLUMNS = 1024
HELD_TERMS = 300_000       # partial counts a task holds before it hands them on

# bytes -> bytes: A-Z lower-cased, every other ASCII byte outside a-z a blank;
# bytes of non-ASCII characters belong to terms
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
assert bytes(ASCII_UPPER, "ascii").translate(_TABLE) == bytes(ASCII_LOWER, "ascii")

COUNTS = "lang string, source string, term string, n long, n_docs long"


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per (lang, source, term), handed on before they grow too large."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def flush():
        for (lang, source), (n, docs) in held.items():
            for i in range(0, len(n), 100_000):
                terms = list(n)[i:i + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms)), pa.array([source] * len(terms)),
                     pa.array([t.decode("utf-8", "surrogatepass") for t in terms], pa.string()),
                     pa.array([n[t] for t in terms], pa.int64()), pa.array([docs[t] for t in terms], pa.int64())],
                    names=["lang", "source", "term", "n", "n_docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
            words = Counter(text.encode("utf-8", "surrogatepass").translate(_TABLE).split())
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            n.update(words)
            docs.update(words.keys())
            size += len(n)
            if size > HELD_TERMS:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n): counts of the terms that at least
    ``min_docs`` documents of the language hold, with the language's count."""
    plain = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = plain.mapInArrow(_partial_counts, COUNTS).repartition("lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    term = Window.partitionBy("lang", "term")  # the same partitioning: no further shuffle
    counts = counts.withColumn("all_docs", F.sum("n_docs").over(term)).withColumn("lang_n", F.sum("n").over(term))
    return counts.where(F.col("all_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n")


def group_table(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, terms, block, blocks, buckets): every
    occurring group with its count, its language's, and its place in the
    blocked products of the language."""
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.count("*").alias("cells")).groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count("*").alias("terms"), F.sum("cells").alias("cells"))
    whole = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(whole, "lang", "left")
    whole = whole.withColumn("blocks", F.ceil(F.col("sources") / BLOCK))
    # a group of the product holds 2 of ``blocks`` blocks of the cells of a bucket
    share = F.coalesce("cells", F.lit(0)) * F.least(F.lit(2), "blocks") / F.col("blocks")
    whole = whole.withColumn("buckets", F.greatest(F.lit(1), F.ceil(share / TASK_CELLS)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return groups.join(own, ["lang", "source"], "left").join(whole, "lang").select(
        "lang", "source", zero("total"), zero("lang_total"), zero("terms"),
        F.pmod(F.xxhash64("source"), "blocks").alias("block"), "blocks", "buckets")


def chance(n: Column, base: Column) -> Column:
    """1 + floor(ONE (n + 1) / base), with decimals against overflow."""
    up = F.lit(ONE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", up, F.greatest(base, F.lit(1)).cast("decimal(20,0)")) + 1


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _indicators(row: np.ndarray, source: np.ndarray, n: np.ndarray, n_rows: int, n_sources: int):
    """One-hot matrix of the counts of a chunk of terms, and the (source,
    count) of its columns; a source without an entry for a term has level zero."""
    zeros = np.stack([np.arange(n_sources), np.zeros(n_sources, np.int64)], axis=1)
    columns, col = np.unique(np.concatenate([zeros, np.stack([source, n], axis=1)]), axis=0, return_inverse=True)
    col = col.reshape(-1)
    x = np.zeros((n_rows, len(columns)), np.float32)
    x[:, col[:n_sources]] = 1
    x[row, col[source]] = 0
    x[row, col[n_sources:]] = 1
    return x, columns


def _chunks(row: np.ndarray, level: np.ndarray, n_rows: int, n_sources: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose indicator matrices stay small; ``row`` is sorted."""
    starts = np.searchsorted(row, np.arange(n_rows + 1))
    first = 0
    while first < n_rows:
        last = first + 1
        while last < n_rows:
            to = min(n_rows, 2 * last - first)
            width = len(np.unique(level[starts[first]:starts[to]])) + n_sources
            if width > CHUNK_COLUMNS or width * (to - first) > CHUNK_CELLS:
                break
            last = to
        yield first, last
        first = last


def joint_prices(names: np.ndarray, base: np.ndarray, left: np.ndarray, right: np.ndarray,
                 term: np.ndarray, source: np.ndarray, n: np.ndarray):
    """Priced sums and numbers of terms, as (source, source) matrices, from
    the joint level tables of the ``left`` with the ``right`` sources."""
    total = np.zeros((len(names), len(names)), np.int64)
    seen = np.zeros_like(total)
    if not len(term):
        return total, seen
    # terms of like counts together: their chunk then has few levels
    rank = np.empty(int(term.max()) + 1, np.int64)
    rank[np.argsort(np.bincount(term, weights=n), kind="stable")] = np.arange(len(rank))
    order = np.argsort(rank[term], kind="stable")
    row, source, n = rank[term][order], source[order], n[order]
    _, level = np.unique(np.stack([source, n], axis=1), axis=0, return_inverse=True)
    mirrored = not np.array_equal(left, right)
    for a, b in _chunks(row, level.reshape(-1), len(rank), len(names)):
        lo, hi = np.searchsorted(row, [a, b])
        x, columns = _indicators(row[lo:hi] - a, source[lo:hi], n[lo:hi], b - a, len(names))
        own = columns[:, 0]
        p = np.array([1 + ONE * (c + 1) // m for c, m in zip(columns[:, 1].tolist(), base[own].tolist())], np.int64)
        at_left, at_right = np.flatnonzero(left[own]), np.flatnonzero(right[own])
        table = x[:, at_left].T @ x[:, at_right]
        i, j = np.nonzero(table)
        cells, i, j = table[i, j].astype(np.int64), at_left[i], at_right[j]
        for i, j in ((i, j), (j, i)) if mirrored else ((i, j),):
            np.add.at(total, (own[i], own[j]), cells * ((p[i] - p[j]) ** 2 // p[j]))
            np.add.at(seen, (own[i], own[j]), cells)
    return total, seen


PAIRS = "lang string, source string, other string, base long, other_base long, terms long, value long, seen long"


def _product(pdf: pd.DataFrame) -> pd.DataFrame:
    """All pairs of sources of two blocks over the terms of one bucket."""
    is_group = pdf["term"].isna()
    groups, cells = pdf[is_group].drop_duplicates("source"), pdf[~is_group]
    names, base = groups["source"].to_numpy(object), np.maximum(groups["base"].to_numpy(np.int64), 1)
    block = groups["block"].to_numpy(np.int64)
    left, right = block == pdf["bi"].iat[0], block == pdf["bj"].iat[0]
    total, seen = joint_prices(names, base, left, right, pd.factorize(cells["term"])[0],
                               pd.Index(names).get_indexer(cells["source"]), cells["n"].to_numpy(np.int64))
    pairs = (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    np.fill_diagonal(pairs, False)
    i, j = np.nonzero(pairs)
    return pd.DataFrame({"lang": pdf["lang"].iat[0], "source": names[i], "other": names[j], "base": base[i], "other_base": base[j],
                         "terms": int(groups["terms"].iat[0]), "value": total[i, j], "seen": seen[i, j]})


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources."""
    place = groups.select("lang", "source", (F.col("total") + F.col("terms")).alias("base"), "terms", "block", "blocks", "buckets")
    cells = counts.select("lang", "source", "term", "n").join(place, ["lang", "source"])
    cells = cells.withColumn("bucket", F.pmod(F.xxhash64("term"), "buckets"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    heads = place.withColumn("term", F.lit(None).cast("string")).withColumn("n", F.lit(0).cast("long"))
    heads = heads.withColumn("bucket", F.explode(upto("buckets")))
    rows = cells.unionByName(heads).withColumn("to", F.explode(upto("blocks")))
    rows = rows.withColumn("bi", F.least("block", "to")).withColumn("bj", F.greatest("block", "to"))
    rows = rows.select("lang", "bucket", "bi", "bj", "source", "term", "n", "base", "terms", "block")
    found = rows.groupBy("lang", "bucket", "bi", "bj").applyInPandas(_product, PAIRS)
    found = found.groupBy("lang", "source", "other").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"),
        *(F.max(c).alias(c) for c in ("base", "other_base", "terms")))
    zero = F.lit(0).cast("long")
    rest = (F.col("terms") - F.col("seen")) * price(chance(zero, F.col("base")), chance(zero, F.col("other_base")))
    return found.select("lang", "source", F.col("other").alias("item"), (F.col("value") + rest).alias("value"))


def term_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for the terms a source has more often than
    its language."""
    place = groups.select("lang", "source", "total", "lang_total", "terms")
    rows = counts.join(place, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        chance(F.col("n"), F.col("total") + F.col("terms")).alias("p"),
        chance(F.col("lang_n"), F.col("lang_total") + F.col("terms")).alias("q"))
    return rows.where(F.col("p") > F.col("q")).select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of every source from
    every other of its language, and its ``top`` leading terms."""
    counts = saved(kept_counts(docs, min_docs), "audit-counts")
    groups = saved(group_table(docs, counts), "audit-groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part))

    out = ranked(pair_values(counts, groups), "pair").unionByName(
        ranked(term_values(counts, groups), "term").where(F.col("rank") <= top))
    return out.select("lang", "source", "part", "item", "value", "rank")
